"""The corpus pipeline against brute force, stage by stage."""

import random

import pytest
from tests.llm.fixtures import SF, components, edge_rows, prose, table
from tests.llm.test_near_duplicates import brute_jaccard

import corpus_pipeline as pipeline
from knnrec.llm import langid, mixing, packing, quality_fm
from knnrec.llm.common import drop_stages, staged_count


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A table with clean, symbol-ridden, near-equal and repeated texts."""
    rng, path = random.Random(8), str(tmp_path_factory.mktemp("sf"))
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(250).collect()
    rows = [tuple(r) for r in docs] + [(5000 + k, *tuple(r)[1:]) for k, r in enumerate(docs[:30])]
    rows += [(None if r[0] is None else 9000 + r[0], *r[1:]) for r in edge_rows()]
    rows += [(6000 + k, prose(rng, 200) + f" end{k}", "en", "src0", 900) for k in range(5)]
    table(spark, rows).write.parquet(f"{path}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    assert [n for n, _ in pipeline.STAGES] == ["quality_classifier", "language_id", "ngram_jaccard_join", "source_mixing", "best_fit_packing"]
    steps = dict(pipeline.STAGES)
    key = lambda rows: sorted((tuple(r) for r in rows), key=repr)

    good = steps["quality_classifier"](spark, docs, folder).cache()
    scores = {r["doc_id"]: r["predicted"] for r in quality_fm.score(docs, quality_fm.learn(docs, labels)).collect()}
    assert key(good.collect()) == key(r for r in docs.collect() if scores[r["doc_id"]])

    clear = steps["language_id"](spark, good, folder).cache()
    rejected = {r["doc_id"]: r["rejected"] for r in langid.identify(good, langid.learn(langid.training_rows(good))).collect()}
    assert key(clear.collect()) == key(r for r in good.collect() if not rejected[r["doc_id"]])

    single = steps["ngram_jaccard_join"](spark, clear, folder).cache()
    rows = clear.collect()
    n, component, links = brute_jaccard([r for r in rows if r["doc_id"] is not None])
    assert len(links) > 20
    stay = {k for k in component if component[k] == k}
    got = [r["doc_id"] for r in single.collect()]
    assert sorted(x for x in got if x is not None) == sorted(stay) and single.columns == docs.columns

    mixed = steps["source_mixing"](spark, single, folder).cache()
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(single, labels).collect()}
    times = {}
    for r in mixed.collect():
        times[r["doc_id"]] = times.get(r["doc_id"], 0) + 1
    assert times == {k: c for k, c in copies.items() if c} and mixed.columns == docs.columns

    pieces = steps["best_fit_packing"](spark, mixed, folder)
    assert pieces.where("piece = 0").count() == mixed.count()
    assert pieces.groupBy("sequence_id").sum("length").where("`sum(length)` > 1024").count() == 0


def test_run_applies_the_stages(spark, folder):
    before = staged_count()
    out = pipeline.run(spark, folder)
    assert out.count() > 100 and out.columns == packing.pack(table(spark, [])).columns
    drop_stages(spark, before)
    assert staged_count() == before


def test_brute_force_components():
    assert components([1, 2, 3], [(3, 2)]) == {1: 1, 2: 2, 3: 2}
