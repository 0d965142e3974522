import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.llm.fixtures import SF, crc, edge_rows, table

from knnrec.llm import features, langid, mixing, quality_fm, queries, toxicity


def both(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


LABELS = "doc_id long, quality int, toxic int"


def test_sum_of_squares_identity():
    rng = np.random.default_rng(0)
    d, x = 9, rng.normal(size=(5, 9)).astype(np.float32)
    m = quality_fm.FactorisationMachine(
        0.3, rng.normal(size=d).astype(np.float32), rng.normal(size=(d, 3)).astype(np.float32),
        np.zeros(d, np.float32), np.ones(d, np.float32), 4,
    )
    brute = [
        m.bias + r @ m.weights + sum(m.factors[i] @ m.factors[j] * r[i] * r[j] for i in range(d) for j in range(i)) for r in x
    ]
    assert np.allclose(m.margin(x), brute, rtol=1e-4, atol=1e-4)


def test_machine_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2, size=(1200, 6)).astype(np.float32)
    y = (x[:, 0] == x[:, 1]).astype(int)
    m = quality_fm.fit(x, y, np.ones(len(y)), width=6, epochs=40)
    assert ((m.score(x) >= 0.5) == y).mean() > 0.95


def test_dense_features_of_one_text():
    texts = ["Hello hello WORLD!! 12", "", "a"]
    buf = np.frombuffer("".join(texts).encode(), np.uint8)
    x = features.dense(buf, np.array([0, 22, 22, 23]), np.array([22, 0, 1]), 8)
    assert np.allclose((x[:, :8] ** 2).sum(axis=1), [1, 0, 1])
    stats = x[0, 8:]
    assert np.isclose(stats[0], 6 / 22) and np.isclose(stats[3], 2 / 22) and np.isclose(stats[4], 2 / 22)
    n, mean, repeat, distinct = stats[7], stats[8], stats[9], stats[10]
    assert np.isclose(n, np.log1p(4) / 10) and np.isclose(mean, 19 / 4 / 20) and np.isclose(repeat, 1 / 4) and np.isclose(distinct, 3 / 4)
    assert x[1, 8 + len(features.CLASSES) + 5] == 1 and np.isclose(stats[13], 0.07)


def test_quality_on_held_out_rows(spark):
    got = queries.op6_quality_classifier(spark, SF).join(both(spark, "labels"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (crc(r["doc_id"], 5) == 0) and 0 <= r["score"] <= 1 for r in got)
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in got)
    assert np.mean([r["predicted"] == r["quality"] for r in held]) > 0.95


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs, labels = both(spark, "documents"), both(spark, "labels")
    other = labels.withColumn("quality", F.when(queries.fold(F.col("doc_id"), 5) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (quality_fm.learn(docs.drop("lang", "source"), x) for x in (labels, other))
    assert np.array_equal(a.weights, b.weights) and a.bias == b.bias


def test_toxicity_on_held_out_rows(spark):
    got = queries.op7_toxicity(spark, SF).join(both(spark, "labels").withColumnRenamed("toxic", "is_toxic"), "doc_id").collect()
    right = [r["toxic"] == bool(r["is_toxic"]) for r in got if r["held_out"]]
    assert np.mean(right) > 0.93
    assert np.mean([r["toxic"] for r in got if r["is_toxic"]]) > 0.85
    clean = [r["toxic"] for r in got if not r["is_toxic"]]
    assert np.mean(clean) < 0.05


def test_chain_uses_out_of_fold_predictions():
    """The first category is noise on the sample's own words: in-fold
    predictions would make it look informative for the second."""
    rng = np.random.default_rng(0)
    n = 300
    row, bucket = np.repeat(np.arange(n), 5), rng.integers(0, 40, n * 5)
    stats = np.zeros((n, features.STATISTICS), np.float32)
    first, second = rng.integers(0, 2, n).astype(float), (np.bincount(row, bucket == 3, n) > 0).astype(float)
    links = toxicity.fit_chain(row, bucket, stats, {"a": first, "b": second}, np.ones(n))
    assert [x.category for x in links] == ["a", "b"] and len(links[1].rest) == features.STATISTICS + 2
    total = np.bincount(row, links[1].words[bucket], n)
    p = toxicity.sigmoid(links[1].margin(total, np.column_stack((stats, np.full(n, 0.5)))))
    assert ((p >= 0.5) == second).mean() > 0.97


def test_language_on_held_out_rows(spark):
    got = queries.op9_language_id(spark, SF).join(both(spark, "documents"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (crc(r["doc_id"], 4) == 2) and 0 <= r["score"] <= 1 for r in got)
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.95
    assert np.mean([r["rejected"] for r in got]) < 0.02


def test_language_rule():
    """The smallest output wins; the margin is the lead of the winner."""
    import pyarrow as pa

    contents = {"xx": b"abra cadabra simsalabim hokus pokus " * 30, "yy": b"lorem ipsum dolor sit amet consectetur " * 30}
    measure = langid.classifier(contents, 6)
    pred, score, margin = measure(pa.array(["Hokus pokus simsalabim abra cadabra, hokus!", "lorem IPSUM dolor sit amet", None, "12 ;;"]))
    assert pred == ["xx", "yy", "und", "und"] and score[0] > 0.9 and margin[0] > 0.1 and score[2:] == [0.0, 0.0]


def test_language_lead_does_not_fade_with_length():
    """Clear texts of 5 MB, one repeated and one never repeating, keep a lead."""
    import pyarrow as pa

    rng = np.random.default_rng(0)
    words = {k: ["".join(rng.choice(list(abc), rng.integers(3, 9))) for _ in range(3000)] for k, abc in (("xx", "abcdefgh"), ("yy", "ghijklmn"))}
    text = lambda lang, n: " ".join(rng.choice(words[lang], n))
    measure = langid.classifier({k: text(k, 30_000).encode() for k in words}, 6)
    short = text("xx", 3000)
    pred, score, margin = measure(pa.array([short, " ".join([short] * (5_000_000 // len(short))), text("xx", 750_000)]))
    assert pred == ["xx"] * 3 and min(score) > 0.99
    assert min(margin) >= 0.005 and margin[2] > margin[0] / 3
    data = short.encode() * 3
    assert b"".join(langid.pieces(data)) == data and max(map(len, langid.pieces(data))) <= langid.PIECE_BYTES


def test_dictionaries_are_not_filled_by_openings(spark):
    """Texts of one opening differ after it; half of each is the opening."""
    opening = "shared opening of every page " * 35
    body = lambda k: "".join(f" word{chr(97 + k % 26)}{chr(97 + j)}" * 6 for j in range(26))
    rows = [(k, opening + body(k) + f" {k}", "en", "s", 1) for k in range(200)]
    content = langid.learn(table(spark, rows))["en"]
    assert content.count(b"word") > 2000 and content.count(b"opening") > 200
    short = [(k, "a short text", "en", "s", 1) for k in range(3)] + [(9, "another one", "en", "s", 1)]
    assert sorted(langid.learn(table(spark, short))["en"].split()) == sorted(b"a short text another one".split())


def test_stray_language_values_stay_within_bounds(spark):
    rows = [(k, f"some words in {'english' if k % 2 else 'deutsch'} {k}", "en" if k % 2 else "de", "s", 1) for k in range(40)]
    rows += [(100 + k, f"some stray text {k}", f"x{k}", "s", 1) for k in range(30)]
    docs = table(spark, rows)
    assert set(langid.learn(docs, languages=2)) == {"en", "de"}
    assert set(langid.learn(docs, languages=4)) == {"en", "de", "x0", "x1"} and len(langid.learn(docs)) == 32


def test_repeated_ids_have_a_defined_sample(spark):
    """Of several texts of an id the same one is learned from, however the
    table is dealt."""
    rows = [(k, f"text {k} version {v} " * (v + 1), "en", "s", v) for k in range(60) for v in range(4)]
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(60)], LABELS)
    picked = []
    for n in (1, 7):
        sample, _ = features.labelled_sample(table(spark, rows).repartition(n), labels, "quality", 50)
        picked.append(sorted(map(tuple, sample.collect())))
    assert picked[0] == picked[1] and len({r[0] for r in picked[0]}) == len(picked[0]) > 20


@pytest.fixture(scope="module")
def edges(spark):
    labels = [(100 + k, k % 2, int(k % 5 == 0)) for k in range(40)] + [(None, 1, 0), (101, None, None), (9999, 0, 1), (100, 1, 1)]
    return table(spark, edge_rows(), clash=True), spark.createDataFrame(labels, LABELS)


def test_classifier_edge_cases(spark, edges):
    docs, labels = edges
    n = len(edge_rows())
    model = quality_fm.learn(docs, labels)
    rows = quality_fm.score(docs, model).collect()
    assert len(rows) == n and all(np.isfinite(r["score"]) for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] == 8}) == 1
    kept = quality_fm.keep_good(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r["predicted"] for r in rows)
    links = toxicity.learn(docs, labels)
    rows = toxicity.score(docs, links).collect()
    assert len(rows) == n and all(0 <= r["p_toxic"] <= 1 for r in rows)
    found = langid.classify(docs).collect()
    by_id = {r["doc_id"]: r["lang_pred"] for r in found}
    assert len(found) == n and {by_id[k] for k in (1, 2, 3, 5)} == {"und"} and by_id[7] != "und"
    identified = langid.keep_identified(docs, langid.learn(langid.training_rows(docs)))
    assert identified.columns == docs.columns and identified.count() == sum(not r["rejected"] for r in found)


def test_empty_tables(spark, edges):
    docs, labels = edges
    none = docs.limit(0)
    for d, wanted in ((none, 0), (docs, docs.count())):
        for x in (labels.limit(0), labels):
            assert quality_fm.score(d, quality_fm.learn(d, x)).count() == wanted
            assert toxicity.score(d, toxicity.learn(d, x)).count() == wanted
            assert mixing.mix(d, x).count() == wanted
    assert langid.classify(none).count() == 0 and mixing.apply_mix(none, labels).count() == 0


def test_one_label_value_alone(spark, edges):
    docs, labels = edges
    same = labels.where("quality = 1").withColumn("toxic", F.lit(0))
    assert all(r["predicted"] == 1 for r in quality_fm.score(docs, quality_fm.learn(docs, same)).collect())
    assert not any(r["toxic"] for r in toxicity.score(docs, toxicity.learn(docs, same)).collect())


def brute_miss(p, n, goal, rounds):
    """What plain projected gradient over all documents leaves."""
    share = (p * n[:, None]).sum(axis=0) / n.sum()
    r = np.ones(len(n))
    for _ in range(rounds):
        r = np.maximum(0, r - p @ (((r * n) @ p / n.sum() - goal) / share))
    return float(np.abs((r * n) @ p / n.sum() - goal).sum())


@pytest.mark.parametrize("spread, goal, met", [(0.2, [0.7, 0.2, 0.1], True), (3.0, [0.6, 0.3, 0.1], True), (30.0, [0.4, 0.3, 0.3], True), (0.2, [0.97, 0.03, 0.0], False), (3.0, [0.97, 0.03, 0.0], False)])
def test_rates_meet_targets_or_report_the_miss(spark, spread, goal, met):
    """Sharp (0.2) to soft (30) posteriors; some targets cannot be met."""
    rng = np.random.default_rng(0)
    p = rng.dirichlet([spread] * 3, 500)
    n = rng.integers(0, 900, 500)
    rows = [(k, int(n[k]), *map(float, p[k])) for k in range(500)]
    member = spark.createDataFrame(rows, "doc_id long, n_tokens long, p_clean double, p_toxic double, p_poor double")
    rates = mixing.fit_rates(member, dict(zip(mixing.DOMAINS, goal, strict=True)))
    r = rates.of(p)
    assert (r >= 0).all() and abs(np.abs((r * n) @ p / n.sum() - goal).sum() - rates.miss) < 1e-9
    assert (rates.miss < 1e-4) == met and rates.miss < brute_miss(p, n, np.array(goal), 100) + 1e-4


def test_mix_reports_what_is_missed(spark):
    mixed = mixing.mix(both(spark, "documents"), both(spark, "labels"))
    rows = mixed.collect()
    (miss,) = {r["target_miss"] for r in rows}
    tokens = sum(r["n_tokens"] for r in rows)
    left = [sum(r["rate"] * r["n_tokens"] * r[f"p_{d}"] for r in rows) / tokens - mixing.TARGETS[d] for d in mixing.DOMAINS]
    assert abs(sum(map(abs, left)) - miss) < 1e-9


def test_mix_and_apply_mix_agree(spark):
    docs, labels = both(spark, "documents"), both(spark, "labels")
    mixed = mixing.mix(docs, labels).collect()
    wanted = {r["doc_id"]: r["copies"] for r in mixed if r["copies"]}
    got = {r["doc_id"]: r["count"] for r in mixing.apply_mix(docs, labels).groupBy("doc_id").count().collect()}
    assert got == wanted
    tokens = sum(r["n_tokens"] for r in mixed)
    assert abs(sum(r["rate"] * r["n_tokens"] * r["p_toxic"] for r in mixed) / tokens - 0.03) < 0.005
    assert abs(sum(r["copies"] * r["n_tokens"] for r in mixed) / tokens - 1) < 0.05
