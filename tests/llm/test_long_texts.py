"""Operators on texts of megabytes: many words, one word, white space alone."""

import hashlib

import pytest
from tests.llm.fixtures import LOWER, WORD, table

from knnrec.llm import exact_dedup, jaccard_tree, langid, lm_hpy, mixing, quality_fm, quality_rules, toxicity

TEXTS = {
    1: " ".join(f"w{k % 5003}" for k in range(400_000)), 2: "x" * 3_000_000, 3: " " * 1_200_000, 4: "\n" * 1_200_000 + "end",
    5: "a short text of some words", 6: "another short text with other words",
}


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, [(k, t, "en" if k % 2 else "de", "s", len(t)) for k, t in TEXTS.items()]).repartition(3).cache()


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(k, k % 2, int(k == 5)) for k in TEXTS], "doc_id long, quality int, toxic int")


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_fitted_models(docs, labels):
    for found in (
        mixing.mix(docs, labels), quality_fm.score(docs, quality_fm.learn(docs, labels)),
        toxicity.score(docs, toxicity.learn(docs, labels)), langid.classify(docs),
    ):
        assert ids(found) == sorted(TEXTS)


def test_language_model_counts_all_words(docs):
    got = {r["doc_id"]: r["n_tokens"] for r in lm_hpy.score(docs).collect()}
    assert got == {k: len(WORD.findall(t)) + 1 for k, t in TEXTS.items()}


def test_rules_and_shingles(docs):
    words = {k: WORD.findall(t) for k, t in TEXTS.items()}
    got = {r["doc_id"]: (r["n_words"], r["word_chars"]) for r in quality_rules.judge(docs).collect()}
    assert got == {k: (len(w), sum(map(len, w))) for k, w in words.items()}
    got = {r["doc_id"]: r["n_shingles"] for r in jaccard_tree.join(docs).collect()}
    assert got == {k: len({tuple(w[i : i + 5]) for i in range(max(len(w) - 4, min(len(w), 1)))}) for k, w in words.items()}


def test_digests(docs):
    got = {r["doc_id"]: r["text_sha256"] for r in exact_dedup.mark(docs).collect()}
    assert got == {k: hashlib.sha256(t.translate(LOWER).encode()).hexdigest() for k, t in TEXTS.items()}
