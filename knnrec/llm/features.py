"""Hashed words and structure statistics of whole texts, as numpy blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knnrec.llm.common import Words, passes, stage

#: Byte classes whose share of a text is a feature.
CLASSES = (
    np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", np.uint8),
    np.frombuffer(b"#*$%&|<>", np.uint8),
    np.frombuffer(b".,;:", np.uint8),
    np.frombuffer(b"!?", np.uint8),
    np.frombuffer(b"0123456789", np.uint8),
    np.frombuffer(b"\n", np.uint8),
    np.arange(128, 256, dtype=np.uint8),
)
STATISTICS = len(CLASSES) + 7


def _sums(values: np.ndarray, offs: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[offs[1:]] - total[offs[:-1]]


def dense(buf: np.ndarray, offs: np.ndarray, n_chars: np.ndarray, width: int) -> np.ndarray:
    """One row per text: ``width`` hashed words (square roots of their share,
    so a text's words have length 1), then the structure statistics and the
    recorded number of characters. A text without words has zeros there."""
    words = Words(buf, offs)
    texts, n = words.texts, words.counts
    safe = np.maximum(n, 1)
    size = np.maximum(np.diff(offs), 1)
    out = np.zeros((texts, width + STATISTICS), dtype=np.float32)
    cell = words.of * width + (words.hash % np.uint64(width)).astype(np.int64)
    out[:, :width] = np.sqrt(np.bincount(cell, minlength=texts * width).reshape(texts, width) / safe[:, None])
    for i, members in enumerate(CLASSES):
        table = np.zeros(256, dtype=bool)
        table[members] = True
        out[:, width + i] = _sums(table[buf], offs) / size
    at = width + len(CLASSES)
    length = words.ends - words.starts
    same = np.zeros(len(length), dtype=bool)
    same[1:] = (words.hash[1:] == words.hash[:-1]) & (words.of[1:] == words.of[:-1])
    order = np.lexsort((words.hash, words.of))  # words.of ascends already
    h, of = words.hash[order], words.of[order]
    fresh = np.ones(len(h), dtype=bool)
    fresh[1:] = (h[1:] != h[:-1]) | (of[1:] != of[:-1])
    out[:, at] = np.log1p(n) / 10
    out[:, at + 1] = np.minimum(_sums(length, words.first) / safe / 20, 3)
    out[:, at + 2] = _sums(same, words.first) / safe
    out[:, at + 3] = _sums(fresh, words.first) / safe
    out[:, at + 4] = np.log1p(np.maximum(n_chars, 0)) / 12
    out[:, at + 5] = n == 0
    if len(length):
        out[n > 0, at + 6] = np.minimum(np.maximum.reduceat(length, words.first[:-1][n > 0]) / 100, 3)
    return out


def blocks(texts: pa.Array, n_chars: pa.Array, width: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first row, end row, dense features) of texts and their n_chars."""
    size = n_chars.fill_null(0).to_numpy(zero_copy_only=False)
    for lo, hi, buf, offs in passes(texts):
        yield lo, hi, dense(buf, offs, size[lo:hi], width)


def feature_columns(docs: DataFrame) -> list[Column]:
    """The columns that features are made of; a missing n_chars is null."""
    n_chars = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")
    return [F.col("text").cast("string").alias("text"), n_chars.alias("n_chars")]


def inputs(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *feature_columns(docs))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> tuple[DataFrame, dict]:
    """At most ``per_class`` documents of every label value, and the number of
    labelled rows of each value. Ids fall into ``per_class`` buckets by hash;
    each gives its smallest hash. Conflicting labels of an id: the smallest
    value counts; of several texts of an id the one with the smallest hash is
    learned from. Rows with a null id or label are not learned from."""
    known = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min(F.col(label).cast("int")).alias("label"))
        .withColumn("h", F.xxhash64("doc_id"))
    )
    picked = known.groupBy("label", F.pmod("h", F.lit(per_class)).alias("b")).agg(
        F.min_by("doc_id", "h").alias("doc_id"), F.count(F.lit(1)).alias("n")
    )
    rows = picked.collect()  # per_class rows per label value
    totals: dict[int, int] = {}
    for row in rows:
        totals[row["label"]] = totals.get(row["label"], 0) + row["n"]
    spark = docs.sparkSession
    ids = spark.createDataFrame([(r["doc_id"], r["label"]) for r in rows], "doc_id long, label int")
    found = inputs(docs).join(F.broadcast(ids), "doc_id")
    # of several rows of an id: the one with the smallest hash of text and size
    one = F.min_by(F.struct("text", "n_chars", "label"), F.xxhash64("text", "n_chars"))
    sample = stage(found.groupBy("doc_id").agg(one.alias("x")).select("doc_id", "x.*"), "labelled-sample")
    return sample, totals


def collect_features(sample: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of a bounded sample, on the driver, ordered by id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, x in blocks(batch.column(1), batch.column(2), width):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[lo:hi], batch.column(3)[lo:hi], pa.array([r.tobytes() for r in x], pa.binary())],
                    names=["doc_id", "label", "x"],
                )

    table = sample.select("doc_id", "text", "n_chars", "label").mapInArrow(run, "doc_id long, label int, x binary")
    table = table.toArrow().sort_by("doc_id")
    x = np.frombuffer(b"".join(table["x"].to_pylist()), np.float32).reshape(-1, width + STATISTICS)
    return x, table["label"].to_numpy()
