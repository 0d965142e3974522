"""Whitening of embeddings with a weighted covariance of distinct vectors.

Entries become whole numbers x (``quantise``). Rows with the same x vector are
grouped, and a distinct vector enters the fit with its number of rows as weight
(or with one). Sums S are exact; deviations n x - S are exact whole numbers, so
what is multiplied has been centred without rounding. Each task adds up its
weighted product of centred blocks; only these d x d sums meet, in Spark. The
eigenvectors are found once, on the driver, from one d x d matrix. A distinct
vector is whitened once and joined back to its rows; vectors that hold more
than 1 / 1000 of the rows are broadcast, the others shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knnrec.llm.common import hot_join, prepare, stage

SCALE, SHIFT = 1024, 100_000
#: Entries whose x would not be an exact whole number count as not finite.
LARGEST = float(1 << 53)
#: Rows multiplied at once.
BLOCK = 4096


def quantise(embedding: Column) -> Column:
    """x = floor(1024 c) + 100000 of every entry c, taken as double."""
    return F.transform(embedding, lambda c: F.floor(c.cast("double") * F.lit(float(SCALE))) + F.lit(SHIFT))


def usable(embedding: Column) -> Column:
    """Vectors without null, non-finite or unrepresentable entries."""
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double") * F.lit(float(SCALE))) >= F.lit(LARGEST))
    return embedding.isNotNull() & (F.size(embedding) > 0) & ~F.exists(embedding, bad)


def key_of(x: Column) -> Column:
    return F.unhex(F.sha2(F.array_join(x, ","), 256))


def block(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exact: 64-bit where that holds it, Python integers beyond."""
    top = max(int(np.abs(x).max(initial=0)) * n, *map(abs, sums))
    if top < 1 << 62:
        return x * np.int64(n) - np.array(sums, dtype=np.int64)
    return x.astype(object) * n - np.array(sums, dtype=object)


def squared_length(d: np.ndarray) -> list[int]:
    """Exact sums of squares per row."""
    if d.dtype != object and (int(np.abs(d).max(initial=0)) ** 2) * d.shape[1] < 1 << 63:
        return (d * d).sum(axis=1).tolist()
    return (d.astype(object) ** 2).sum(axis=1).tolist()


@dataclass
class Whitening:
    """What the driver holds: d sums and at most ``components`` directions."""

    n: int
    sums: list[int]
    vectors: np.ndarray  # d x k, unit columns
    values: np.ndarray  # k eigenvalues, falling
    trace: float

    def apply(self, d: np.ndarray) -> np.ndarray:
        """Whitened rows of exact deviations ``d``."""
        return (d.astype(np.float64) / self.n) @ self.vectors / np.sqrt(self.values)


def summed(parts: DataFrame) -> DataFrame:
    """(pos, value): the element-wise sums of the arrays ``v``."""
    return parts.select(F.posexplode("v")).groupBy("pos").agg(F.sum("col").alias("value"))


def distinct_vectors(vectors: DataFrame, weights: str) -> DataFrame:
    """x, copies, w (fit weight), key of every distinct x vector of the
    commonest length (ties: the longer)."""
    x = vectors.where(usable(F.col("embedding"))).select(quantise(F.col("embedding")).alias("x"))
    groups = stage(x.groupBy("x").agg(F.count(F.lit(1)).alias("copies")), "whiten-distinct")
    lengths = groups.groupBy(F.size("x").alias("d")).agg(F.sum("copies").alias("n"))
    commonest = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    w = F.col("copies") if weights == "count" else F.lit(1).cast("long")
    return groups.where(F.size("x") == (commonest["d"] if commonest else 0)).select("x", "copies", w.alias("w"), key_of(F.col("x")).alias("key"))


def fit(distinct: DataFrame, components: int) -> Whitening | None:
    """None without rows. Eigenvalues that are rounding noise are left out:
    nothing varies along them, so nothing can be whitened."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: list[int] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            x, w = block(batch.column(0)), batch.column(1).to_numpy()
            if int(np.abs(x).max()) * int(w.sum()) >= 1 << 62:
                x = x.astype(object)
            part = [int(w.sum()), *map(int, (x * w[:, None]).sum(axis=0))]
            total = part if total is None else [a + b for a, b in zip(total, part, strict=True)]
        if total:
            yield pa.RecordBatch.from_pydict({"v": [[str(t) for t in total]]})

    exact = distinct.select("x", "w").mapInArrow(sums, "v array<string>")
    exact = exact.select(F.transform("v", lambda t: t.cast("decimal(38,0)")).alias("v"))
    found = {r["pos"]: int(r["value"]) for r in summed(exact).collect()}  # d + 1 rows
    if not found:
        return None
    n, total = found[0], [found[i] for i in range(1, len(found))]
    d = len(total)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = np.zeros((d, d))
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK):
                part = batch.slice(lo, BLOCK)
                y = deviations(block(part.column(0)), n, total).astype(np.float64) / n
                gram += (y * part.column(1).to_numpy()[:, None]).T @ y
        yield pa.RecordBatch.from_arrays([pa.array([gram.ravel()], pa.list_(pa.float64()))], names=["v"])

    cells = summed(distinct.select("x", "w").mapInArrow(products, "v array<double>")).toArrow().sort_by("pos")  # d x d rows
    v = cells["value"].to_numpy().reshape(d, d) / n
    values, vectors = np.linalg.eigh((v + v.T) / 2)
    values, vectors = values[::-1], vectors[:, ::-1]
    keep = min(components, int((values > d * np.finfo(float).eps * max(values[0], 0.0)).sum()))
    vectors = vectors[:, :keep]
    largest = np.abs(vectors).argmax(axis=0)
    vectors = vectors * np.sign(vectors[largest, np.arange(keep)])  # a defined sign
    return Whitening(n, total, vectors, values[:keep], float(np.trace(v)))


def whiten_distinct(distinct: DataFrame, model: Whitening) -> DataFrame:
    """key, w, deviation, z (whitened components) of every distinct vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK):
                part = batch.slice(lo, BLOCK)
                d = deviations(block(part.column(0)), model.n, model.sums)
                z = pa.array(list(model.apply(d)), pa.list_(pa.float64()))
                far = pa.array([str(s) for s in squared_length(d)])
                yield pa.RecordBatch.from_arrays([part.column(1), part.column(2), far, z], names=["key", "w", "far", "z"])

    made = distinct.select("x", "key", "w").mapInArrow(run, "key binary, w long, far string, z array<double>")
    return made.select("key", "w", F.expr("try_cast(far AS decimal(38,0))").alias("deviation"), "z")


def identity_error(whitened: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of (covariance of z over the fit list - identity)."""
    k = len(model.values)
    at = lambda i: F.col("z")[i]
    means = whitened.agg(*(F.sum(at(i) * F.col("w")).alias(f"m{i}") for i in range(k))).first()
    m = [means[i] / model.n for i in range(k)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    cells = whitened.agg(*(F.sum((at(i) - m[i]) * (at(j) - m[j]) * F.col("w")).alias(f"c{i}_{j}") for i, j in pairs)).first()
    return max(abs(c / model.n - (i == j)) for c, (i, j) in zip(cells, pairs, strict=True))


def whiten(vectors: DataFrame, components: int = 8, weights: str = "count") -> DataFrame:
    """One row per usable row of ``vectors`` (vec_id, embedding) and component:
    vec_id, component (from 1), n (size of the fit list), deviation (exact sum of
    (n x - S)^2, decimal), whitened, explained, identity_error.

    ``weights``: "count" fits on all rows, "one" on the distinct vectors.
    Vectors that are null, empty, or hold null, non-finite or unrepresentable
    entries (beyond 2^53 / 1024) are dropped, and so are those of another
    length than the commonest. Directions without variance have no component;
    where all vectors are equal there are no rows, nor for an empty table.
    Repeated rows are rows of their own, a null vec_id stays null; other columns
    are ignored. A deviation beyond 38 digits is null.
    """
    if weights not in ("count", "one"):
        raise ValueError(f"weights must be 'count' or 'one', not {weights!r}")
    spark = vectors.sparkSession
    prepare(spark)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    distinct = stage(distinct_vectors(rows, weights), "whiten-weighted")
    model = fit(distinct, components)
    out = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if model is None or not len(model.values):
        return spark.createDataFrame([], out)
    whitened = stage(whiten_distinct(distinct, model), "whiten-vectors")
    error = identity_error(whitened, model)
    keyed = rows.where(usable(F.col("embedding"))).select("vec_id", key_of(quantise(F.col("embedding"))).alias("key"))
    joined = hot_join(stage(keyed, "whiten-rows"), whitened, ["key"])
    explained = F.array(*(F.lit(float(e / model.trace)) for e in model.values))
    return joined.select("vec_id", "deviation", F.posexplode("z").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        explained[F.col("at")].alias("explained"), F.lit(error).alias("identity_error"),
    )
