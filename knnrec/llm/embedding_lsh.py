"""Near-duplicate embeddings by Euclidean p-stable hashing.

A normalised vector v gets, in each of several tables, ``hashes`` quantised
projections floor((a.v + b) / width) with Gaussian a and uniform b; equal
values (and labels) are one bucket. Vectors that share a bucket are compared
by their exact cosine. A pair that shares buckets of several tables is
counted in the first of them only, so no pair list is made or deduplicated.

At cosine 0.93 (distance 0.374) one projection of width 1.5 agrees with
probability 0.80, ten with 0.107, and one of 24 tables with 0.934; at cosine
0.97 one of them with 0.999.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knnrec.llm.common import grouped, mix64, prepare, stage
from knnrec.llm.components import components, grid


#: Rows of a bucket that are one block: a bucket of n rows sends each vector to
#: n / BLOCK cells. A cell compares up to 2 x BLOCK rows, TILE of them at once.
BLOCK, TILE = 3000, 500


def projections(dim: int, tables: int, hashes: int, width: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng((seed, dim))
    return rng.normal(size=(dim, tables * hashes)), rng.uniform(0, width, size=tables * hashes)


def distinct_vectors(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members, classes): valid vectors and one row per different (label,
    embedding), with its smallest id ``rep`` and its number of ids.

    Repeated rows of one vec_id with equal content are one vector."""
    values = F.transform(F.col("embedding"), lambda x: x.cast("double"))
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("label"), values.alias("e")).where(
        F.col("vec_id").isNotNull()
        & F.col("label").isNotNull()
        & F.col("e").isNotNull()
        & ~F.exists("e", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists("e", lambda x: x != 0)
    )
    rows = rows.withColumn("key", F.xxhash64(F.transform("e", lambda x: x + F.lit(0.0))))
    rows = stage(rows.select("vec_id", "label", "key", "e"), "lsh-rows")
    classes = rows.groupBy("label", "key").agg(F.min("vec_id").alias("rep"), F.count_distinct("vec_id").alias("copies"))
    return rows, classes


def signatures(rows: DataFrame, tables: int, hashes: int, width: float, seed: int) -> DataFrame:
    """rep, label, copies, e (unit length), buckets (one 64-bit value a table)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, tuple] = {}
        for batch in batches:
            unit, keys = [], []
            for values in batch.column(3).to_pylist():
                v = np.array(values, dtype=np.float64)
                v /= np.abs(v).max()  # no overflow in the square
                v /= np.sqrt((v * v).sum())
                if len(v) not in made:
                    made[len(v)] = projections(len(v), tables, hashes, width, seed)
                a, b = made[len(v)]
                cells = np.floor((v @ a + b) / width).astype(np.int64).astype(np.uint64).reshape(tables, hashes)
                key = np.full(tables, len(v), dtype=np.uint64)
                for j in range(hashes):
                    key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + cells[:, j])
                unit.append(v)
                keys.append(key.astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(unit, pa.list_(pa.float64())), pa.array(keys, pa.list_(pa.int64()))],
                names=["rep", "label", "copies", "e", "buckets"],
            )

    label = rows.schema["label"].dataType.simpleString()
    return rows.select("rep", "label", "copies", "e").mapInArrow(
        run, f"rep long, label {label}, copies long, e array<double>, buckets array<long>"
    )


def compare(cells: DataFrame, similarity: float) -> DataFrame:
    """Within each cell: rows (rep, n, b). n > 0: links found there for
    ``rep`` (copies counted). b not null: a link of the cell's spanning
    forest, enough to join what the cell links."""
    ordered = cells.repartition("table", "bucket", "label", "cell_a", "cell_b").sortWithinPartitions(
        "table", "bucket", "label", "cell_a", "cell_b"
    )

    def solve(g: dict[str, np.ndarray]) -> tuple[list, list, list]:
        e, buckets, rep, copies, side = g["e"], g["buckets"], g["rep"], g["copies"], g["side"]
        table = int(g["table"][0])
        linked = np.empty((len(rep), len(rep)), dtype=bool)
        for lo in range(0, len(rep), TILE):  # no matrix of a whole cell's cosines
            linked[lo : lo + TILE] = e[lo : lo + TILE] @ e.T >= similarity
        if g["cell_a"][0] != g["cell_b"][0]:
            linked &= side[:, None] != side[None, :]
        np.fill_diagonal(linked, False)
        n = np.empty(len(rep), dtype=np.int64)
        for lo in range(0, len(rep), TILE):
            new = linked[lo : lo + TILE].copy()
            for t in range(table):  # counted in an earlier table already
                new &= buckets[lo : lo + TILE, None, t] != buckets[None, :, t]
            n[lo : lo + TILE] = new @ copies
        a, b, seen = [], [], np.zeros(len(rep), dtype=bool)
        for root in np.flatnonzero(linked.any(axis=1)):
            frontier = [] if seen[root] else [root]
            seen[root] = True
            while frontier:
                at = frontier.pop()
                near = np.flatnonzero(linked[at] & ~seen)
                seen[near] = True
                frontier += near.tolist()
                a += [rep[at]] * len(near)
                b += rep[near].tolist()
        hit = np.flatnonzero(n)
        return rep[hit].tolist() + a, n[hit].tolist() + [0] * len(a), [None] * len(hit) + b

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def ready(t: pa.Table):
            g = {c: t[c].to_numpy() for c in ("table", "cell_a", "cell_b", "side", "rep", "copies")}
            for c, kind in (("e", np.float64), ("buckets", np.int64)):
                flat = t[c].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
                g[c] = flat.reshape(t.num_rows, -1)
            a, n, b = solve(g)
            return pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(n, pa.int64()), pa.array(b, pa.int64())], names=["rep", "n", "b"]
            )

        for t in grouped(batches, ["cell"]):
            yield ready(t)

    cell = F.xxhash64("table", "bucket", F.col("label").cast("string"), "cell_a", "cell_b", F.size("e"))
    return ordered.withColumn("cell", cell).mapInArrow(run, "rep long, n long, b long")


def near_duplicates(
    vectors: DataFrame, similarity: float = 0.93, tables: int = 24, hashes: int = 10, width: float = 1.5,
    block: int = BLOCK, seed: int = 11,
) -> DataFrame:
    """One row per vec_id: n_links (other vectors of the same non-null label
    with cosine >= ``similarity``), component_id (smallest vec_id reachable),
    kept.

    Vectors that are null, zero, or hold nulls or non-finite numbers, and those
    without label, link with nothing. Vectors of different length never
    link. Exact copies are compared once and counted with their number. A
    vec_id that occurs in several equal rows is one vector; a null vec_id gives
    one row linked with nothing. An empty table gives no rows; other columns
    are ignored. Buckets of any size are dealt to a grid of cells.
    """
    prepare(vectors.sparkSession)
    rows, classes = distinct_vectors(vectors)
    reps = rows.join(classes.withColumnRenamed("rep", "vec_id"), ["label", "key", "vec_id"]).dropDuplicates(["vec_id", "label", "key"])
    signed = stage(signatures(reps.withColumnRenamed("vec_id", "rep"), tables, hashes, width, seed), "lsh-signed")
    placed = signed.select("rep", "label", F.posexplode("buckets").alias("table", "bucket"))
    cells = grid(placed, ["table", "bucket", "label"], block, "rep").join(signed.drop("label"), "rep")
    found = stage(compare(cells, similarity), "lsh-links")
    counts = found.groupBy("rep").agg(F.sum("n").alias("others"))
    joined = components(found.where("b IS NOT NULL").select(F.col("rep").alias("a"), "b"))
    of_class = classes.join(counts, "rep", "left").join(joined.withColumnRenamed("node", "rep"), "rep", "left")
    of_class = of_class.select(
        "label", "key",
        (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"),
    )
    members = rows.select("vec_id", "label", "key").join(of_class, ["label", "key"])
    # an id with several contents belongs to all their classes
    members = members.groupBy("vec_id").agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    ids = vectors.select(F.col("vec_id").cast("long")).distinct()
    out = ids.join(members, "vec_id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")
    )
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
