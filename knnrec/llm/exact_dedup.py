"""Exact duplicates with heavy digests split off.

A text's digest is the SHA-256 of its lower-cased (A-Z only) UTF-8 bytes.
Mergeable Misra-Gries sketches (``approx_top_k_accumulate`` and ``_combine``:
counters, all lowered when there are too many) name every digest that may hold
more than 1 / ``HEAVY`` of the rows. These at most ``HEAVY`` candidates are
counted exactly; those verified are broadcast with the row that stays, so that
their copies are settled in the scan. All other digests, which hold a bounded
share of the rows each, are shuffled.

DataFrame functions only: no Python worker takes part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from knnrec.llm.common import stage

#: Digests with more than 1 / HEAVY of the rows are heavy: at most HEAVY exist.
HEAVY = 1000
#: Counters of a sketch. Its error is below 3.5 / 8192 of the rows.
COUNTERS = 6000
#: Sketches are merged in this many groups before the last merge.
MERGERS = 64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(text: Column) -> Column:
    """SHA-256 (binary) of the text with A-Z lower-cased; null counts as ''."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    ascii_only = F.octet_length(text) == F.char_length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.unhex(F.sha2(lowered.cast("binary"), 256))


def heavy_digests(rows: DataFrame) -> DataFrame:
    """digest, group_size, winner (doc_id, tie) of the digests that hold more
    than 1 / HEAVY of ``rows``: a table of at most HEAVY rows."""
    spark = rows.sparkSession
    sketches = rows.groupBy(F.pmod(F.spark_partition_id(), F.lit(MERGERS)).alias("m")).agg(
        F.expr(f"approx_top_k_accumulate(hex(digest), {COUNTERS})").alias("s"), F.count(F.lit(1)).alias("n")
    )
    merged = sketches.groupBy(F.lit("all")).agg(F.expr(f"approx_top_k_combine(s, {COUNTERS})").alias("s"), F.sum("n").alias("n"))
    top = merged.select("n", F.expr(f"approx_top_k_estimate(s, {HEAVY})").alias("top")).first()
    n = top["n"] if top else 0
    # the estimates are upper bounds, so no heavy digest is missing
    named = [(bytearray.fromhex(t["item"]),) for t in (top["top"] if top else []) if t["count"] * HEAVY > n]
    candidates = F.broadcast(spark.createDataFrame(named, "digest binary"))
    verified = (
        rows.join(candidates, "digest")
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("group_size"), F.max(F.struct("doc_id", "tie")).alias("winner"))
        .where(F.col("group_size") * HEAVY > n)
    )
    return spark.createDataFrame(verified.collect(), verified.schema)  # <= HEAVY rows


def mark(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, keep_id (doc_id of
    the row that stays of all with an equal text: the largest), group_size,
    kept, text_sha256.

    A null text counts as empty. A null doc_id is smaller than any; where only
    such rows share a text, keep_id is null. Of rows with equal text and id one
    is kept. An empty table gives no rows; other columns are ignored.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), digest(F.col("text")).alias("digest"),
        F.monotonically_increasing_id().alias("tie"),
    )
    rows = stage(rows, "dedup-digests")  # the texts are read once; ties are settled for good
    heavy = F.broadcast(heavy_digests(rows))
    in_scan = rows.join(heavy, "digest")
    same = Window.partitionBy("digest")
    shuffled = rows.join(heavy.select("digest"), "digest", "left_anti").select(
        "*", F.count(F.lit(1)).over(same).alias("group_size"), F.max(F.struct("doc_id", "tie")).over(same).alias("winner")
    )
    return in_scan.unionByName(shuffled).select(
        "doc_id", F.col("winner.doc_id").alias("keep_id"), "group_size", (F.col("tie") == F.col("winner.tie")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_last(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns. Copies of a
    heavy text are dropped in the scan, before any text is shuffled; of the
    rest at most one row of a text leaves each task."""
    k = len(docs.columns)
    wide = docs.select(
        "*", F.col("doc_id").cast("long"), digest(F.col("text")), F.lit(0).alias("tie")
    ).toDF(*(f"c{i}" for i in range(k)), "doc_id", "digest", "tie")
    heavy = F.broadcast(heavy_digests(stage(wide.select("doc_id", "digest", "tie"), "dedup-digests")))
    left = wide.join(heavy, "digest", "left")
    left = left.where(F.col("winner").isNull() | F.col("winner.doc_id").eqNullSafe(F.col("doc_id")))
    order = Window.partitionBy("digest").orderBy(F.col("doc_id").desc_nulls_last())
    first = left.withColumn("place", F.row_number().over(order)).where("place = 1")
    return first.select(*(f"c{i}" for i in range(k))).toDF(*docs.columns)
