"""Connected components of a link table, and grids for large groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knnrec.llm.common import stage


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b: two ids of one
    type); component is the smallest id reachable. Nulls link nothing.

    Large-star and small-star steps in turn: every node hands its larger
    neighbours, then its smaller ones, to its smallest neighbour, until each
    node points straight at the smallest one. Each step is a partial minimum
    and a join on the node, so a node with very many links is split by
    adaptive execution; every round is written out, which cuts the lineage.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges = stage(edges, "cc")
    last = None
    for _ in range(max_rounds):
        both = edges.union(edges.select("v", "u")).toDF("u", "v")
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(low, "u").where("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = stage(small.select("e.*").where("u <> v").distinct(), "cc")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == last:
            break
        last = state
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(edges.select("v", "v").distinct())


def grid(rows: DataFrame, keys: list[str], block: int, spread: str) -> DataFrame:
    """Rows of each group (``keys``) dealt to cells, so that any two rows of a
    group meet in exactly one cell and no cell holds many more than 2 x
    ``block`` rows. Adds ``cell_a``, ``cell_b`` (a <= b) and ``side`` (block of
    the row); a cell with a = b compares its rows with each other, one with a <
    b the rows of side a with those of side b. Groups of one row are dropped.
    ``spread`` deals rows to blocks by hash, so equal values share a block.
    """
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_")).where("n_ > 1")
    blocks = F.ceil(F.col("n_") / F.lit(block)).cast("int")
    dealt = rows.join(sizes.select(*keys, blocks.alias("blocks_")), keys)
    dealt = dealt.withColumn("side", F.pmod(F.xxhash64(spread, F.lit(17)), F.col("blocks_")).cast("int"))
    dealt = dealt.withColumn("other_", F.explode(F.sequence(F.lit(0), F.col("blocks_") - 1)))
    return dealt.select(
        *rows.columns, "side", F.least("side", "other_").alias("cell_a"), F.greatest("side", "other_").alias("cell_b")
    )
