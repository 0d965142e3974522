"""Sparse products and cosine similarity between users.

All products are equi-joins on the shared index followed by a partial
aggregate. A join key that holds a large share of the rows (one item
rated by a third of all users) is split into a grid of blocks so that no
single task receives the whole quadratic group."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knnrec.functions.columns import SIM_DIGITS, snap
from knnrec.session import materialize

# Rows of one side of a cell: a key with more rows on a side is split into
# ceil(rows / CELL_ROWS) blocks per side, so no cell holds more than about
# CELL_ROWS^2 = 4 million products, whatever the number of such keys.
CELL_ROWS = 2_000
# A list of hot keys of up to this many rows (a few MB) is broadcast.
BROADCAST_KEYS = 100_000
# So is the right side of a product of up to this many rows.
SMALL_ROWS = 100_000


def hot_key_blocks(frames: Sequence[DataFrame], keys: Sequence[str], block_rows: int = CELL_ROWS) -> DataFrame:
    """``(keys..., _nb)`` for every key whose rows (largest side) exceed
    ``block_rows``. Counting is a partial aggregate over the key columns."""
    counted = [f.groupBy(*keys).agg(F.count(F.lit(1)).alias("_cnt")) for f in frames]
    counts = counted[0] if len(counted) == 1 else counted[0].unionByName(counted[1]).groupBy(*keys).agg(
        F.max("_cnt").alias("_cnt"))
    hot = counts.where(F.col("_cnt") > block_rows)
    return hot.select(*keys, F.ceil(F.col("_cnt") / F.lit(block_rows)).cast("int").alias("_nb"))


def blocked_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_id: str,
    right_id: str,
    condition: Callable[[], Column] | None = None,
    block_rows: int = CELL_ROWS,
    self_join: bool = False,
    largest: int | None = None,
) -> DataFrame:
    """Inner equi-join on ``keys`` (same names on both sides; all other
    column names must differ). A hot key with ``nb`` blocks sends each left
    row to block row ``hash(left_id) % nb`` of every block column and each
    right row to block column ``hash(right_id) % nb`` of every block row,
    so each (left, right) pair still meets exactly once, in one of
    ``nb * nb`` cells. Cold keys keep a single block: no replication.

    The hot keys are counted when the plan is made: without any, this is a
    plain join; a list within ``BROADCAST_KEYS`` is broadcast, a longer one
    joined like any table. ``self_join``: both sides have the same key counts
    (count once). ``largest``: the most rows a key has, where that is known;
    up to ``block_rows`` nothing is counted."""
    n_hot = 0
    if largest is None or largest > block_rows:
        frames = [left] if self_join else [left, right]
        hot = materialize(hot_key_blocks(frames, keys, block_rows))
        n_hot = hot.count()
        if n_hot <= BROADCAST_KEYS:
            hot = F.broadcast(hot)
    if not n_hot:
        other = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
        same = [F.col(k) == F.col(f"_r_{k}") for k in keys] + ([condition()] if condition is not None else [])
        return left.join(other, reduce(lambda a, b: a & b, same)).drop(*[f"_r_{k}" for k in keys])

    def tagged(df: DataFrame) -> DataFrame:
        out = df.join(hot, list(keys), "left")
        return out.withColumn("_nb", F.coalesce(F.col("_nb"), F.lit(1)))

    def own_block(id_col: str) -> Column:
        return F.pmod(F.xxhash64(F.col(id_col)), F.col("_nb")).cast("int")

    every_block = F.explode(F.sequence(F.lit(0), F.col("_nb") - 1))
    left_cols = [c for c in left.columns if c not in keys]
    right_cols = [c for c in right.columns if c not in keys]
    lt = tagged(left).select(*keys, *left_cols, own_block(left_id).alias("_bx"), every_block.alias("_by"))
    rt = tagged(right).select(
        *[F.col(k).alias(f"_r_{k}") for k in keys], *right_cols,
        every_block.alias("_r_bx"), own_block(right_id).alias("_r_by"),
    )
    cond = [F.col(k) == F.col(f"_r_{k}") for k in keys]
    cond += [F.col("_bx") == F.col("_r_bx"), F.col("_by") == F.col("_r_by")]
    if condition is not None:
        cond.append(condition())
    joined = lt.join(rt, reduce(lambda a, b: a & b, cond), "inner")
    return joined.drop("_bx", "_by", "_r_bx", "_r_by", *[f"_r_{k}" for k in keys])


def sparse_matmul(a: DataFrame, b: DataFrame, small: int = SMALL_ROWS, **blocking) -> DataFrame:
    """``a(row, k, val) @ b(k, col, val)`` in coordinate form; zero results
    are not stored.

    A ``b`` of at most ``small`` rows (counted when the plan is made) goes to
    every task and ``a`` is dealt by ``row``: each sum ends in the task that makes
    its products, so that ``a`` is shuffled and not the products. With a larger
    one the products meet in a ``blocked_join``."""
    left = a.select("row", "k", F.col("val").alias("_a"))
    right = b.select("k", "col", F.col("val").alias("_b"))
    if right.limit(small + 1).count() <= small:
        joined = left.repartition("row").join(F.broadcast(right), "k")
    else:
        joined = blocked_join(left, right, ["k"], "row", "col", **blocking)
    product = joined.groupBy("row", "col").agg(F.sum(F.col("_a") * F.col("_b")).alias("val"))
    return product.where(F.col("val") != 0)


def similarity_half(
    unit: DataFrame,
    scenario: Sequence[str] = (),
    block: Sequence[str] = (),
    carry: Sequence[str] = (),
    digits: int = SIM_DIGITS,
    **blocking,
) -> DataFrame:
    """Cosine similarity of every co-rating pair ``u < v`` (each unordered
    pair once, so the join emits half the products).

    ``unit`` holds ``(scenario..., block..., u, i, w, carry...)``; pairs
    meet on ``(scenario, block, i)``. The sum is snapped to ``digits``
    decimals and zeros are dropped. ``carry`` columns are functions of the
    user; both sides' values are kept, suffixed ``_v`` on the right (whole
    numbers, so that the aggregate stays a hash aggregate)."""
    keys = [*scenario, *block, "i"]
    left = unit.select(*keys, "u", "w", *carry)
    right = unit.select(
        *keys, F.col("u").alias("v"), F.col("w").alias("w_v"),
        *[F.col(c).alias(f"{c}_v") for c in carry],
    )

    joined = blocked_join(left, right, keys, "u", "v", condition=lambda: F.col("u") < F.col("v"),
                          self_join=True, **blocking)
    return aggregate_products(joined, scenario, [*carry, *(f"{c}_v" for c in carry)], digits)


def aggregate_products(joined: DataFrame, scenario: Sequence[str] = (), carry: Sequence[str] = (),
                       digits: int = SIM_DIGITS) -> DataFrame:
    sims = joined.groupBy(*scenario, "u", "v").agg(
        snap(F.sum(F.col("w") * F.col("w_v")), digits).alias("sim"),
        *[F.any_value(c).alias(c) for c in carry],
    )
    return sims.where(F.col("sim") != 0)


def mirror(half: DataFrame) -> DataFrame:
    """Both directions of each unordered pair: a union of two projections
    (no per-row array allocation, which a generator would need; the half
    table is usually persisted, so the second scan is cheap)."""
    other = [c for c in half.columns if c not in ("u", "v")]
    forward = half.select("u", "v", *other)
    backward = half.select(F.col("v").alias("u"), F.col("u").alias("v"), *other)
    return forward.unionByName(backward)


def similarity_for_users(unit: DataFrame, users: DataFrame, **blocking) -> DataFrame:
    """Directed similarities ``(u, v, sim)`` from the requested users to
    everyone. The requested rows are a semi-join of ``unit``; when they are
    small, adaptive execution broadcasts them from their measured size."""
    chosen = unit.join(users.select("u").distinct(), "u", "left_semi")
    left = chosen.select("i", "u", "w")
    right = unit.select("i", F.col("u").alias("v"), F.col("w").alias("w_v"))
    joined = blocked_join(left, right, ["i"], "u", "v",
                          condition=lambda: F.col("u") != F.col("v"), **blocking)
    return aggregate_products(joined)


def similarity_lookup(sims: DataFrame, pairs: DataFrame) -> DataFrame:
    """``(u, v, sim)`` for requested pairs; a pair without a stored
    similarity reads 0."""
    return pairs.select("u", "v").join(sims.select("u", "v", "sim"), ["u", "v"], "left").select(
        "u", "v", F.coalesce(F.col("sim"), F.lit(0.0)).alias("sim")
    )


def similarity_for_pairs(unit: DataFrame, pairs: DataFrame, digits: int = SIM_DIGITS) -> DataFrame:
    """``(u, v, sim)`` for requested pairs straight from the unit rows: the
    pairs meet the ratings of ``u``, then those of ``v`` on the same item, so
    the work follows the pairs, not the number of co-rating users. A pair
    without a common item reads 0."""
    wanted = pairs.select("u", "v").distinct()
    left = wanted.join(unit.select("u", "i", "w"), "u")
    right = unit.select(F.col("u").alias("v"), "i", F.col("w").alias("w_v"))
    return similarity_lookup(aggregate_products(left.join(right, ["v", "i"]), digits=digits), wanted)
