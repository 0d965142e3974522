"""Similarities made in blocks of users, against pairs that are shuffled."""

import re

import pytest
from pyspark.sql import functions as F

from knnrec.operators import user_blocks
from knnrec.operators.neighbors import slot_topk
from knnrec.operators.similarity import mirror, similarity_half
from knnrec.plans.approximate import (
    candidate_similarities, level_candidates, part_arrays, part_similarities, part_topk, per_part_topk,
)
from knnrec.plans.exact import base_frames, fit_exact
from tests.conftest import ratings_df
from tests.fixtures import random_ratings


@pytest.fixture
def unit(spark):
    return base_frames(ratings_df(spark, random_ratings(60, 25, 0.3, 5)), "none").unit


def rows_of(df):
    return sorted(tuple(round(x, 8) if isinstance(x, float) else x for x in r) for r in df.collect())


@pytest.mark.parametrize("blocks, block_rows, held", [(1, 2_000, 2_000_000), (9, 4, 50), (9, 2, 1)])
def test_blocks_give_the_lists_of_all_pairs(unit, monkeypatch, blocks, block_rows, held):
    monkeypatch.setattr(user_blocks, "HELD_PRODUCTS", held)
    pairs = mirror(similarity_half(unit))
    options = {"block_rows": block_rows, "blocks": blocks}
    for k, n in ((3, 60), (59, 70)):
        got = user_blocks.block_topk(unit, k, n, 0, **options)
        assert rows_of(got) == rows_of(slot_topk(pairs, k, n))


def test_rows_without_a_weight_or_an_item(unit):
    odd = unit.withColumn("w", F.when((F.col("u") + F.col("i")) % 7 == 0, None).when(
        (F.col("u") == 3) & (F.col("i") % 2 == 0), float("nan")).otherwise(F.col("w")))
    odd = odd.withColumn("i", F.when(F.col("i") != 5, F.col("i")))
    want = slot_topk(mirror(similarity_half(odd)), 4, 60)
    text = lambda df: sorted(map(repr, rows_of(df)))  # noqa: E731  (NaN does not equal itself)
    assert text(user_blocks.block_topk(odd, 4, 60, 0, blocks=3)) == text(want)


def test_a_fit_shuffles_no_pairs(spark, monkeypatch):
    monkeypatch.setattr(user_blocks, "BLOCK_PRODUCTS", 50)
    train = ratings_df(spark, random_ratings(40, 20, 0.3, 8))
    plan = fit_exact(train, 3, persist="none").neighbors._jdf.queryExecution().executedPlan().toString()
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert any("block#" in line for line in shuffles) and not any("(u#" in line and " v#" in line for line in shuffles)


def test_blocks_grow_with_the_products():
    assert user_blocks.block_count(0) == 1
    assert user_blocks.block_count(10 ** 9) == 10 * user_blocks.block_count(10 ** 8) == 4000


def test_no_ratings(spark):
    none = spark.createDataFrame([], "u long, i long, w double")
    assert user_blocks.block_topk(none, 3, 0, 0).count() == 0


@pytest.mark.parametrize("blocks, block_rows, held", [(1, 2_000, 2_000_000), (9, 4, 50), (9, 2, 1)])
def test_all_similarities_without_a_shuffle_of_pairs(unit, monkeypatch, blocks, block_rows, held):
    monkeypatch.setattr(user_blocks, "HELD_PRODUCTS", held)
    got = user_blocks.all_similarities(unit, block_rows=block_rows, blocks=blocks)
    half = user_blocks.all_similarities(unit, half=True, block_rows=block_rows, blocks=blocks)
    assert rows_of(got) == rows_of(user_blocks.turned(half)) == rows_of(mirror(similarity_half(unit)))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not any("(u#" in x and " v#" in x for x in plan.splitlines() if "Exchange hashpartitioning" in x)


def part_frames(unit, partitions=4, depth=1, order="keyed"):
    arrays = part_arrays(unit.select("u").distinct(), partitions, depth, order)
    return unit, arrays, partitions, depth


def test_lists_and_pairs_of_parts_as_from_candidates(unit, monkeypatch):
    monkeypatch.setattr(user_blocks, "HELD_PRODUCTS", 500)
    frames = part_frames(unit.persist(), 5, 2)
    cands = candidate_similarities(*frames, method="filter").persist()
    assert rows_of(part_similarities(*frames, blocks=5)) == rows_of(cands.select("u", "v", "sim"))
    n = 62  # negatives come into the lists
    want = per_part_topk(level_candidates(cands, [2]), 59, n).drop("level")
    assert rows_of(part_topk(*frames, 59, n, blocks=5)) == rows_of(want)


def test_no_pair_is_shuffled_for_the_lists_of_parts(unit):
    """Ratings and lists are: no exchange is by a pair."""
    for df in (part_similarities(*part_frames(unit)), part_topk(*part_frames(unit), 3, 60)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "MapInArrow" in plan
        assert not re.search(r"hashpartitioning\(u#\d+L, v#\d+L", plan)


def test_ratings_are_shuffled_once_for_both_lists(unit):
    plan = user_blocks.block_topk(unit, 3, 60, 100, 25)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(i#\d+", plan)) == 1


def wide_ratings(spark):
    """Users that meet few of the others, as ``coarse_fits`` asks."""
    return ratings_df(spark, random_ratings(300, 400, 0.012, 11))


@pytest.mark.parametrize("blocks, block_rows, held", [(1, 2_000, 2_000_000), (9, 3, 40), (9, 2, 1)])
def test_coarse_lists_give_the_lists_of_all_pairs(spark, monkeypatch, blocks, block_rows, held):
    monkeypatch.setattr(user_blocks, "HELD_PRODUCTS", held)
    unit = base_frames(wide_ratings(spark), "none").unit.persist()
    options = {"block_rows": block_rows, "blocks": blocks}
    for k in (1, 4, 60):
        want = rows_of(slot_topk(mirror(similarity_half(unit)), k, 300))
        assert want == rows_of(user_blocks.coarse_topk(unit, k, 0, **options))
    assert rows_of(user_blocks.coarse_topk(unit, 4, 0, 40, blocks=7)) == rows_of(slot_topk(mirror(similarity_half(unit)), 4, 300))


def test_coarse_lists_of_repeated_and_missing_ratings(spark):
    unit = base_frames(wide_ratings(spark), "none").unit
    odd = unit.unionByName(unit.where("(u + i) % 3 = 0").withColumn("w", F.col("w") / 2))
    odd = odd.withColumn("w", F.when(F.col("u") % 11 != 0, F.col("w"))).withColumn("i", F.when(F.col("i") != 7, F.col("i"))).persist()
    want = rows_of(slot_topk(mirror(similarity_half(odd)), 5, 300))
    assert rows_of(user_blocks.coarse_topk(odd, 5, 0, blocks=5)) == want


def test_equal_similarities_in_coarse_lists(spark):
    """Weights that one step does not tell apart; ties go to the lower id."""
    rows = [(u, i, w) for u in range(40) for i, w in ((0, 0.6 + (u % 3) * 1e-6), (u + 1, 0.8))]
    unit = spark.createDataFrame(rows, "u long, i long, w double")
    want = rows_of(slot_topk(mirror(similarity_half(unit)), 3, 1000))
    assert rows_of(user_blocks.coarse_topk(unit, 3, 0, blocks=3)) == want


def test_where_coarse_lists_fit(spark):
    unit = spark.createDataFrame([(1, 1, 0.5), (2, 1, -1.0)], "u long, i long, w double")
    assert user_blocks.coarse_fits(unit, 3, 100, 10, 10)
    assert not user_blocks.coarse_fits(unit, 10, 100, 10, 10)  # a user may meet 90 others
    for w in (1.5, float("nan"), float("inf")):
        assert not user_blocks.coarse_fits(unit.withColumn("w", F.lit(w)), 3, 100, 10, 10)
    assert user_blocks.coarse_fits(unit.limit(0), 3, 100, 0, 0)


def test_a_fit_takes_coarse_lists_where_they_fit(spark):
    train = wide_ratings(spark)
    model = fit_exact(train, 3, persist="none")
    plan = model.neighbors._jdf.queryExecution().executedPlan().toString()
    assert "as tinyint" in plan and not re.search(r"hashpartitioning\(u#\d+L, v#\d+L", plan)
    unit = base_frames(train, "none").unit
    assert rows_of(model.neighbors) == rows_of(slot_topk(mirror(similarity_half(unit)), 3, 300))


def test_tasks_of_lists_follow_the_products(spark, unit):
    """Not the bytes they read, of which the lists are a multiple."""
    few, many = (user_blocks.list_tasks(unit, n) for n in (100, 2 * 10 ** 9))
    assert few == spark.sparkContext.defaultParallelism and many == 1000
    plan = user_blocks.block_topk(unit, 3, 60, 10 ** 8, 25)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Exchange hashpartitioning\(i#\d+L, 50\), REPARTITION_BY_NUM", plan)


@pytest.mark.parametrize("shift", [0, 255, 70_000, 2 ** 40, -5, -2 ** 62])
def test_ids_of_coarse_lists_are_kept_whole(spark, shift):
    unit = base_frames(wide_ratings(spark), "none").unit.withColumn("u", F.col("u") + F.lit(shift))
    want = rows_of(slot_topk(mirror(similarity_half(unit)), 3, 300))
    assert rows_of(user_blocks.coarse_topk(unit, 3, 0, 40, blocks=4)) == want
