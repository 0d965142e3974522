"""The bounded top-k join against all pairs: equal lists, fewer products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from knnrec.operators.neighbors import slot_topk
from knnrec.operators.predict import bounded_items, recommend, recommend_bounded, recommend_top_n, score_all_items
from knnrec.operators.similarity import mirror, similarity_half
from knnrec.operators.topk_join import item_counts, item_profile, topk_join
from knnrec.plans.exact import base_frames, fit_exact
from tests.conftest import ratings_df
from tests.fixtures import FLAT, TIES, TINY, random_ratings


def zipf_ratings(n_users=160, n_items=120, per_user=14, seed=3):
    """A few items that nearly everybody rated, and a long tail."""
    rng = np.random.default_rng(seed)
    p = 1 / np.arange(1, n_items + 1)
    rows = []
    for u in range(n_users):
        for i in rng.choice(n_items, per_user, replace=False, p=p / p.sum()):
            rows.append((u, int(i), float(rng.integers(1, 6))))
    return rows


def taste_ratings(groups=60, size=8, seed=5):
    """Small groups that agree on items of their own; ten items that most users
    found ordinary. Some users know only the latter."""
    rng = np.random.default_rng(seed)
    rows, n = [], groups * size
    for u in range(n):
        g = u // size
        if g % 10:
            rows += [(u, 1000 + g * 20 + j, float(5 if (g + j) % 2 else 1)) for j in range(14) if rng.random() < 0.9]
        rows += [(u, j, float(rng.choice([3, 3, 3, 3, 2, 4]))) for j in range(10) if rng.random() < 0.8]
    return rows


def both(spark, rows, k, **options):
    _, _, unit, _, n = base_frames(ratings_df(spark, rows))
    want = {tuple(r) for r in slot_topk(mirror(similarity_half(unit)), k, n).collect()}
    join = topk_join(unit, k, **options)
    got = {tuple(r) for r in slot_topk(join.similarities, k, n).collect()}
    return join, got, want


@pytest.mark.parametrize("rows, k", [(TINY, 20), (FLAT, 1), (TIES, 1), (random_ratings(14, 8, 0.5, 1), 3), (random_ratings(9, 5, 0.9, 2), 20)])
def test_small_tables(spark, rows, k):
    """Negatives, ties, flat users, k above the number of users."""
    _, got, want = both(spark, rows, k)
    assert got == want


@pytest.mark.parametrize("k, options", [(5, {}), (5, {"cold_share": 0.0}), (40, {"probes": 1}), (5, {"block_rows": 20})])
def test_popular_items(spark, k, options):
    _, got, want = both(spark, zipf_ratings(), k, **options)
    assert got == want and len(want) > 100


def test_skewed_table_needs_few_products(spark):
    join, got, want = both(spark, taste_ratings(), 5)
    assert got == want and len(want) > 1500
    n = join.products()
    assert n["cold"] + n["heads"] < n["all_pairs"] / 2
    # some users have no five positive partners in the tail: all their products are made
    assert join.thresholds.count() < len({r[0] for r in want})


@pytest.mark.parametrize("options", [{}, {"blocks": 7, "block_rows": 20}])
def test_lists_end_where_their_sums_are_made(spark, options):
    """Pairs of users multiplied in full are no candidates, however many they are."""
    join, got, want = both(spark, zipf_ratings(), 40, probes=1, **options)
    n = base_frames(ratings_df(spark, zipf_ratings())).n_users
    assert join.candidates.count() <= join.thresholds.count() * 160 and join.thresholds.count() < 100
    assert join.found.count() <= 160 * 40
    assert {tuple(r) for r in join.neighbors(n).collect()} == got == want


def test_items_with_a_weight_that_is_no_number_are_multiplied(spark):
    """No bound holds for them. NaN is above all other similarities."""
    _, _, unit, _, _ = base_frames(ratings_df(spark, taste_ratings()))
    odd = unit.withColumn("w", F.when((F.col("u") == 70) & (F.col("i") == 3), float("nan")).otherwise(F.col("w")))
    join = topk_join(odd, 5)
    text = lambda df: sorted(repr((r.u, r.v, round(r.sim, 8), r["rank"])) for r in df.collect())
    assert text(join.neighbors(480)) == text(slot_topk(mirror(similarity_half(odd)), 5, 480))
    assert join.candidates.count() > 0


def test_bounded_sums_are_not_shuffled_as_pairs(spark):
    """What a fit writes of pairs without a threshold is the lists, not every pair."""
    train = ratings_df(spark, random_ratings(60, 25, 0.3, 5))
    _, _, unit, _, n = base_frames(train)
    join = topk_join(unit, 3, cold_share=0.0)
    assert join.thresholds.count() == 0 and join.candidates.count() == 0
    assert {tuple(r) for r in join.neighbors(n).collect()} == {
        tuple(r) for r in slot_topk(mirror(similarity_half(unit)), 3, n).collect()}


def test_profile_and_choice(spark):
    _, _, unit, _, _ = base_frames(ratings_df(spark, taste_ratings()))
    counts = {r["i"]: r["c"] for r in item_counts(unit).collect()}
    profile = item_profile(item_counts(unit))
    assert profile.total == sum(c * (c - 1) // 2 for c in counts.values()) and profile.largest == max(counts.values())
    assert profile.skewed(100) and not profile.skewed(2000)
    empty = item_profile(item_counts(unit.limit(0)))
    assert empty.total == 0 and not empty.skewed() and topk_join(unit.limit(0), 3).similarities.count() == 0


def test_fit_by_each_method(spark):
    train = ratings_df(spark, taste_ratings(groups=20))
    lists = [{tuple(r) for r in fit_exact(train, 4, method=m, **b).neighbors.collect()}
             for m, b in (("pairs", {}), ("bounded", {}), ("auto", {"block_rows": 30}))]
    assert lists[0] == lists[1] == lists[2] and lists[0]
    with pytest.raises(ValueError, match="method"):
        fit_exact(train, 4, method="fast")


def dense_ratings(n_users=40, n_items=300, seed=9):
    rng = np.random.default_rng(seed)
    return [(u, int(i), float(rng.integers(1, 6))) for u in range(n_users) for i in rng.choice(n_items, 150, replace=False)]


@pytest.mark.parametrize("rows, n", [(dense_ratings(), 5), (zipf_ratings(), 3), (FLAT, 50)])
def test_bounded_recommendations_equal_the_matrix(spark, rows, n):
    train = ratings_df(spark, rows)
    model = fit_exact(train, 4)
    matrix = score_all_items(model)
    cell = lambda r: (r.u, r.i, round(r.prediction, 9), r["rank"])
    want = sorted(map(cell, recommend_top_n(matrix, train, n).collect()))
    got = sorted(map(cell, recommend_bounded(model, train, n).collect()))
    assert got == want
    if len(rows) > 5000:
        wanted = bounded_items(model, train, n).count()
        assert wanted < matrix.count() / 3


def test_bounded_recommendations_follow_negative_neighbours(spark):
    train = ratings_df(spark, random_ratings(6, 9, 0.6, 4))
    model = fit_exact(train, 5)
    assert model.neighbors.where("sim < 0").count() > 0
    cell = lambda r: (r.u, r.i, round(r.prediction, 9), r["rank"])
    want = sorted(map(cell, recommend_top_n(score_all_items(model), train, 2).collect()))
    for method in ("bounded", "matrix", "auto"):
        assert sorted(map(cell, recommend(model, train, 2, method).collect())) == want
    with pytest.raises(ValueError, match="method"):
        recommend(model, train, 2, "fast")


def test_recommendations_shuffle_lists_and_no_contributions(spark):
    train = ratings_df(spark, random_ratings(40, 20, 0.3, 8))
    model = fit_exact(train, 3)
    for df in (score_all_items(model), recommend(model, train, 2, "matrix")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not [x for x in plan.splitlines() if "Exchange hashpartitioning(u#" in x and " i#" in x.split("[")[0].split("),")[0]]
    model.unpersist()


def test_bounded_recommendations_score_items_where_the_lists_meet(spark):
    """Only probes are looked up by (neighbour, item)."""
    train = ratings_df(spark, random_ratings(40, 20, 0.3, 8))
    model = fit_exact(train, 3)
    plan = recommend_bounded(model, train, 2)._jdf.queryExecution().executedPlan().toString()
    lookups = [x for x in plan.splitlines() if "Join" in x and " [v#" in x and "i#" in x.split("[v#")[1].split("]")[0]]
    assert len(lookups) == 1
    model.unpersist()
