import math

import pytest
from pyspark.sql import functions as F

from knnrec.operators import stats as st
from knnrec.operators.evaluate import mae, user_average_predictions
from knnrec.operators.normalize import normalized_deviations, unit_ratings, user_norms
from knnrec.operators.predict import recommend_top_n, score_all_items, score_pairs
from knnrec.operators.similarity import mirror, similarity_half, sparse_matmul
from knnrec.plans.exact import fit_exact
from tests.conftest import ratings_df
from tests.fixtures import FLAT, TIES, TINY, TINY_SIMS, dense_reference, planted, random_ratings

S2 = 1 / math.sqrt(2)


def as_dict(df, key_cols, val_col):
    return {tuple(r[c] for c in key_cols): r[val_col] for r in df.collect()}


def test_tiny_deviations_and_units(spark):
    train = ratings_df(spark, TINY)
    stats = st.user_stats(train)
    assert as_dict(stats, ["u"], "avg_rating") == {(1,): 3.0, (2,): 3.0, (3,): 3.0, (4,): 3.0}
    devs = as_dict(normalized_deviations(train, stats), ["u", "i"], "dev")
    assert devs[(1, 1)] == 1.0 and devs[(1, 2)] == 0.0 and devs[(1, 3)] == -1.0
    assert devs[(2, 1)] == 0.5 and devs[(2, 2)] == -0.5
    norms = as_dict(user_norms(normalized_deviations(train, stats)), ["u"], "norm")
    assert norms[(1,)] == pytest.approx(math.sqrt(2)) and norms[(2,)] == pytest.approx(math.sqrt(0.5))
    unit = as_dict(unit_ratings(normalized_deviations(train, stats)), ["u", "i"], "w")
    assert unit[(1, 1)] == pytest.approx(S2) and unit[(4, 1)] == pytest.approx(-S2)


def test_tiny_similarities(spark):
    train = ratings_df(spark, TINY)
    stats = st.user_stats(train)
    unit = unit_ratings(normalized_deviations(train, stats))
    half = as_dict(similarity_half(unit), ["u", "v"], "sim")
    assert half == pytest.approx(TINY_SIMS)
    both = mirror(similarity_half(unit))
    assert both.count() == 2 * len(TINY_SIMS)
    assert as_dict(both, ["u", "v"], "sim")[(4, 1)] == -0.5


def test_tiny_slot_rule(spark):
    # n = 4, k = 2. u3 has a zero entry (u4) above its negative, u4 has one
    # zero entry (u3) so only its first negative fits.
    model = fit_exact(ratings_df(spark, TINY), 2)
    nb = {(r.u, r.v): (r.sim, r.rank) for r in model.neighbors.collect()}
    assert nb == {
        (1, 2): (0.5, 1), (1, 3): (0.5, 2),
        (2, 1): (0.5, 1), (2, 3): (-0.5, 2),
        (3, 1): (0.5, 1),
        (4, 1): (-0.5, 2),
    }
    model.unpersist()


def test_tiny_predictions(spark):
    model = fit_exact(ratings_df(spark, TINY), 2)
    pairs = spark.createDataFrame(
        [(3, 1), (4, 3), (4, 2), (2, 3), (1, 99), (9, 1)], "u long, i long")
    pred = as_dict(score_pairs(pairs, model), ["u", "i"], "prediction")
    assert pred[(3, 1)] == pytest.approx(5.0)   # neighbour u1 dev +1 -> top of the scale
    assert pred[(4, 3)] == pytest.approx(5.0)   # sim -.5 x dev -1 -> +1
    assert pred[(4, 2)] == pytest.approx(3.0)   # the only rater has dev 0
    assert pred[(2, 3)] == pytest.approx(3.0)   # contributions cancel
    assert pred[(1, 99)] == pytest.approx(3.0)  # unseen item: user average
    assert pred[(9, 1)] == pytest.approx(3.0)   # cold user: global average (30 / 10)
    model.unpersist()


def test_flat_user(spark):
    model = fit_exact(ratings_df(spark, FLAT), 3)
    nb = model.neighbors.collect()
    assert all(r.u != 5 and r.v != 5 for r in nb)
    pairs = spark.createDataFrame([(5, 3)], "u long, i long")
    assert score_pairs(pairs, model).first().prediction == 4.0
    model.unpersist()


def test_cold_user_gets_global_average(spark):
    rows = [(1, 1, 5), (1, 2, 1), (2, 1, 4), (2, 2, 2), (3, 1, 1)]
    model = fit_exact(ratings_df(spark, rows), 2)
    pairs = spark.createDataFrame([(7, 1)], "u long, i long")
    assert score_pairs(pairs, model).first().prediction == pytest.approx(13 / 5)
    model.unpersist()


def test_ties_keep_lower_id_first(spark):
    model = fit_exact(ratings_df(spark, TIES), 1)
    nb = {(r.u, r.v): r.sim for r in model.neighbors.collect() if r.u == 1}
    assert list(nb) == [(1, 2)]
    model2 = fit_exact(ratings_df(spark, TIES), 2)
    both = sorted((r.v, r.rank) for r in model2.neighbors.collect() if r.u == 1)
    assert both == [(2, 1), (3, 2)]
    model.unpersist()
    model2.unpersist()


@pytest.mark.parametrize("k", [1, 3, 8, 18, 19, 25])
def test_slot_rule_matches_dense_brute_force(spark, k):
    rows = random_ratings(20, 12, 0.35, seed=k)
    expected, *_ = dense_reference(rows, k)
    model = fit_exact(ratings_df(spark, rows), k)
    got = {}
    for r in model.neighbors.collect():
        got.setdefault(r.u, set()).add((r.v, round(r.sim, 9)))
    assert {u: s for u, s in expected.items() if s} == got
    model.unpersist()


def brute_predictions(rows, k, pairs):
    nbrs, S, users, items, D, M, avg = dense_reference(rows, k)
    ui = {u: a for a, u in enumerate(users)}
    ii = {i: a for a, i in enumerate(items)}
    gavg = sum(r for _, _, r in rows) / len(rows)
    out = {}
    for u, i in pairs:
        if u not in ui:
            out[(u, i)] = gavg
            continue
        a = avg[ui[u]]
        num = den = 0.0
        if i in ii:
            for v, s in nbrs[u]:
                if M[ui[v], ii[i]]:
                    num += s * D[ui[v], ii[i]]
                    den += abs(s)
        w = num / den if den else 0.0
        if w == 0:
            out[(u, i)] = a
        else:
            x = a + w
            sc = 5 - a if x > a else (a - 1 if x < a else 1.0)
            out[(u, i)] = a + w * sc
    return out


@pytest.mark.parametrize("k", [2, 5, 30])
def test_predictions_match_brute_force(spark, k):
    rows = random_ratings(30, 15, 0.4, seed=100 + k)
    pairs = [(u, i) for u in range(0, 32, 3) for i in range(0, 16, 2)]
    expected = brute_predictions(rows, k, pairs)
    model = fit_exact(ratings_df(spark, rows), k)
    df = spark.createDataFrame(pairs, "u long, i long")
    got = as_dict(score_pairs(df, model), ["u", "i"], "prediction")
    assert got == pytest.approx(expected, abs=1e-9)
    for value in got.values():
        assert 1.0 <= value <= 5.0
    model.unpersist()


def test_similarities_symmetric_and_bounded(spark):
    rows = random_ratings(25, 10, 0.5, seed=3)
    unit = unit_ratings(normalized_deviations(ratings_df(spark, rows), st.user_stats(ratings_df(spark, rows))))
    sims = as_dict(mirror(similarity_half(unit)), ["u", "v"], "sim")
    for (u, v), s in sims.items():
        assert sims[(v, u)] == s
        assert -1.0 - 1e-9 <= s <= 1.0 + 1e-9


def test_hot_key_blocking_is_exact(spark):
    rows = random_ratings(40, 6, 0.8, seed=11)
    train = ratings_df(spark, rows)
    unit = unit_ratings(normalized_deviations(train, st.user_stats(train)))
    plain = as_dict(similarity_half(unit), ["u", "v"], "sim")
    split = as_dict(similarity_half(unit, block_rows=3), ["u", "v"], "sim")
    assert split == plain


def test_planted_groups_beat_user_average(spark):
    rows = planted()
    train_rows = [x for x in rows if (x[0] * 7 + x[1]) % 5 != 0]
    test_rows = [x for x in rows if (x[0] * 7 + x[1]) % 5 == 0]
    train, test = ratings_df(spark, train_rows), ratings_df(spark, test_rows)
    model = fit_exact(train, 5)
    knn = mae(score_pairs(test, model)).first().mae
    base = mae(user_average_predictions(test, model.user_stats, model.global_avg)).first().mae
    assert knn < base
    model.unpersist()


def test_score_all_items_and_recommend(spark):
    rows = random_ratings(15, 10, 0.4, seed=5)
    k = 4
    train = ratings_df(spark, rows)
    model = fit_exact(train, k)
    all_scores = as_dict(score_all_items(model), ["u", "i"], "prediction")
    pairs = list(all_scores)
    expected = brute_predictions(rows, k, pairs)
    assert all_scores == pytest.approx(expected, abs=1e-9)
    rec = recommend_top_n(score_all_items(model), train, 2).collect()
    rated = {(u, i) for u, i, _ in rows}
    assert all((r.u, r.i) not in rated for r in rec)
    per_user = {}
    for r in rec:
        per_user.setdefault(r.u, []).append(r.prediction)
    assert all(len(v) <= 2 for v in per_user.values())
    model.unpersist()


def test_sparse_matmul_matches_numpy(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    A = (rng.random((6, 5)) < 0.5) * rng.integers(1, 4, (6, 5))
    B = (rng.random((5, 7)) < 0.5) * rng.integers(-2, 3, (5, 7))
    a = spark.createDataFrame([(int(r), int(c), float(A[r, c])) for r, c in zip(*A.nonzero())],
                              "row long, k long, val double")
    b = spark.createDataFrame([(int(r), int(c), float(B[r, c])) for r, c in zip(*B.nonzero())],
                              "k long, col long, val double")
    C = A @ B
    got = as_dict(sparse_matmul(a, b, block_rows=2), ["row", "col"], "val")
    want = {(int(r), int(c)): float(C[r, c]) for r, c in zip(*C.nonzero())}
    assert got == want


def test_sparse_matmul_shuffles_the_left_side_and_not_the_products(spark):
    # 40 rows x 3 hot keys, and 3 keys x 30 columns: 3,600 products
    a = spark.range(120).selectExpr("id DIV 3 AS row", "id % 3 AS k", "CAST(id AS DOUBLE) AS val")
    b = spark.range(90).selectExpr("id % 3 AS k", "id DIV 3 AS col", "1D AS val")
    product = sparse_matmul(a, b, block_rows=2)
    plan = product._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(row#") == 1 and "col#" not in "".join(
        line for line in plan.splitlines() if "Exchange hashpartitioning" in line)
    got = as_dict(product, ["row", "col"], "val")
    assert got == as_dict(sparse_matmul(a, b, small=0, block_rows=2), ["row", "col"], "val")
    assert len(got) == 1200


def test_dataset_shape_and_sums(spark):
    train = ratings_df(spark, TINY)
    shape = st.dataset_shape(train).first()
    assert (shape.n_users, shape.n_items, shape.n_ratings) == (4, 4, 10)
    assert as_dict(st.sum_along_axis(train, 1), ["u"], "total")[(1,)] == 9.0
    assert as_dict(st.sum_along_axis(train, 0), ["i"], "total")[(1,)] == 11.0
    summ = st.rating_summary(train).where(F.col("u") == 2).first()
    assert summ.mean == 3.0 and summ.std == 1.0


def test_every_key_above_the_bound_is_split(spark):
    from knnrec.operators.similarity import hot_key_blocks

    rows = random_ratings(60, 30, 0.8, seed=12)
    train = ratings_df(spark, rows)
    unit = unit_ratings(normalized_deviations(train, st.user_stats(train)))
    count = {r.i: r["count"] for r in unit.groupBy("i").count().collect()}
    hot = {r.i: r._nb for r in hot_key_blocks([unit.select("i")], ["i"], block_rows=10).collect()}
    assert hot == {i: -(-c // 10) for i, c in count.items() if c > 10} and len(hot) == 30
    plain = as_dict(similarity_half(unit), ["u", "v"], "sim")
    assert as_dict(similarity_half(unit, block_rows=10), ["u", "v"], "sim") == plain


def test_no_limit_and_no_forced_broadcast_of_hot_keys(spark):
    train = ratings_df(spark, random_ratings(20, 10, 0.5, seed=1))
    unit = unit_ratings(normalized_deviations(train, st.user_stats(train)))
    plan = similarity_half(unit)._jdf.queryExecution().optimizedPlan().toString()
    assert "Limit" not in plan and "hint" not in plan.lower() and "strategy=broadcast" not in plan


def test_repeated_train_rows_keep_cosines_in_range(spark):
    rows = random_ratings(15, 8, 0.6, seed=3)
    repeated = ratings_df(spark, rows + rows[:40] + rows[:10])
    for policy in ("avg", "sum"):
        model = fit_exact(repeated, 4, duplicates=policy, hi=15.0)
        assert model.neighbors.agg(F.max(F.abs("sim"))).first()[0] <= 1.0
        assert model.devs.groupBy("u", "i").count().where("count > 1").count() == 0
        model.unpersist()
    clean, double = fit_exact(ratings_df(spark, rows), 4), fit_exact(repeated, 4)
    key = lambda m: {(r.u, r.v, r.sim, r.rank) for r in m.neighbors.collect()}
    assert key(clean) == key(double)
    with pytest.raises(Exception, match="duplicate rating"):
        fit_exact(repeated, 4, duplicates="error").neighbors.collect()


def test_every_test_row_is_scored(spark):
    model = fit_exact(ratings_df(spark, TINY), 2)
    test = ratings_df(spark, [(3, 1, 5), (3, 1, 5), (3, 1, 1), (4, 3, 5), (9, 9, 2)])
    scored = score_pairs(test, model)
    assert sorted((r.u, r.i, r.r, r.prediction) for r in scored.collect()) == [
        (3, 1, 1.0, 5.0), (3, 1, 5.0, 5.0), (3, 1, 5.0, 5.0), (4, 3, 5.0, 5.0), (9, 9, 2.0, 3.0)]
    assert mae(scored).first().n_test == 5
    model.unpersist()


def test_ranks_do_not_depend_on_the_shuffle(spark):
    rows = random_ratings(60, 25, 0.4, seed=31)
    old, seen = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n in ("1", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            train = ratings_df(spark, rows).repartition(int(n))
            model = fit_exact(train, 5, persist="none")
            top = recommend_top_n(score_all_items(model), train, 3)
            seen.append(sorted((r.u, r.i, r["rank"]) for r in top.collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert seen[0] == seen[1]


def test_similarity_for_pairs_matches_all_pairs(spark):
    from knnrec.operators.similarity import similarity_for_pairs

    rows = random_ratings(20, 10, 0.4, seed=29)
    train = ratings_df(spark, rows)
    unit = unit_ratings(normalized_deviations(train, st.user_stats(train)))
    every = as_dict(mirror(similarity_half(unit)), ["u", "v"], "sim")
    pairs = [(u, v) for u in range(0, 22, 3) for v in range(22) if u != v]
    got = as_dict(similarity_for_pairs(unit, spark.createDataFrame(pairs + pairs[:5], "u long, v long")), ["u", "v"], "sim")
    assert got == {p: every.get(p, 0.0) for p in pairs}


def test_rounding_of_large_amounts(spark):
    from knnrec.functions.columns import out

    values = [2.5e13, -2.5e13, 9.3e15, 1e300, 1.23456789, -0.0, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert [r[0] for r in df.select(out(F.col("x"))).collect()] == [2.5e13, -2.5e13, 9.3e15, 1e300, 1.234568, 0.0, None]


def test_released_frames_are_not_cached(spark):
    from knnrec.session import release_all

    model = fit_exact(ratings_df(spark, TINY), 2, persist="persist")
    model.neighbors.collect()
    assert model.neighbors.is_cached
    release_all()
    assert not model.neighbors.is_cached


def test_written_intermediates_cut_the_plan_and_are_deleted(spark):
    import os

    from knnrec.session import release_all

    release_all()
    model = fit_exact(ratings_df(spark, TINY), 2)
    folders = [f.rsplit("/", 1)[0].removeprefix("file:").replace("///", "/") for f in model.neighbors.inputFiles()]
    assert folders and all(os.path.isdir(f) for f in folders)
    plan = score_pairs(ratings_df(spark, TINY).select("u", "i"), model)._jdf.queryExecution().toString()
    assert len(plan) < 60_000
    model.unpersist()
    assert not any(os.path.isdir(f) for f in folders)


def test_a_cluster_without_a_shared_folder_is_refused():
    from types import SimpleNamespace

    from knnrec.session import ensure_checkpoint_dir

    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    session = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: default))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(session)


def test_skewed_ratings_give_even_cells(spark):
    """One item rated by all users and many rated by most: no cell of the
    split join exceeds the bound, and the counts of rows are even."""
    from knnrec.operators.similarity import hot_key_blocks

    rows = [(u, i, float(1 + (u * i) % 5)) for u in range(300) for i in range(12) if i == 0 or (u + i) % 3]
    train = ratings_df(spark, rows)
    unit = unit_ratings(normalized_deviations(train, st.user_stats(train)))
    hot = hot_key_blocks([unit.select("i")], ["i"], block_rows=40)
    dealt = unit.join(hot, "i").groupBy("i", F.pmod(F.xxhash64("u"), F.col("_nb")).alias("b")).count()
    top = dealt.agg(F.max("count"), F.min("count")).first()
    assert top[0] <= 2 * 40 and top[1] >= 10
    assert as_dict(similarity_half(unit, block_rows=40), ["u", "v"], "sim") == as_dict(similarity_half(unit), ["u", "v"], "sim")


def test_report_sink_writes_json(spark, tmp_path):
    import json

    from knnrec.sources.report import as_json, write_report

    df = spark.createDataFrame([(1, 0.5)], "k long, mae double")
    doc = json.loads(as_json(df).first().report)
    assert doc == {"k": 1, "mae": 0.5}
    out = str(tmp_path / "answers")
    write_report(df, out)
    assert spark.read.json(out).first().mae == 0.5


def test_declared_user_count_adds_zero_slots(spark):
    # With 5 declared users instead of 4, u2's row has one more zero entry,
    # so its negative neighbour no longer fits in k = 2 slots.
    model = fit_exact(ratings_df(spark, TINY), 2, n_users=5)
    nb = {(r.u, r.v) for r in model.neighbors.collect()}
    assert (2, 3) not in nb and (2, 1) in nb and (4, 1) not in nb
    model.unpersist()


def test_checkpoint_mode_cuts_lineage_and_keeps_results(spark):
    rows = random_ratings(20, 10, 0.4, seed=77)
    train = ratings_df(spark, rows)
    pinned = fit_exact(train, 3, persist="checkpoint")
    lazy = fit_exact(train, 3, persist="none")
    key = lambda m: {(r.u, r.v, r.sim, r.rank) for r in m.neighbors.collect()}
    assert key(pinned) == key(lazy)
    # a checkpointed frame is read back from files: no join left in its plan
    plan = pinned.neighbors._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    assert spark.sparkContext.getCheckpointDir()


def test_score_all_items_with_split_neighbours(spark):
    rows = random_ratings(25, 8, 0.6, seed=19)
    model = fit_exact(ratings_df(spark, rows), 6)
    plain = as_dict(score_all_items(model), ["u", "i"], "prediction")
    split = as_dict(score_all_items(model, block_rows=2), ["u", "i"], "prediction")
    assert split == pytest.approx(plain, abs=1e-12)
    model.unpersist()


def test_similarity_for_users_matches_all_pairs(spark):
    from knnrec.operators.similarity import similarity_for_users

    rows = random_ratings(20, 10, 0.5, seed=23)
    train = ratings_df(spark, rows)
    unit = unit_ratings(normalized_deviations(train, st.user_stats(train)))
    every = as_dict(mirror(similarity_half(unit)), ["u", "v"], "sim")
    users = spark.createDataFrame([(2,), (5,), (11,)], "u long")
    some = as_dict(similarity_for_users(unit, users, block_rows=2), ["u", "v"], "sim")
    assert some == {key: s for key, s in every.items() if key[0] in (2, 5, 11)}


def test_one_item_rated_by_everyone_is_split(spark):
    from knnrec.operators.similarity import hot_key_blocks

    # item 0 is rated by all 120 users (a third of the rows); the rest are sparse
    rows = [(u, 0, float(1 + u % 5)) for u in range(120)]
    rows += [(u, 1 + (u * 7 + j) % 40, float(1 + (u + j) % 5)) for u in range(120) for j in range(2)]
    train = ratings_df(spark, rows)
    unit = unit_ratings(normalized_deviations(train, st.user_stats(train)))
    hot = {r.i: r._nb for r in hot_key_blocks([unit.select("i")], ["i"], block_rows=25).collect()}
    assert hot == {0: 5}
    plain = as_dict(similarity_half(unit), ["u", "v"], "sim")
    split = as_dict(similarity_half(unit, block_rows=25), ["u", "v"], "sim")
    assert split == plain


def test_hot_user_under_forced_skew_splitting(spark):
    # user 0 holds a third of all rows; AQE thresholds are lowered so that
    # skew-join splitting really happens at this size (the executed plan
    # then shows skewed sort-merge joins).
    rows = [(0, i, float(1 + i % 5)) for i in range(60)]
    rows += [(u, (u * 3 + j) % 60, float(1 + (u + j) % 5)) for u in range(1, 41) for j in range(3)]
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64b",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64b",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    old = {key: spark.conf.get(key, None) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        k = 4
        model = fit_exact(ratings_df(spark, rows), k)
        expected, *_ = dense_reference(rows, k)
        got = {}
        for r in model.neighbors.collect():
            got.setdefault(r.u, set()).add((r.v, round(r.sim, 9)))
        assert got == {u: s for u, s in expected.items() if s}
        pairs = [(0, i) for i in range(0, 61, 3)] + [(u, 7) for u in range(41)]
        want = brute_predictions(rows, k, pairs)
        pred = as_dict(score_pairs(spark.createDataFrame(pairs, "u long, i long"), model), ["u", "i"], "prediction")
        assert pred == pytest.approx(want, abs=1e-9)
        model.unpersist()
    finally:
        for key, value in old.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def test_neighbours_items_are_lists_of_two_arrays(spark):
    from knnrec.operators.predict import neighbor_items

    model = fit_exact(ratings_df(spark, random_ratings(30, 12, 0.4, seed=4)), 4)
    lists = neighbor_items(model, made=10 ** 9, ids="int")
    assert dict(lists.dtypes) == {"u": "bigint", "sim": "double", "items": "array<int>", "devs": "array<double>"}
    assert lists.where("array_sort(devs) <> devs OR size(items) <> size(devs)").count() == 0
    plan = lists._jdf.queryExecution().executedPlan().toString()
    assert plan.count(", 250), REPARTITION_BY_NUM") == 2  # tasks follow what they make
    model.unpersist()


def test_items_beyond_an_int_are_recommended(spark):
    from knnrec.operators.predict import recommend

    rows = random_ratings(30, 12, 0.4, seed=4)
    far = 2 ** 40
    got = {}
    for shift in (0, far):
        train = ratings_df(spark, [(u, i + shift, r) for u, i, r in rows])
        model = fit_exact(train, 4)
        got[shift] = {(r.u, r.i - shift, round(r.prediction, 9), r.rank) for r in recommend(model, train, 3, "matrix").collect()}
        model.unpersist()
    assert got[0] == got[far] and got[0]
