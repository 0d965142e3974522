"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each query reads the given tables (the rating view is derived from
``lineitem`` and ``orders``), so its work grows with them. Floating
results are rounded (``out``) so that they compare across engines."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from knnrec.functions.columns import hundredths, out, scale
from knnrec.operators import cost
from knnrec.operators import stats as st
from knnrec.operators.evaluate import mae, user_average_predictions
from knnrec.operators.neighbors import merge_topk
from knnrec.operators.normalize import normalized_deviations, unit_ratings, user_norms
from knnrec.operators.partition import assign_partitions, partition_sizes, ranked_parts, user_partitions
from knnrec.operators.predict import (
    recommend, score_all_items, score_pairs, weighted_deviation,
)
from knnrec.operators.similarity import similarity_for_pairs, similarity_for_users, sparse_matmul
from knnrec.operators.user_blocks import all_similarities, turned
from knnrec.plans import params as p
from knnrec.plans.approximate import (
    candidate_ratio, fit_approx, part_arrays, part_similarities, part_topk, replication_sweep,
)
from knnrec.plans.exact import base_frames, fit_exact
from knnrec.plans.kept import (
    fit_kept, load_model, load_similarities, save_model, save_ratings, save_similarities,
)
from knnrec.session import delete_later, ensure_checkpoint_dir, materialize
from knnrec.sources.ratings import (
    dedup_ratings, labelled_split, parse_rating_lines, rating_lines, rating_view,
    raw_line_ratings, reject_rating_lines, split_train_test,
)
from knnrec.sources.report import as_json
from knnrec.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]

# Intermediates read by several consumers of one query (rating view,
# deviations, unit rows, neighbours) are written out; the next registered query
# frees them first (``release_all``). Queries with a single consumer read the
# tables directly.
PERSIST = "table"


def _train(spark, sf):
    """The train half, for one consumer."""
    return split_train_test(rating_view(spark, sf))[0]


def _split(spark, sf):
    """Both halves, for several consumers: two filters of one view, whose
    scan and join run once."""
    return split_train_test(materialize(rating_view(spark, sf), PERSIST))


def _exact(spark, sf, k=p.K):
    train, test = _split(spark, sf)
    return train, test, fit_exact(train, k, persist=PERSIST, duplicates=None)


def _approx(spark, sf, **options):
    train, test = _split(spark, sf)
    return train, test, fit_approx(train, p.K, p.PARTITIONS, p.REPLICATION, persist=PERSIST, duplicates=None, **options)


def q_ratings_parse(spark, sf):
    return parse_rating_lines(rating_lines(rating_view(spark, sf), "\t"), "\t")


def q_ratings_parse_sep(spark, sf):
    return parse_rating_lines(rating_lines(rating_view(spark, sf), "::"), "::")


def q_ratings_rejects(spark, sf):
    return reject_rating_lines(rating_lines(rating_view(spark, sf), "\t"), "\t")


def q_ratings_dedup(spark, sf):
    dedup = dedup_ratings(raw_line_ratings(spark, sf), "avg", with_count=True)
    return dedup.select("u", "i", out(F.col("r")).alias("r"), "n")


def q_train_test_split(spark, sf):
    return labelled_split(rating_view(spark, sf))


def q_dataset_shape(spark, sf):
    return st.dataset_shape(_train(spark, sf))


def q_sum_by_user(spark, sf):
    return st.sum_along_axis(_train(spark, sf), 1)


def q_sum_by_item(spark, sf):
    return st.sum_along_axis(_train(spark, sf), 0)


def q_global_average(spark, sf):
    g = st.global_stats(_train(spark, sf))
    return g.select(out(F.col("global_avg")).alias("global_avg"), "n_ratings", "n_users")


def q_user_averages(spark, sf):
    s = st.user_stats(_train(spark, sf))
    return s.select("u", out(F.col("avg_rating")).alias("avg_rating"), "n")


def q_user_norms(spark, sf):
    train = _split(spark, sf)[0]
    n = user_norms(normalized_deviations(train, st.user_stats(train)))
    return n.select("u", out(F.col("norm")).alias("norm"))


def q_scale_values(spark, sf):
    train = _split(spark, sf)[0]
    s = st.user_stats(train)
    j = train.join(s.select("u", "avg_rating"), "u")
    return j.select("u", "i", "r", out(F.col("avg_rating")).alias("avg_rating"),
                    out(scale(F.col("r"), F.col("avg_rating"))).alias("scale"))


def q_normalized_deviations(spark, sf):
    train = _split(spark, sf)[0]
    d = normalized_deviations(train, st.user_stats(train))
    return d.select("u", "i", out(F.col("dev")).alias("dev"))


def q_unit_ratings(spark, sf):
    train = _split(spark, sf)[0]
    u = unit_ratings(normalized_deviations(train, st.user_stats(train)))
    return u.select("u", "i", out(F.col("w")).alias("w"))


def q_item_rating_counts(spark, sf):
    return st.item_rating_counts(_train(spark, sf))


def q_summary_stats(spark, sf):
    s = st.rating_summary(_train(spark, sf), "u")
    return s.select("u", "n", out(F.col("mean")).alias("mean"), out(F.col("std")).alias("std"))


def q_sparse_matmul(spark, sf):
    """Ratings (user x item) times an item table (item x brand, list price in
    hundredths): what a user's ratings are worth by brand."""
    a = _train(spark, sf).select(F.col("u").alias("row"), F.col("i").alias("k"), F.col("r").alias("val"))
    part = read_table(spark, sf, "part", "p_partkey", "p_brand", "p_retailprice")
    price = hundredths(F.col("p_retailprice")).cast("double")
    b = part.select(F.col("p_partkey").alias("k"), F.col("p_brand").alias("col"), price.alias("val"))
    return sparse_matmul(a, b)


def q_matmul_hot_keys(spark, sf):
    """A product over few, very frequent keys: rating sums by (user, brand)
    times the number of parts by (brand, size). Every brand is rated by nearly
    all users; the counts are a small table that every task gets."""
    part = read_table(spark, sf, "part", "p_partkey", "p_brand", "p_size")
    rated = _train(spark, sf).join(part, F.col("i") == F.col("p_partkey"))
    a = rated.groupBy(F.col("u").alias("row"), F.col("p_brand").alias("k")).agg(F.sum("r").alias("val"))
    b = part.groupBy(F.col("p_brand").alias("k"), F.col("p_size").cast("long").alias("col")).agg(
        F.count(F.lit(1)).cast("double").alias("val"))
    return sparse_matmul(a, b)


def _unit(spark, sf):
    train, test = _split(spark, sf)
    stats, devs, unit, _, _ = base_frames(train, PERSIST, duplicates=None)
    return train, test, unit


def q_similarity_all_pairs(spark, sf):
    _, _, unit = _unit(spark, sf)
    return turned(all_similarities(unit, half=True))


def q_similarity_for_users(spark, sf):
    """Similarities of the customers of one nation to everyone."""
    _, _, unit = _unit(spark, sf)
    customer = read_table(spark, sf, "customer", "c_custkey", "c_nationkey")
    users = customer.where(F.col("c_nationkey") == p.NATION).select(F.col("c_custkey").alias("u"))
    return similarity_for_users(unit, users)


def q_similarity_lookup(spark, sf):
    """Of every test item, the similarity of its first and last rater (by id):
    a request list as long as the items, looked up pair by pair."""
    _, test, unit = _unit(spark, sf)
    pairs = test.groupBy("i").agg(F.min("u").alias("u"), F.max("u").alias("v")).where("u <> v")
    return similarity_for_pairs(unit, pairs)


def q_topk_neighbors(spark, sf):
    return _exact(spark, sf)[2].neighbors


def q_topk_neighbors_bounded(spark, sf):
    train, _ = _split(spark, sf)
    return fit_exact(train, p.K, persist=PERSIST, duplicates=None, method="bounded").neighbors


def q_neighbor_counts(spark, sf):
    return st.neighbor_counts(_exact(spark, sf)[2].neighbors)


def _kept_folder(spark, name):
    return f"{ensure_checkpoint_dir(spark)}/kept-{name}-{uuid.uuid4().hex}"


def q_predict_pairs_kept(spark, sf):
    """The answers of a model that was written and read back."""
    _, test, model = _exact(spark, sf)
    path = _kept_folder(spark, "model")
    save_model(model, path)
    s = score_pairs(test, load_model(spark, path))
    return delete_later(s.select("u", "i", "r", out(F.col("prediction")).alias("prediction")), path)


def q_topk_neighbors_kept(spark, sf):
    """A fit over kept ratings: unit rows bucketed by item."""
    path = _kept_folder(spark, "ratings")
    save_ratings(_train(spark, sf), path, duplicates=None)
    return delete_later(fit_kept(spark, path, p.K).neighbors, path)


def q_similarity_point_lookup(spark, sf):
    """One pair from the kept similarities (one bucket read): the two users
    with the lowest ids that a test item has in common."""
    train, test = _split(spark, sf)
    pair = test.groupBy("i").agg(F.min("u").alias("u"), F.max("u").alias("v")).where("u <> v").orderBy("u", "v").first()
    path = _kept_folder(spark, "similarities")
    save_similarities(all_similarities(base_frames(train, PERSIST, duplicates=None).unit), path, dealt=True)
    kept = load_similarities(spark, path)
    return delete_later(kept.of_pair(pair["u"], pair["v"]) if pair else kept.rows.limit(0), path)


def q_weighted_deviation(spark, sf):
    _, test, model = _exact(spark, sf)
    return weighted_deviation(test, model).select("u", "i", out(F.col("wdev")).alias("wdev"))


def q_neighbor_weight_sums(spark, sf):
    _, test, model = _exact(spark, sf)
    wd = weighted_deviation(test, model)
    return wd.select("u", "i", out(F.coalesce(F.col("denom"), F.lit(0.0))).alias("denom"), "n_raters")


def q_predict_pairs(spark, sf):
    _, test, model = _exact(spark, sf)
    s = score_pairs(test, model)
    return s.select("u", "i", "r", out(F.col("prediction")).alias("prediction"))


def _mae_out(df):
    return df.select(out(F.col("mae")).alias("mae"), "n_test")


def q_mae_exact(spark, sf):
    _, test, model = _exact(spark, sf)
    return _mae_out(mae(score_pairs(test, model)))


def q_mae_lines(spark, sf):
    """The exact model scored on every test order line, repeated (u, i) rows
    included: ``n_test`` is the number of lines."""
    model = _exact(spark, sf)[2]
    lines = split_train_test(raw_line_ratings(spark, sf))[1]
    return _mae_out(mae(score_pairs(lines, model)))


def q_mae_user_avg(spark, sf):
    train, test = _split(spark, sf)
    s = st.user_stats(train)
    g = st.global_stats(train).select("global_avg").scalar()
    return _mae_out(mae(user_average_predictions(test, s, g)))


def _users(spark, sf):
    return st.user_stats(_train(spark, sf)).select("u")


def q_assign_partitions(spark, sf):
    return assign_partitions(_users(spark, sf), p.PARTITIONS, p.REPLICATION)


def q_partition_sizes(spark, sf):
    return partition_sizes(assign_partitions(_users(spark, sf), p.PARTITIONS, p.REPLICATION))


def q_user_partitions(spark, sf):
    return user_partitions(_users(spark, sf), p.PARTITIONS, p.REPLICATION)


def q_partition_unit_ratings(spark, sf):
    unit = _unit(spark, sf)[2]
    parts = F.explode(ranked_parts(F.col("u"), p.PARTITIONS, p.REPLICATION))
    return unit.select(parts.alias("part"), "u", "i", out(F.col("w")).alias("w"))


def _placed(spark, sf, order="keyed"):
    train = _split(spark, sf)[0]
    stats, devs, unit, _, n_users = base_frames(train, PERSIST, duplicates=None)
    return unit, part_arrays(stats.select("u"), p.PARTITIONS, p.REPLICATION, order), n_users


def q_similarity_blocked(spark, sf):
    unit, arrays, _ = _placed(spark, sf, "hashed")
    return turned(part_similarities(unit, arrays, p.PARTITIONS, p.REPLICATION))


def _part_lists(spark, sf):
    unit, arrays, n = _placed(spark, sf)
    return part_topk(unit, arrays, p.PARTITIONS, p.REPLICATION, p.K, n)


def q_topk_per_partition(spark, sf):
    return _part_lists(spark, sf)


def q_merge_topk(spark, sf):
    return merge_topk(_part_lists(spark, sf).drop("rank"), p.K)


def q_topk_approx(spark, sf):
    return _approx(spark, sf, order="hashed")[2].neighbors


def q_mae_approx(spark, sf):
    _, test, model = _approx(spark, sf)
    return _mae_out(mae(score_pairs(test, model)))


def q_replication_sweep(spark, sf):
    train, test = _split(spark, sf)
    r = replication_sweep(train, test, p.K, p.PARTITIONS, p.LEVELS, persist=PERSIST, duplicates=None)
    return r.select("level", out(F.col("mae")).alias("mae"), "n_test")


def q_candidate_ratio(spark, sf):
    c = candidate_ratio(_users(spark, sf), p.PARTITIONS, p.LEVELS, "hashed")
    return c.select("level", "candidate_pairs", "all_pairs",
                    out(F.col("candidate_ratio")).alias("candidate_ratio"), "block_pairs",
                    out(F.col("block_ratio")).alias("block_ratio"))


def q_score_all_items(spark, sf):
    model = _exact(spark, sf)[2]
    s = score_all_items(model)
    return s.select("u", "i", out(F.col("prediction")).alias("prediction"))


def q_recommend_top_n_bounded(spark, sf):
    train, _, model = _exact(spark, sf)
    rec = recommend(model, train, p.TOP_N, "bounded")
    return rec.select("u", "i", out(F.col("prediction")).alias("prediction"), "rank")


def q_recommend_top_n(spark, sf):
    train, _, model = _exact(spark, sf)
    rec = recommend(model, train, p.TOP_N)
    return rec.select("u", "i", out(F.col("prediction")).alias("prediction"), "rank")


def q_breakeven_days(spark, sf):
    return cost.breakeven_days(
        read_table(spark, sf, "part", "p_partkey", "p_retailprice"),
        read_table(spark, sf, "lineitem", "l_partkey", "l_extendedprice", "l_discount", "l_shipdate"),
        p.PRICE_MULTIPLIER,
    )


def q_breakeven_net_days(spark, sf):
    return cost.breakeven_net_days(
        read_table(spark, sf, "part", "p_partkey", "p_retailprice"),
        read_table(spark, sf, "lineitem", "l_partkey", "l_extendedprice", "l_discount", "l_shipdate"),
        p.PRICE_MULTIPLIER, p.OWN_DAILY_COST,
    )


def q_usage_daily_cost(spark, sf):
    return cost.usage_daily_cost(
        read_table(spark, sf, "events", "ts", "user_id", "event_type", "value"),
        p.EVENT_RESOURCES, p.COST_PER_GB_SECOND, p.COST_PER_CPU_SECOND,
    )


def q_budget_units_ratio(spark, sf):
    return cost.budget_units(
        read_table(spark, sf, "supplier", "s_suppkey", "s_acctbal"),
        read_table(spark, sf, "part", "p_partkey", "p_retailprice"),
        read_table(spark, sf, "lineitem", "l_suppkey", "l_partkey"),
        p.UNIT_RAM_GB, p.REFERENCE_RAM_GB, p.REFERENCE_CORES, p.UNITS_PER_CORE,
    )


def q_report_json(spark, sf):
    """The run's answers as one JSON document: data shape, exact and
    user-average error, and the most similar pair. Each value is a scalar
    subquery over the one-row shape (no joins between result rows)."""
    train, test, model = _exact(spark, sf)
    shape = st.dataset_shape(train)
    exact = mae(score_pairs(test, model))
    base = mae(user_average_predictions(test, model.user_stats, model.global_avg))
    best = model.neighbors.where(F.col("rank") == 1).agg(
        F.max_by(F.struct("u", "v", "sim"), F.struct("sim", -F.col("u"))))
    report = shape.select(
        F.struct(F.lit(p.K).alias("k"), "n_users", "n_items", "n_ratings",
                 exact.select("n_test").scalar().alias("n_test")).alias("meta"),
        F.struct(exact.select(out(F.col("mae"))).scalar().alias("mae_exact"),
                 base.select(out(F.col("mae"))).scalar().alias("mae_user_avg"),
                 best.scalar().alias("best_pair")).alias("exact"),
    )
    return as_json(report)


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
