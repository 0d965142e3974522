"""Counts, sums and averages over rating tables (all partial aggregates:
map-side combine first, so a hot user or item adds no shuffle volume)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dataset_shape(ratings: DataFrame) -> DataFrame:
    """Distinct users, distinct items and stored ratings, one row."""
    return ratings.agg(
        F.count_distinct("u").cast("long").alias("n_users"),
        F.count_distinct("i").cast("long").alias("n_items"),
        F.count(F.lit(1)).cast("long").alias("n_ratings"),
    )


def sum_along_axis(ratings: DataFrame, axis: int) -> DataFrame:
    """Row sums (``axis=1``: per user) or column sums (otherwise: per item)."""
    key = "u" if axis == 1 else "i"
    return ratings.groupBy(key).agg(F.sum("r").alias("total"))


def user_stats(train: DataFrame) -> DataFrame:
    """``(u, avg_rating, n)`` over stored ratings."""
    return train.groupBy("u").agg(
        (F.sum("r") / F.count(F.lit(1))).alias("avg_rating"),
        F.count(F.lit(1)).cast("long").alias("n"),
    )


def global_stats(train: DataFrame) -> DataFrame:
    """One row: global average rating, rating count, user count."""
    return train.agg(
        (F.sum("r") / F.count(F.lit(1))).alias("global_avg"),
        F.count(F.lit(1)).cast("long").alias("n_ratings"),
        F.count_distinct("u").cast("long").alias("n_users"),
    )


def item_rating_counts(train: DataFrame) -> DataFrame:
    return train.groupBy("i").agg(F.count(F.lit(1)).cast("long").alias("n_raters"))


def neighbor_counts(neighbors: DataFrame) -> DataFrame:
    """Nonzero neighbours kept per user."""
    return neighbors.where(F.col("sim") != 0).groupBy("u").agg(
        F.count(F.lit(1)).cast("long").alias("n_neighbors")
    )


def rating_summary(ratings: DataFrame, key: str = "u") -> DataFrame:
    """Mean and population standard deviation per group; an empty input
    reports 0 rather than NULL."""
    return ratings.groupBy(key).agg(
        F.count(F.lit(1)).cast("long").alias("n"),
        F.coalesce(F.avg("r"), F.lit(0.0)).alias("mean"),
        F.coalesce(F.stddev_pop("r"), F.lit(0.0)).alias("std"),
    )
