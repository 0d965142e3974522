"""Per-user normalisation: deviations on the user's own scale, then unit
length rows so that a dot product is a cosine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knnrec.functions.columns import normalized_deviation, scale
from knnrec.sources.ratings import RATING_HI, RATING_LO


def scale_values(train: DataFrame, stats: DataFrame, lo: float = RATING_LO, hi: float = RATING_HI) -> DataFrame:
    joined = train.join(stats.select("u", "avg_rating"), "u")
    return joined.select(
        "u", "i", "r", "avg_rating", scale(F.col("r"), F.col("avg_rating"), lo, hi).alias("scale")
    )


def normalized_deviations(
    train: DataFrame, stats: DataFrame, lo: float = RATING_LO, hi: float = RATING_HI
) -> DataFrame:
    """``devs(u, i, dev)``: one row per stored rating (a zero deviation is
    kept, since the row also marks that ``u`` rated ``i``)."""
    joined = train.join(stats.select("u", "avg_rating"), "u")
    return joined.select(
        "u", "i", normalized_deviation(F.col("r"), F.col("avg_rating"), lo, hi).alias("dev")
    )


def user_norms(devs: DataFrame) -> DataFrame:
    return devs.groupBy("u").agg(F.sqrt(F.sum(F.col("dev") * F.col("dev"))).alias("norm"))


def unit_ratings(devs: DataFrame, norms: DataFrame | None = None) -> DataFrame:
    """``unit(u, i, w) = dev / norm``. A user whose ratings all equal the
    average has norm 0 and no direction; such users drop out here and
    are later predicted by their own average.

    The norm is a partial aggregate joined back on ``u`` (broadcast when
    the measured size allows, else a skew-split sort-merge join), never a
    window over ``u``: a window would put a hot user's rows in one task."""
    norms = user_norms(devs) if norms is None else norms
    joined = devs.join(norms.where(F.col("norm") > 0), "u")
    return joined.select("u", "i", (F.col("dev") / F.col("norm")).alias("w"))
