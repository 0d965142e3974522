"""Exact kNN: all co-rating pairs, top k per user."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knnrec.functions.columns import SIM_DIGITS
from knnrec.operators.item_profile import item_counts, item_profile
from knnrec.operators.normalize import normalized_deviations, user_norms
from knnrec.operators.similarity import CELL_ROWS, mirror, similarity_half
from knnrec.operators.topk_join import topk_join
from knnrec.operators.user_blocks import block_topk, coarse_fits, coarse_topk
from knnrec.session import made_of, materialize, release
from knnrec.sources.ratings import RATING_HI, RATING_LO, dedup_ratings


@dataclass
class KnnModel:
    """A fitted predictor: a handful of DataFrames, nothing on the driver.

    ``neighbors`` is ``(keys..., u, v, sim, rank)``; ``global_avg`` and
    ``n_users`` are scalar-subquery columns."""

    user_stats: DataFrame
    devs: DataFrame
    neighbors: DataFrame
    global_avg: Column
    n_users: Column
    k: int
    keys: tuple[str, ...] = ()
    pinned: list[DataFrame] = field(default_factory=list)

    def unpersist(self) -> None:
        release(*self.pinned)


class Ratings(NamedTuple):
    """What every fit over the same ratings starts from."""

    user_stats: DataFrame
    devs: DataFrame
    unit: DataFrame
    global_avg: Column
    n_users: Column


def base_frames(train: DataFrame, persist: str = "table", lo: float = RATING_LO, hi: float = RATING_HI,
                duplicates: str | None = "avg") -> Ratings:
    """User statistics, deviations and unit rows, each read several times.

    ``duplicates`` says what several rows of one (u, i) mean (see
    ``dedup_ratings``); None: the caller knows there are none."""
    if duplicates is not None:
        train = materialize(dedup_ratings(train, duplicates), persist)
    stats = materialize(train.groupBy("u").agg(
        (F.sum("r") / F.count(F.lit(1))).alias("avg_rating"),
        F.count(F.lit(1)).cast("long").alias("n"),
        F.sum("r").alias("total"),
    ), persist)
    # one table and one shuffle of the ratings by user for both
    rated = normalized_deviations(train, stats, lo, hi)
    norms = user_norms(rated)
    rated = materialize(rated.join(norms, "u").select(
        "u", "i", "dev", (F.col("norm") > 0).alias("directed"),
        F.when(F.col("norm") > 0, F.col("dev") / F.col("norm")).alias("w")), persist)
    devs = made_of(rated.select("u", "i", "dev"), rated)
    unit = made_of(rated.where("directed").select("u", "i", "w"), rated)
    global_avg = stats.agg(F.sum("total") / F.sum("n")).scalar()
    n_users = stats.agg(F.count(F.lit(1))).scalar()
    return Ratings(stats, devs, unit, global_avg, n_users)


def exact_similarities(unit: DataFrame, **blocking) -> DataFrame:
    """Directed similarities ``(u, v, sim)``, both directions."""
    return mirror(similarity_half(unit, **blocking))


METHODS = ("auto", "pairs", "bounded")


def fit_exact(
    train: DataFrame,
    k: int,
    n_users: int | None = None,
    persist: str = "table",
    method: str = "auto",
    lo: float = RATING_LO,
    hi: float = RATING_HI,
    duplicates: str | None = "avg",
    sim_digits: int = SIM_DIGITS,
    **blocking,
) -> KnnModel:
    """Exact user-based kNN over ``train(u, i, r)``.

    ``n_users`` is the width of the dense similarity row for the slot
    rule (default: users present in ``train``). ``duplicates``: policy for
    repeated (u, i) rows, or None when there are none. Similarities are
    rounded to ``sim_digits`` decimals; those that round to 0 are not
    stored. ``method``: ``pairs`` multiplies all co-rating pairs, ``bounded``
    skips products that cannot reach a user's top k (``topk_join``), ``auto``
    takes the latter where most products come from items of very many raters.
    All give the same neighbours."""
    ratings = base_frames(train, persist, lo, hi, duplicates)
    return fit_frames(ratings, k, n_users, persist, method, sim_digits, **blocking)


def fit_frames(
    ratings: Ratings,
    k: int,
    n_users: int | None = None,
    persist: str = "table",
    method: str = "auto",
    sim_digits: int = SIM_DIGITS,
    **blocking,
) -> KnnModel:
    """``fit_exact`` from prepared frames, which a caller may keep for more
    than one fit."""
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}")
    stats, devs, unit, global_avg, n_train_users = ratings
    n = F.lit(n_users) if n_users is not None else n_train_users
    profile = item_profile(item_counts(unit))
    pinned = [stats, devs, unit]
    if method == "bounded" or (method == "auto" and profile.skewed(blocking.get("block_rows", CELL_ROWS))):
        neighbors = materialize(topk_join(unit, k, sim_digits, persist, **blocking).neighbors(n), persist)
    else:
        most, users = stats.agg(F.max("n"), F.count(F.lit(1))).first()
        if coarse_fits(unit, k, users if n_users is None else n_users, most or 0, profile.largest):
            lists = coarse_topk(unit, k, profile.total, profile.largest, sim_digits, **blocking)
        else:
            lists = block_topk(unit, k, n, profile.total, profile.largest, sim_digits, **blocking)
        neighbors = materialize(lists, persist)
    return KnnModel(stats, devs, neighbors, global_avg, n, k, (), [*pinned, neighbors])
