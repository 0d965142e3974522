"""Exact top-k similarity join that skips products which cannot matter.

Items are put into classes by the number of users who rated them (powers of
two). An item of c raters costs c^2 products, so nearly all of a skewed table's
products come from a few classes, while a single popular item says little about
who is near. With ``rest(u, class)`` the norm of a user's unit row over the
classes above, two rows that share nothing else have at most the product of
their rests in common (Cauchy-Schwarz). So:

1. the classes that hold a small part of the products (``COLD_SHARE``) are
   multiplied in full, for each user's ``PROBES * k`` best partners so far;
2. these get their exact similarity; the k-th best of them is a threshold the
   final list must reach;
3. a user's classes are multiplied only up to the class above which its own
   rest is below the threshold. A user whose classes are all multiplied has its
   sums whole, and its list is taken where they are made;
4. of the other users' pairs those whose sum plus the bound of what is left stays
   below the threshold are dropped, the others get the products left out.

Users with fewer than k positive partners among their probes have no threshold
and are multiplied in full, so zeros and negatives follow the slot rule of
``neighbors.slot_topk`` unchanged. Products of steps 1 and 3 are summed in blocks of
users (``user_blocks``): lists of raters are shuffled and pairs are not, so the rare
classes are multiplied twice rather than kept. Steps 2 and 4 are joins of at
most ``PROBES * k`` pairs a user, and of the pairs that the bound leaves."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from knnrec.functions.columns import SIM_DIGITS, snap
from knnrec.operators.item_profile import COLD_SHARE, ItemProfile, item_class, item_counts, item_profile
from knnrec.operators.user_blocks import best_partners, id_type, near_partners, slots
from knnrec.session import materialize

#: Partners per wanted neighbour that are looked up for the threshold.
PROBES = 2
#: Room for rounding: sums of products in another order, snapped similarities.
SLACK = 1e-8
TOP_CLASS = 64


def class_rests(rows: DataFrame) -> DataFrame:
    """``(u, cls, products, rest)``: the products of a user's items of a class and
    the norm of its row over the classes above."""
    squares = rows.groupBy("u", "cls").agg(F.sum(F.col("w") * F.col("w")).alias("sq"), F.sum(F.col("c") - 1).alias("products"))
    above = Window.partitionBy("u").orderBy(F.col("cls").desc()).rowsBetween(Window.unboundedPreceding, -1)
    return squares.select("u", "cls", "products", F.sqrt(F.coalesce(F.sum("sq").over(above), F.lit(0.0))).alias("rest"))


def norms_above(warm: DataFrame, cold: int, profile: ItemProfile) -> DataFrame:
    """``(v, above)``: element j is the norm of v's row over the classes above
    ``cold + j``; one number for each class there is."""
    squares = warm.groupBy("u", "cls").agg(F.sum(F.col("w") * F.col("w")).alias("sq"))
    classes = range(cold, max(profile.products, default=cold) + 1)
    sums = [F.sqrt(F.coalesce(F.sum(F.when(F.col("cls") > c, F.col("sq"))), F.lit(0.0))) for c in classes]
    return squares.groupBy(F.col("u").alias("v")).agg(F.array(*sums).alias("above"))


@dataclass
class TopKJoin:
    """The stages, for callers that want to see what was skipped."""

    profile: ItemProfile
    cold: int
    k: int
    thresholds: DataFrame  # (u, t)
    heads: DataFrame  # rows of the other classes multiplied after the thresholds
    candidates: DataFrame  # (u, v, part): pairs left by the bound, of users with products left out
    found: DataFrame  # (u, v, sim, place, cnt): the k best of the other users
    completed: DataFrame  # (u, v, sim): the candidates with all their products
    whole: Callable[[], DataFrame]  # every nonzero (u, v, sim) of the other users

    @property
    def similarities(self) -> DataFrame:
        """``(u, v, sim)``, directed: what ``slot_topk`` needs of them (for studies; the
        sums are made once more)."""
        return self.whole().unionByName(self.completed)

    def neighbors(self, n_users: Column | int) -> DataFrame:
        """``(u, v, sim, rank)``: ``slot_topk(similarities, k, n_users)``. A user with
        products left out has k positives."""
        order = Window.partitionBy("u").orderBy(F.col("sim").desc(), F.col("v").asc())
        rest = self.completed.where("sim > 0").withColumn("rank", F.row_number().over(order).cast("long"))
        return slots(self.found, self.k, n_users).unionByName(rest.where(F.col("rank") <= self.k))

    def products(self) -> dict[str, int]:
        """Products of each stage (an action; for tests and studies): of unordered
        pairs, but for ``heads``, made for one of the two."""
        cold = sum(n for c, n in self.profile.products.items() if c <= self.cold)
        head = self.heads.agg(F.sum(F.col("c") - 1).alias("n")).first()["n"] or 0
        return {"all_pairs": self.profile.total, "cold": cold, "heads": head}


def pair_products(pairs: DataFrame, mine: DataFrame, others: DataFrame) -> DataFrame:
    """``(u, v, part)``: products of the pairs' rows, those of u from ``mine``,
    those of v from ``others``."""
    other = others.select(F.col("u").alias("v"), "i", F.col("w").alias("w_v"))
    met = pairs.select("u", "v").join(mine.select("u", "i", "w"), "u").join(other, ["v", "i"])
    return met.groupBy("u", "v").agg(F.sum(F.col("w") * F.col("w_v")).alias("part"))


def topk_join(unit: DataFrame, k: int, digits: int = SIM_DIGITS, persist: str = "table",
              cold_share: float = COLD_SHARE, probes: int = PROBES, **blocking) -> TopKJoin:
    """Every user's top k under the slot rule: ``topk_join(unit, k).neighbors(n)`` equals
    ``slot_topk`` over all pairs. ``unit`` is ``(u, i, w)``, one row per (u, i)."""
    if k < 1:
        raise ValueError("k must be >= 1")
    # no bound holds for a weight that is not a number: items with one are never left out
    counts = materialize(unit.groupBy("i").agg(
        F.count(F.lit(1)).alias("c"), F.coalesce(F.max(F.isnan("w")), F.lit(False)).alias("odd")), persist)
    profile = item_profile(counts)
    cold = profile.cold_class(cold_share)
    tagged = unit.join(counts, "i").select("u", "i", "w", "c", "odd", item_class(F.col("c")).alias("cls"))
    rows = materialize(tagged, persist)
    rests = materialize(class_rests(rows), persist)
    warm = rows.where(F.col("cls") > cold)
    blocking = {"ids": id_type(rows), **blocking}

    # 1. the best partners by the rare classes
    rare = rows.where(F.col("cls") <= cold)
    probed = best_partners(rare, probes * k, sum(n for c, n in profile.products.items() if c <= cold),
                           min(profile.largest, 2 ** (cold + 1) - 1), digits, **blocking)
    probed = materialize(probed.where("sim > 0").select("u", "v", F.col("sim").alias("part")), persist)

    # 2. thresholds from their exact similarities
    added = pair_products(probed, warm, warm)
    exact = probed.unionByName(added).groupBy("u", "v").agg(snap(F.sum("part"), digits).alias("sim"))
    rank = Window.partitionBy("u").orderBy(F.col("sim").desc())
    kth = exact.where("sim > 0").withColumn("n", F.row_number().over(rank)).where(F.col("n") == k)
    thresholds = kth.where(~F.isnan("sim")).select("u", F.col("sim").alias("t"))

    # 3. how far up a user's classes must be multiplied, and what those left out can add
    low = F.col("rest") < F.col("t") - SLACK
    reach = rests.join(thresholds, "u").groupBy("u").agg(
        F.max("t").alias("t"), F.min(F.when(low, F.greatest("cls", F.lit(cold)))).alias("last"),
        F.coalesce(F.max(F.when(low, F.col("rest"))), F.lit(0.0)).alias("tail"))
    reach = materialize(reach, persist)
    limits = rows.join(reach, "u", "left")
    made = (F.col("cls") <= cold) | (F.col("cls") <= F.coalesce("last", F.lit(TOP_CLASS)))
    heads = limits.where((F.col("cls") > cold) & (made | F.col("odd"))).select("u", "i", "w", "c")
    tails = limits.where(~(made | F.col("odd"))).select("u", "i", "w")
    # a partner's row has at most norm 1
    least = F.when(F.col("tail") > 0, F.col("t") - F.col("tail") - SLACK).otherwise(F.lit(float("-inf")))
    asked = limits.select("u", "i", "w", (made | F.col("odd")).alias("asked"), least.alias("least"))
    directed = rests.join(reach, "u", "left").where(made).agg(F.sum("products")).first()[0] or 0

    def partners(every: bool) -> DataFrame:
        return near_partners(asked, k, directed // 2, profile.largest, digits, every, **blocking)

    found = materialize(partners(False), persist)

    # 4. what the classes left out can still add: both norms over them
    judged = found.where("place = 0").select("u", "v", F.col("sim").alias("part")).join(
        reach, "u").join(norms_above(warm, cold, profile), "v", "left")
    bound = F.col("part") + F.col("tail") * F.coalesce(F.get("above", F.col("last") - F.lit(cold)), F.lit(0.0))
    candidates = materialize(judged.where(bound >= F.col("t") - SLACK).select("u", "v", "part"), persist)
    rest = pair_products(candidates, tails, warm)
    whole = candidates.unionByName(rest).groupBy("u", "v").agg(snap(F.sum("part"), digits).alias("sim"))
    return TopKJoin(profile, cold, k, thresholds, heads, candidates, found.where("place > 0"), whole.where("sim <> 0"),
                    lambda: partners(True).where("place > 0").select("u", "v", "sim"))
