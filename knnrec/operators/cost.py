"""Buy-versus-rent cost model over tables.

Three questions as per-row queries: days until
buying an asset beats renting it (gross and net of running cost), daily
cost of metered usage, and how many units a budget buys with the
capacity ratios that follow."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knnrec.functions.columns import hundredths, out


def days_until_buying_wins(price: Column, daily_rent: Column, daily_own_cost: Column | float = 0.0) -> Column:
    """``ceil(price / (rent - own))``; NULL when renting never costs more
    (a margin <= 0 has no break-even)."""
    own = daily_own_cost if isinstance(daily_own_cost, Column) else F.lit(float(daily_own_cost))
    margin = daily_rent - own
    return F.when(margin > 0, F.ceil(price / margin)).cast("long")


def part_daily_rent(lineitem: DataFrame) -> DataFrame:
    """``(l_partkey, daily_rent)``: discounted revenue per distinct ship day.

    Revenue is summed exactly, in ten-thousandths (price in hundredths
    times the kept share in percent), so the result does not depend on
    summation order. The distinct count is planned as a two-level
    aggregate keyed by (part, day) first, so a hot part is spread over
    its days."""
    revenue = hundredths(F.col("l_extendedprice")) * hundredths(F.lit(1.0) - F.col("l_discount"))
    return lineitem.groupBy("l_partkey").agg(
        (F.sum(revenue).cast("double") / F.count_distinct("l_shipdate").cast("double")
         / F.lit(10000.0)).alias("daily_rent")
    )


def _with_rent(part: DataFrame, lineitem: DataFrame, price_multiplier: float) -> DataFrame:
    """Every part; one that was never shipped has no rent."""
    rent = part_daily_rent(lineitem)
    joined = part.select("p_partkey", "p_retailprice").join(rent, F.col("p_partkey") == F.col("l_partkey"), "left")
    return joined.withColumn("price", F.col("p_retailprice") * F.lit(price_multiplier))


def breakeven_days(part: DataFrame, lineitem: DataFrame, price_multiplier: float) -> DataFrame:
    return _with_rent(part, lineitem, price_multiplier).select(
        "p_partkey", out(F.col("price")).alias("price"), out(F.col("daily_rent")).alias("daily_rent"),
        days_until_buying_wins(F.col("price"), F.col("daily_rent")).alias("days"),
    )


def breakeven_net_days(part: DataFrame, lineitem: DataFrame, price_multiplier: float,
                       own_daily_cost: float) -> DataFrame:
    return _with_rent(part, lineitem, price_multiplier).select(
        "p_partkey", out(F.col("daily_rent") - F.lit(own_daily_cost)).alias("daily_margin"),
        days_until_buying_wins(F.col("price"), F.col("daily_rent"), own_daily_cost).alias("days"),
    )


# Rates are whole numbers of 1e-12 per second, amounts of usage hundredths of
# a second, so costs add up exactly in units of 1e-14.
RATE_UNIT = 10 ** 12
COST_UNIT = 10.0 ** 14


LONG_MAX = (1 << 63) - 1
LOW_BITS = 30


def exact_sum(x: Column) -> Column:
    """Exact sum of LONG values of any number, as a decimal: high and low bits
    are summed as whole numbers and put together once per group."""
    high = F.sum(F.shiftright(x, LOW_BITS)).cast("decimal(28,0)")
    low = F.sum(x.bitwiseAND(F.lit((1 << LOW_BITS) - 1)))
    return high * F.lit(1 << LOW_BITS).cast("decimal(10,0)") + low.cast("decimal(20,0)")


def exact_product_sum(a: Column, b: Column) -> Column:
    """Exact sum of LONG products: LONG arithmetic, but for the rows (as a
    rule none) whose product does not fit."""
    fits = F.abs(a) <= F.try_divide(F.lit(LONG_MAX).cast("double"), F.abs(b)) * F.lit(0.999)
    fits = F.coalesce(fits, a.isNotNull() & b.isNotNull())  # b = 0
    whole = exact_sum(F.when(fits, a * b))
    wide = F.sum(F.when(~fits, a.cast("decimal(19,0)") * b.cast("decimal(19,0)")).cast("decimal(28,0)"))
    return F.when(whole.isNotNull() | wide.isNotNull(),
                  F.coalesce(whole, F.lit(0).cast("decimal(38,0)")) + F.coalesce(wide, F.lit(0).cast("decimal(38,0)")))


def usage_daily_cost(
    events: DataFrame,
    resources: Sequence[tuple[str, float, float]],
    cost_gb: float,
    cost_cpu: float,
) -> DataFrame:
    """``(day, user_id, n_events, n_unpriced, usage_seconds, daily_cost)``.

    ``daily_cost`` is exact before its one conversion to double and is not
    rounded. An event whose type has no rate counts in ``n_events``,
    ``usage_seconds`` and ``n_unpriced``; a day without a priced event has a
    NULL cost. The rate table has one row per event type (a fixed, tiny
    literal), so it is broadcast; events are aggregated map-side."""
    spark = events.sparkSession
    rows = [(t, round((gb * cost_gb + cpu * cost_cpu) * RATE_UNIT)) for t, gb, cpu in resources]
    rates = F.broadcast(spark.createDataFrame(rows, "event_type string, rate long"))
    priced = events.select("ts", "user_id", "event_type", "value").join(rates, "event_type", "left")
    priced = priced.withColumn("amount", hundredths(F.col("value")))
    return priced.groupBy(F.to_date("ts").cast("string").alias("day"), "user_id").agg(
        F.count(F.lit(1)).cast("long").alias("n_events"),
        F.sum(F.col("rate").isNull().cast("long")).alias("n_unpriced"),
        (exact_sum(F.col("amount")).cast("double") / F.lit(100.0)).alias("usage_seconds"),
        (exact_product_sum(F.col("amount"), F.col("rate")).cast("double") / F.lit(COST_UNIT)).alias("daily_cost"),
    )


def budget_units(
    supplier: DataFrame,
    part: DataFrame,
    lineitem: DataFrame,
    unit_ram: float,
    reference_ram: float,
    reference_cores: int,
    units_per_core: int,
) -> DataFrame:
    """Units a supplier's (non-negative) balance buys at the mean list
    price of the parts it ships, and the memory and compute ratios of
    that many units against one reference machine. A supplier that ships
    nothing has no price and NULL units."""
    shipped = lineitem.select("l_suppkey", "l_partkey").distinct()
    price = shipped.join(part.select("p_partkey", "p_retailprice"),
                         F.col("l_partkey") == F.col("p_partkey")).groupBy("l_suppkey").agg(
        (F.sum(hundredths(F.col("p_retailprice"))).cast("double") / F.count(F.lit(1)).cast("double")
         / F.lit(100.0)).alias("unit_price"))
    budget = F.greatest(F.col("s_acctbal"), F.lit(0.0))
    units = F.floor(budget / F.col("unit_price")).cast("long")
    joined = supplier.select("s_suppkey", "s_acctbal").join(price, F.col("s_suppkey") == F.col("l_suppkey"), "left")
    return joined.select(
        "s_suppkey", out(budget).alias("budget"), out(F.col("unit_price")).alias("unit_price"),
        units.alias("units"),
        out(units * F.lit(unit_ram) / F.lit(reference_ram)).alias("ram_ratio"),
        out(units / F.lit(float(reference_cores * units_per_core))).alias("compute_ratio"),
    )
