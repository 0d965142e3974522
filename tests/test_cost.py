from datetime import datetime

from pyspark.sql import functions as F

from knnrec.operators.cost import (
    breakeven_days, budget_units, days_until_buying_wins, exact_product_sum, exact_sum, usage_daily_cost,
)


def test_no_break_even_without_margin(spark):
    df = spark.createDataFrame([(100.0, 5.0, 5.0), (100.0, 3.0, 5.0), (100.0, 7.0, 5.0)],
                               "price double, rent double, own double")
    got = [r[0] for r in df.select(days_until_buying_wins(F.col("price"), F.col("rent"), F.col("own"))).collect()]
    assert got == [None, None, 50]


def test_usage_with_an_unknown_event_type(spark):
    day = datetime(2024, 5, 1, 12)
    events = spark.createDataFrame(
        [(day, 1, "view", 0.01), (day, 1, "refund", 2.0), (day, 2, "refund", 3.5), (day, 3, "view", 100.25), (day, 3, "view", 0.5)],
        "ts timestamp, user_id long, event_type string, value double")
    got = {r.user_id: r for r in usage_daily_cost(events, [("view", 1.0, 0.25)], 1.6e-7, 1.14e-6).collect()}
    assert (got[1].n_events, got[1].n_unpriced, got[1].usage_seconds, got[1].daily_cost) == (2, 1, 2.01, 4.45e-9)
    assert (got[2].n_events, got[2].n_unpriced, got[2].daily_cost) == (1, 1, None)
    assert got[3].daily_cost == 4.483375e-05 and got[3].usage_seconds == 100.75


def test_unsold_parts_and_idle_suppliers_stay(spark):
    part = spark.createDataFrame([(1, 900.0), (2, 950.0)], "p_partkey long, p_retailprice double")
    items = spark.createDataFrame([(1, 7, 100.0, 0.1, datetime(2024, 1, 1))],
                                  "l_partkey long, l_suppkey long, l_extendedprice double, l_discount double, l_shipdate timestamp")
    got = {r.p_partkey: r for r in breakeven_days(part, items, 10.0).collect()}
    assert got[1].days == 100 and got[2].days is None and got[2].price == 9500.0
    supplier = spark.createDataFrame([(7, 5000.0), (8, 1.0)], "s_suppkey long, s_acctbal double")
    got = {r.s_suppkey: r for r in budget_units(supplier, part, items, 8.0, 1536.0, 28, 4).collect()}
    assert got[7].units == 5 and got[8].units is None and got[8].budget == 1.0


def test_sums_and_products_beyond_long_are_exact(spark):
    big = (1 << 63) - 1
    rows = [(1, big, 3), (1, big, 1), (1, -5, 7), (2, -big, 10 ** 9), (2, 12345, -(10 ** 12)), (3, None, 4), (3, 4, None), (4, 0, 0), (4, 9, 0), (5, big, 1)] + [(6, big, 1)] * 5
    df = spark.createDataFrame(rows, "g long, a long, b long")
    got = {r.g: (r.s, r.p) for r in df.groupBy("g").agg(exact_sum(F.col("a")).alias("s"), exact_product_sum(F.col("a"), F.col("b")).alias("p")).collect()}
    for g in range(1, 7):
        mine = [(a, b) for h, a, b in rows if h == g]
        total = [a for a, _ in mine if a is not None]
        product = [a * b for a, b in mine if a is not None and b is not None]
        assert got[g][0] == sum(total)
        assert got[g][1] == (sum(product) if product else None)
