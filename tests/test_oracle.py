"""Every registered query against its DuckDB SQL on sf0.001."""

import math

import duckdb
import pytest

from knnrec.plans.oracle import oracle_queries
from knnrec.plans.queries import QUERIES
from knnrec.sources.tables import TABLES, table_path

SF = "/root/testdata/sf0.001"


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 5)
    return v


def _rows(rows, cols):
    order = sorted(range(len(cols)), key=lambda j: cols[j])
    return sorted((tuple(_norm(r[j]) for j in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF, t)}')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(oracle_queries())


@pytest.mark.parametrize("name", sorted(oracle_queries()))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = df.collect()
    res = duck.execute(oracle_queries()[name])
    cols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(got) == len(want)
    assert _rows(got, df.columns) == _rows(want, cols)
    spark.catalog.clearCache()


def test_report_json(spark):
    import json

    row = QUERIES["report_json"](spark, SF).collect()
    assert len(row) == 1
    doc = json.loads(row[0].report)
    assert doc["meta"]["k"] == 10 and doc["meta"]["n_test"] == 1081
    assert 0 < doc["exact"]["mae_exact"] < 4


@pytest.mark.parametrize("name", ["ratings_parse", "ratings_rejects", "mae_exact", "budget_units_ratio"])
def test_query_matches_oracle_without_ansi(spark, duck, name):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        df = QUERIES[name](spark, SF)
        res = duck.execute(oracle_queries()[name])
        cols = [d[0] for d in res.description]
        assert _rows(df.collect(), df.columns) == _rows(res.fetchall(), cols)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
        spark.catalog.clearCache()
