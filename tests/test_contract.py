"""The driver contract of __spark_entry__.py and session helpers."""

import importlib.util
import os

import duckdb

from knnrec.session import sizing_conf

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _entry_module():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


def test_entry_contract(spark):
    se = _entry_module()
    queries, oracle = se.queries(), se.oracle_sql()
    from knnrec.plans.queries import QUERIES

    assert len(QUERIES) == 52 and set(QUERIES) <= set(queries) and set(QUERIES) <= set(oracle) <= set(queries)
    df = se.entry(spark)
    assert df.columns == ["mae", "n_test"]
    assert df.count() == 1


def test_oracle_columns_match_query_columns(spark):
    """Of the queries beside those that test_oracle compares whole."""
    from knnrec.plans.queries import QUERIES

    se = _entry_module()
    con = duckdb.connect()
    sf = "/root/testdata/sf0.001"
    from knnrec.sources.tables import TABLES, table_path

    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf, t)}')")
    for name, sql in se.oracle_sql().items():
        if name in QUERIES:
            continue
        spark_cols = sorted(se.queries()[name](spark, sf).columns)
        duck_cols = sorted(con.sql(f"SELECT * FROM ({sql}) LIMIT 0").columns)
        assert spark_cols == duck_cols, name


def test_sizing_conf():
    conf = sizing_conf(input_bytes=100 * 2**40, total_cores=8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 100 * 2**40 // (128 << 20)
    small = sizing_conf(input_bytes=10 << 20, total_cores=8)
    assert small["spark.sql.shuffle.partitions"] == "16"
