"""Queries whose users order their parts by a hash of every part."""

import hashlib
from itertools import permutations

import duckdb

from knnrec.operators.partition import ranked_parts
from knnrec.plans import params as p
from knnrec.plans.approximate import part_sets
from knnrec.plans.queries import QUERIES
from pyspark.sql import functions as F


def hashed(u, depth):
    key = lambda part: (hashlib.md5(f"1337:{u}:{part}".encode()).hexdigest(), part)
    return sorted(range(p.PARTITIONS), key=key)[:depth]


def tables(path, users, lines):
    con = duckdb.connect()
    con.execute(f"COPY (SELECT range AS o_orderkey, range AS o_custkey FROM range({users})) TO '{path}/orders.parquet'")
    con.execute(f"""COPY (SELECT u AS l_orderkey, (u * 7 + x * x) % 40 AS l_partkey, CAST(1 + (u * x) % 50 AS DOUBLE) AS l_quantity
        FROM range({users}) a(u), range({lines}) b(x)) TO '{path}/lineitem.parquet'""")
    return str(path)


def test_every_set_of_parts_is_reached(spark):
    users = spark.range(4000).select(F.col("id").alias("u"))
    assert part_sets(users, 10, [4], "hashed").count() == 210 > part_sets(users, 10, [4]).count()
    got = users.where("u < 50").select("u", ranked_parts(F.col("u"), 10, 3, order="hashed").alias("parts")).collect()
    assert all(r.parts == hashed(r.u, 3) for r in got)


def test_the_three_queries_compare_the_pairs_of_the_hashed_order(spark, tmp_path):
    sf, n = tables(tmp_path, 80, 12), 80
    ratio = {r.level: r.candidate_pairs for r in QUERIES["candidate_ratio"](spark, sf).collect()}
    for level in p.LEVELS:
        parts = [set(hashed(u, level)) for u in range(n)]
        assert ratio[level] == sum(bool(a & b) for a, b in permutations(parts, 2))
    parts = [set(hashed(u, p.REPLICATION)) for u in range(n)]
    every = QUERIES["similarity_all_pairs"](spark, sf).collect()
    want = {(r.u, r.v) for r in every if parts[r.u] & parts[r.v]}
    assert {(r.u, r.v) for r in QUERIES["similarity_blocked"](spark, sf).collect()} == want
    lists = {(r.u, r.v) for r in QUERIES["topk_approx"](spark, sf).collect()}
    best = {}
    for r in sorted(every, key=lambda r: (r.u, -r.sim, r.v)):
        if (r.u, r.v) in want and r.sim > 0:
            best.setdefault(r.u, []).append((r.u, r.v))
    assert lists and {x for some in best.values() for x in some[:p.K]} <= lists
