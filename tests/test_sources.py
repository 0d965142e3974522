import os
import tempfile

import pytest
from pyspark.sql import functions as F

from knnrec.sources.ratings import (
    dedup_ratings, labelled_split, parse_rating_lines, rating_lines, rating_view,
    read_rating_text, reject_rating_lines, reject_rating_text, split_train_test,
)
from tests.conftest import ratings_df

SF = "/root/testdata/sf0.001"


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


@pytest.mark.parametrize("sep", ["\t", "::"])
def test_parser_accepts_and_rejects(spark, sep):
    raw = ["1{s}2{s}5{s}0", " 3 {s} 4 {s} 2.0 ", "user{s}item{s}rating", "", "7", "1.5{s}2{s}3",
           "99999999999{s}1{s}3", "4{s}x{s}3", "4{s}5{s}x", "4{s}5{s}9", "+7{s}1{s}1"]
    df = lines(spark, [x.format(s=sep) for x in raw])
    good = sorted(tuple(r) for r in parse_rating_lines(df, sep).collect())
    assert good == [(0, 1, 5.0), (2, 3, 2.0), (6, 0, 1.0)]
    bad = {r.line: r.reason for r in reject_rating_lines(df, sep).collect()}
    assert bad == {
        "user{s}item{s}rating".format(s=sep): "user", "": "short", "7": "short",
        "1.5{s}2{s}3".format(s=sep): "user", "99999999999{s}1{s}3".format(s=sep): "user",
        "4{s}x{s}3".format(s=sep): "item", "4{s}5{s}x".format(s=sep): "rating",
        "4{s}5{s}9".format(s=sep): "range",
    }


def test_parser_keeps_zero_based_when_asked(spark):
    df = lines(spark, ["1\t2\t3"])
    assert tuple(parse_rating_lines(df, "\t", id_offset=0).first()) == (1, 2, 3.0)
    big = lines(spark, ["99999999999\t1\t3"])
    assert parse_rating_lines(big, "\t", id_type="bigint").count() == 1


def test_read_rating_text_file(spark):
    folder = tempfile.mkdtemp(prefix="knnrec-text-")
    path = os.path.join(folder, "ratings.dat")
    with open(path, "w") as fh:
        fh.write("1::10::4::978300760\n2::10::5::978300761\nbad::line\n")
    got = sorted(tuple(r) for r in read_rating_text(spark, path, "::").collect())
    assert got == [(0, 9, 4.0), (1, 9, 5.0)]


def test_round_trip_through_text(spark):
    ratings = rating_view(spark, SF)
    spoiled = (F.col("u") * 13 + F.col("i") * 7) % 97 < 7
    whole = ratings.where(~spoiled)
    parsed = parse_rating_lines(rating_lines(ratings, "\t"), "\t")
    assert parsed.exceptAll(whole).count() == 0 and whole.exceptAll(parsed).count() == 0
    rejects = reject_rating_lines(rating_lines(ratings, "::"), "::")
    assert rejects.count() == ratings.where(spoiled).count() > 100
    assert {r.reason for r in rejects.select("reason").distinct().collect()} == {"short", "user", "item", "rating", "range"}


def test_duplicate_lines_of_a_file(spark):
    folder = tempfile.mkdtemp(prefix="knnrec-text-")
    path = os.path.join(folder, "ratings.tsv")
    with open(path, "w") as fh:
        fh.write("1\t10\t4\n1\t10\t2\n2\t10\t5\n")
    assert read_rating_text(spark, path).count() == 3
    assert {tuple(r) for r in read_rating_text(spark, path, duplicates="avg").collect()} == {(0, 9, 3.0), (1, 9, 5.0)}


def test_dedup_policies(spark):
    df = ratings_df(spark, [(1, 1, 2), (1, 1, 4), (2, 1, 3)])
    assert {(r.u, r.r) for r in dedup_ratings(df, "sum").collect()} == {(1, 6.0), (2, 3.0)}
    assert {(r.u, r.r) for r in dedup_ratings(df, "avg").collect()} == {(1, 3.0), (2, 3.0)}
    assert dedup_ratings(df.where(F.col("u") == 2), "error").count() == 1
    with pytest.raises(Exception):
        dedup_ratings(df, "error").collect()


def test_rating_view_and_split_sizes(spark):
    ratings = rating_view(spark, SF)
    train, test = split_train_test(ratings)
    assert (ratings.count(), train.count(), test.count()) == (5382, 4301, 1081)
    r = ratings.agg(F.min("r"), F.max("r")).first()
    assert r[0] >= 1.0 and r[1] <= 5.0
    assert labelled_split(ratings).where(F.col("split") == "test").count() == 1081
    # every test user has train rows at this scale
    assert test.join(train, "u", "left_anti").count() == 0


def test_rejects_name_file_and_line(spark, tmp_path):
    """Several files, read in many blocks."""
    want = set()
    for name, n in (("a.tsv", 4000), ("b.tsv", 7), ("c.tsv", 1)):
        rows = []
        for k in range(1, n + 1):
            bad = k % 137 == 5 or n == 1
            rows.append(f"{k}\tx{k}\t3" if bad else f"{k}\t{k % 9 + 1}\t3")
            if bad:
                want.add((name, k, rows[-1], "item"))
        (tmp_path / name).write_text("\n".join(rows) + "\n")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        spark.conf.set("spark.sql.files.openCostInBytes", "16")
        got = {(os.path.basename(r.file), r.line_no, r.line, r.reason) for r in reject_rating_text(spark, str(tmp_path)).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == want and len(want) > 25


def test_a_line_is_split_once(spark):
    df = parse_rating_lines(rating_lines(rating_view(spark, SF)))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1
