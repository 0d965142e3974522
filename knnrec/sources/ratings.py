"""Rating sources: the rating view over the order tables, the train/test
split, duplicate policies and the text-line parser."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from knnrec.sources.tables import read_table

RATING_LO = 1.0
RATING_HI = 5.0


def raw_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line: customer ``u``, part ``i``, quantity ``q``.

    A (u, i) pair repeats when a customer ordered a part more than once."""
    lineitem = read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_quantity")
    orders = read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    return lineitem.join(orders, lineitem.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias("u"),
        F.col("l_partkey").alias("i"),
        F.col("l_quantity").alias("q"),
    )


def quantity_to_rating(q: Column) -> Column:
    """Whole quantities 1..50 onto the 1..5 scale in bands of ten."""
    return (F.lit(1) + F.floor((q - F.lit(1)) / F.lit(10))).cast("double")


def rating_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ratings(u, i, r)``: one rating per pair, from the mean quantity."""
    return (
        raw_ratings(spark, sf_dir)
        .groupBy("u", "i")
        .agg((F.sum("q") / F.count(F.lit(1))).alias("q"))
        .select("u", "i", quantity_to_rating(F.col("q")).alias("r"))
    )


def raw_line_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-line ratings before duplicate handling."""
    return raw_ratings(spark, sf_dir).select("u", "i", quantity_to_rating(F.col("q")).alias("r"))


def dedup_ratings(ratings: DataFrame, policy: str = "avg", with_count: bool = False) -> DataFrame:
    """Collapse repeated (u, i) rows.

    ``sum`` adds them (what a sparse-matrix builder does), ``avg`` keeps the
    scale, ``error`` fails the job on the first repeated pair. The
    aggregation is partial on the map side, so a pair repeated many times
    costs no more shuffle than one that is not. ``with_count`` adds the
    number of rows per pair (``n``) from the same aggregate."""
    grouped = ratings.groupBy("u", "i")
    extra = [F.count(F.lit(1)).cast("long").alias("n")] if with_count else []
    if policy == "sum":
        return grouped.agg(F.sum("r").alias("r"), *extra)
    if policy == "avg":
        return grouped.agg((F.sum("r") / F.count(F.lit(1))).alias("r"), *extra)
    if policy == "error":
        out = grouped.agg(F.count(F.lit(1)).alias("_n"), F.first("r").alias("r"))
        return out.select(
            "u",
            "i",
            F.when(
                F.col("_n") > 1,
                F.raise_error(F.concat(F.lit("duplicate rating for pair "),
                                       F.col("u").cast("string"), F.lit(","),
                                       F.col("i").cast("string"))),
            ).otherwise(F.col("r")).cast("double").alias("r"),
            *([F.col("_n").cast("long").alias("n")] if with_count else []),
        )
    raise ValueError(f"unknown duplicate policy {policy!r}")


# Split rule shared with the SQL oracle: a pair is a test pair when
# (u * 31 + i * 17) is divisible by 5.
SPLIT_A, SPLIT_B, SPLIT_MOD = 31, 17, 5


def is_test_pair(u: Column, i: Column) -> Column:
    return ((u * SPLIT_A + i * SPLIT_B) % SPLIT_MOD) == 0


def split_train_test(ratings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Deterministic split by a hash of the pair; both halves stay lazy."""
    test_flag = is_test_pair(F.col("u"), F.col("i"))
    return ratings.where(~test_flag), ratings.where(test_flag)


def labelled_split(ratings: DataFrame) -> DataFrame:
    return ratings.select(
        "u", "i", "r",
        F.when(is_test_pair(F.col("u"), F.col("i")), "test").otherwise("train").alias("split"),
    )


# ---------------------------------------------------------------- text lines


def _int_field(value: Column, id_type: str) -> Column:
    # try_cast: a header word, a float id or an overflow becomes NULL.
    return F.trim(value).try_cast(id_type)


def _parsed_fields(lines: DataFrame, sep: str, id_type: str, lo: float, hi: float) -> DataFrame:
    """Split each line on ``sep`` (a regular expression, as in
    ``String.split``), trim the fields and try-cast the first three.
    The reject reason is the first check that fails. Other columns of
    ``lines`` are kept.

    The split goes through a generator of one row: no filter or projection on
    its fields is moved below it, so a line is made and split once."""
    once = lines.select("*", F.explode(F.array(F.split(F.col("value"), sep))).alias("_parts"))
    parts = F.col("_parts")
    u = _int_field(F.get(parts, 0), id_type)
    i = _int_field(F.get(parts, 1), id_type)
    r = F.trim(F.get(parts, 2)).try_cast("double")
    reason = (
        F.when(F.size(parts) < 3, F.lit("short"))
        .when(u.isNull(), F.lit("user"))
        .when(i.isNull(), F.lit("item"))
        .when(r.isNull(), F.lit("rating"))
        .when((r < lo) | (r > hi), F.lit("range"))
    )
    return once.select(*lines.columns, u.alias("u"), i.alias("i"), r.alias("r"), reason.alias("reason"))


def parse_rating_lines(
    lines: DataFrame,
    sep: str = "\t",
    id_offset: int = -1,
    id_type: str = "int",
    lo: float = RATING_LO,
    hi: float = RATING_HI,
) -> DataFrame:
    """``value: string`` lines -> ``(u, i, r)``. Fields after the third are
    ignored; ids are shifted by ``id_offset`` (files are 1-based)."""
    parsed = _parsed_fields(lines, sep, id_type, lo, hi)
    return parsed.where(F.col("reason").isNull()).select(
        (F.col("u").cast("long") + id_offset).alias("u"),
        (F.col("i").cast("long") + id_offset).alias("i"),
        F.col("r"),
    )


def reject_rating_lines(
    lines: DataFrame,
    sep: str = "\t",
    id_type: str = "int",
    lo: float = RATING_LO,
    hi: float = RATING_HI,
) -> DataFrame:
    """The lines ``parse_rating_lines`` drops, with the reason."""
    parsed = _parsed_fields(lines, sep, id_type, lo, hi)
    return parsed.where(F.col("reason").isNotNull()).select(F.col("value").alias("line"), "reason")


def read_rating_text(
    spark: SparkSession, path: str, sep: str = "\t", duplicates: str | None = None, **kwargs
) -> DataFrame:
    """Distributed scan of rating text files (one split per file block).

    ``duplicates``: policy for several lines of one (u, i), see
    ``dedup_ratings``; None keeps every line (a test set is scored line by
    line; ``fit_exact`` and ``fit_approx`` apply a policy of their own)."""
    ratings = parse_rating_lines(spark.read.text(path), sep=sep, **kwargs)
    return ratings if duplicates is None else dedup_ratings(ratings, duplicates)


def reject_rating_text(
    spark: SparkSession, path: str, sep: str = "\t", id_type: str = "int", lo: float = RATING_LO, hi: float = RATING_HI
) -> DataFrame:
    """``(file, line_no, line, reason)``: the lines of text files that
    ``read_rating_text`` drops and where they stand (from 1).

    Tasks read files in blocks. Counts per block (a partial aggregate) give the
    lines before each block, a row's place in its task the rest; the lines
    themselves are not shuffled."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
    )
    blocks = lines.groupBy("file", "block").agg(F.min("seq").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("file", "block", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    bad = _parsed_fields(lines, sep, id_type, lo, hi).where(F.col("reason").isNotNull())
    return bad.join(blocks, ["file", "block"]).select(
        "file", (F.col("before") + F.col("seq") - F.col("first") + 1).alias("line_no"), F.col("value").alias("line"), "reason")


# Lines of one rating in DAMAGE_MOD are damaged, in one of these ways each
# (fixed rule, FIXTURES.md), so rejects of every kind grow with the data.
DAMAGE_A, DAMAGE_B, DAMAGE_MOD = 13, 7, 97
DAMAGES = ("short", "float user", "overflow user", "bad item", "bad rating", "range", "blank")


def rating_lines(ratings: DataFrame, sep: str = "\t") -> DataFrame:
    """Render ratings as 1-based text lines (with an unused fourth field);
    the damage rule spoils some of them."""
    u, i, r = (F.col("u") + 1).cast("string"), (F.col("i") + 1).cast("string"), F.col("r").cast("string")
    spoiled = {
        "short": F.concat_ws(sep, u, i),
        "float user": F.concat_ws(sep, F.concat(u, F.lit(".5")), i, r),
        "overflow user": F.concat_ws(sep, F.concat(F.lit("99999999999"), u), i, r),
        "bad item": F.concat_ws(sep, u, F.concat(F.lit("x"), i), r),
        "bad rating": F.concat_ws(sep, u, i, F.lit("five")),
        "range": F.concat_ws(sep, u, i, (F.col("r") + 5).cast("string")),
        "blank": F.lit(""),
    }
    kind = (F.col("u") * DAMAGE_A + F.col("i") * DAMAGE_B) % DAMAGE_MOD
    line = F.concat_ws(sep, u, i, r, F.lit("0"))
    for at, name in enumerate(DAMAGES):
        line = F.when(kind == at, spoiled[name]).otherwise(line)
    return ratings.select(line.alias("value"))
