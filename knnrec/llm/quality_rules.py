"""Quality rules with adaptive thresholds, in DataFrame functions only.

Every document gets integer rule measures. A quantile sketch of each measure
is kept per language and source: counts of logarithmic buckets (exact below
32, then 16 to a doubling, so within 1/16), which merge by adding. The upper
fence of a measure is q75 + 3 * (q75 - q50) + a slack; a group of fewer than
``min_rows`` documents uses the merged sketch of its language, else of all
documents. A document over a fence, or below the lower one of the word length,
is rejected, as is one that fails the base rules.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from knnrec.llm.common import stage

#: measure: (slack above the fence, whether a lower fence holds too)
RULES = {
    "symbol_permille": (20, False),
    "dup_line_permille": (350, False),
    "repeat_word_permille": (350, False),
    "word_length_percent": (300, True),
}
SPACES = " \t\n\x0b\f\r"
NO_WORD = "[^\\x20\\x09-\\x0D]"


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, the base counts and the rule measures.

    Windows of three words are compared by their 64-bit hash; only documents
    in which some hash repeats sort their windows to find the words covered.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("source").cast("string"), text.alias("t"))
    words = F.filter(F.split("t", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split("t", "\n"), lambda line: F.regexp_like(line, F.lit(NO_WORD)))
    base = base.select(
        "doc_id", "lang", "source", words.alias("w"), lines.alias("lines"),
        F.length(F.translate("t", SPACES, "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
    )
    hashes = F.transform(
        F.sequence(F.lit(0), F.size("w") - 3), lambda i: F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2))
    )
    base = base.select(
        "doc_id", "lang", "source", "word_chars", "n_symbols",
        F.size("w").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("w") < 3, F.array().cast("array<long>")).otherwise(hashes).alias("h"),
    )
    base = base.withColumn("n_repeat_words", covered_words(F.col("h"))).drop("h")
    ratio = lambda a, b, k: F.floor(F.lit(k) * F.col(a) / F.greatest(F.col(b), F.lit(1))).cast("long")
    return base.select(
        "*",
        ratio("n_symbols", "word_chars", 1000).alias("symbol_permille"),
        ratio("n_dup_lines", "n_lines", 1000).alias("dup_line_permille"),
        ratio("n_repeat_words", "n_words", 1000).alias("repeat_word_permille"),
        ratio("word_chars", "n_words", 100).alias("word_length_percent"),
    )


def covered_words(h: Column) -> Column:
    """Words in windows whose hash ``h[i]`` occurs twice or more: the size of
    the union of {i, i+1, i+2}. Windows in order of place then add their
    uncovered words: min(3, distance to the repeated window before)."""
    ordered = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

    def repeated(s: Column) -> Column:
        same = lambda x, i: F.get(s, i)["h"].eqNullSafe(x["h"])
        hit = F.filter(s, lambda x, i: same(x, i - 1) | same(x, i + 1))
        return F.array_sort(F.transform(hit, lambda x: x["i"]))

    def union_size(p: Column) -> Column:
        return F.aggregate(
            F.transform(p, lambda x, k: F.when(k == 0, F.lit(3)).otherwise(F.least(F.lit(3), x - F.get(p, k - 1)))),
            F.lit(0),
            lambda total, x: total + x,
        )

    one = lambda value, f: F.get(F.transform(F.array(value), f), F.lit(0))  # noqa: E731  binds value once
    return (
        F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0))
        .otherwise(one(ordered, lambda s: one(repeated(s), union_size)))
        .cast("long")
    )


def bucket(value: Column) -> Column:
    """Sketch bucket of a non-negative whole number."""
    shift = F.greatest(F.length(F.bin(value)) - 5, F.lit(0))
    return (shift * 16 + F.floor(value / F.pow(F.lit(2.0), shift))).cast("long")


def bucket_value(b: Column) -> Column:
    """The smallest number of a bucket."""
    shift = F.greatest(F.floor(b / 16) - 1, F.lit(0))
    return ((b - shift * 16) * F.pow(F.lit(2.0), shift)).cast("long")


def sketches(measured: DataFrame) -> DataFrame:
    """(lang, source, measure, bucket, n): one mergeable sketch a group."""
    each = F.explode(F.array(*(F.struct(F.lit(m).alias("measure"), bucket(F.col(m)).alias("b")) for m in RULES)))
    return (
        measured.where("n_words > 0")
        .select("lang", "source", each.alias("x"))
        .groupBy("lang", "source", "x.measure", "x.b")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def quantiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Merge sketches to ``keys`` and read q50 and q75 of each measure, and
    the number of documents."""
    merged = sketch.groupBy(*keys, "measure", "b").agg(F.sum("n").alias("n"))
    upto = Window.partitionBy(*keys, "measure").orderBy("b")
    total = Window.partitionBy(*keys, "measure")
    ranked = merged.withColumn("upto", F.sum("n").over(upto)).withColumn("rows", F.sum("n").over(total))
    at = lambda q: F.min(F.when(F.col("upto") * 100 >= F.col("rows") * q, bucket_value(F.col("b"))))
    return ranked.groupBy(*keys, "measure").agg(at(25).alias("q25"), at(50).alias("q50"), at(75).alias("q75"), F.max("rows").alias("rows"))


def thresholds(sketch: DataFrame, min_rows: int) -> DataFrame:
    """Per (lang, source): the lower and upper fence of each measure."""
    own, of_lang, of_all = (quantiles(sketch, k) for k in (["lang", "source"], ["lang"], []))
    cols = ["q25", "q50", "q75"]
    lang = of_lang.select(F.col("lang").alias("lang_"), F.col("measure").alias("m_"), F.col("rows").alias("rows_l"), *(F.col(c).alias(f"{c}_l") for c in cols))
    whole = of_all.select(F.col("measure").alias("m__"), *(F.col(c).alias(f"{c}_a") for c in cols))
    joined = own.join(lang, F.col("lang").eqNullSafe(F.col("lang_")) & (F.col("measure") == F.col("m_")))
    joined = joined.join(whole, F.col("measure") == F.col("m__"))
    pick = lambda c: (
        F.when(F.col("rows") >= min_rows, F.col(c)).when(F.col("rows_l") >= min_rows, F.col(f"{c}_l")).otherwise(F.col(f"{c}_a"))
    )
    q25, q50, q75 = (pick(c) for c in cols)
    slack = reduce(lambda e, m: e.when(F.col("measure") == m, F.lit(RULES[m][0])), RULES, F.when(F.lit(False), F.lit(0)))
    fences = joined.select("lang", "source", "measure", (q75 + 3 * (q75 - q50) + slack).alias("hi"), (q25 - 3 * (q50 - q25) - slack).alias("lo"))
    return fences.groupBy("lang", "source").agg(
        *(F.max(F.when(F.col("measure") == m, F.col("hi"))).alias(f"{m}_hi") for m in RULES),
        *(F.max(F.when(F.col("measure") == m, F.col("lo"))).alias(f"{m}_lo") for m, (_, low) in RULES.items() if low),
    )


def judge(docs: DataFrame, min_rows: int = 30) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed (fewer than 50 words, or over half of them in repeated windows),
    kept, and failed_rules (names of the fences passed).

    Null text is empty and fails the base rules; null lang or source is a
    group of its own; repeated rows are judged alike; an empty table gives no
    rows; other columns are ignored.
    """
    measured = stage(measures(docs), "rules-measures")
    fences = thresholds(stage(sketches(measured), "rules-sketches"), min_rows)
    fences = fences.select(*(F.col(c).alias(f"{c}_") if c in ("lang", "source") else F.col(c) for c in fences.columns))
    found = measured.join(fences, F.col("lang").eqNullSafe(F.col("lang_")) & F.col("source").eqNullSafe(F.col("source_")), "left")
    over = [F.when(F.col(m) > F.col(f"{m}_hi"), F.lit(m)) for m in RULES]
    under = [F.when(F.col(m) < F.col(f"{m}_lo"), F.lit(f"{m}_low")) for m, (_, low) in RULES.items() if low]
    failed = F.when((F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")), True).otherwise(False)
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        F.array_compact(F.array(*over, *under)).alias("failed_rules"),
    ).withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
