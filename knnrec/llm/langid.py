"""Language identification by compression.

One zstandard raw-content dictionary per language is made from a bounded
sample of its training texts. Every piece of a text is compressed afresh with
every dictionary; the language with the smallest sum of outputs wins, and a
narrow lead is marked rejected.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knnrec.llm.common import fold, prepare, repeat_rows

_NOT_LETTERS = re.compile(r"[\W\d_]+")
UNDETERMINED = "und"
#: Most bytes compressed at once. A compressor learns the text itself, so over a
#: long one the dictionaries would all count for nothing.
PIECE_BYTES = 16 << 10


def normalise(text: str) -> bytes:
    """Lower-case letters; every run of other characters is one space."""
    return _NOT_LETTERS.sub(" ", text.lower()).encode("utf-8", "replace")


def pieces(data: bytes) -> list[bytes]:
    """The whole of ``data`` in the fewest pieces within PIECE_BYTES, of equal
    size but for rounding."""
    n = max(-(-len(data) // PIECE_BYTES), 1)
    return [data[len(data) * i // n : len(data) * (i + 1) // n] for i in range(n)]


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def learn(train: DataFrame, samples: int = 400, excerpt: int = 500, languages: int = 256) -> dict[str, bytes]:
    """Dictionary content per non-null lang: excerpts (``excerpt`` characters)
    of at most ``samples`` different texts. Texts fall into ``samples`` buckets
    by hash and the smallest hash of each bucket is taken, so copies count
    once, whatever their number. An excerpt starts anywhere in the whole text,
    as the hash says, so shared openings do not fill the dictionary; equal
    excerpts count once. At most ``languages`` values of ``lang`` are learned, those
    with most texts (ties: the first names), so a column of many stray values
    stays within bounds. The driver holds samples x excerpt characters per
    language."""
    named = train.where("lang IS NOT NULL AND text IS NOT NULL")
    common = named.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(languages).select("lang")
    rows = named.select("lang", "text", F.xxhash64("text").alias("h")).join(F.broadcast(common), "lang", "left_semi")
    chosen = rows.groupBy("lang", F.pmod("h", F.lit(samples)).alias("b")).agg(F.min("h").alias("h"))
    start = F.pmod(F.xxhash64("h", F.lit(11)), F.greatest(F.length("text") - excerpt, F.lit(0)) + 1) + 1
    excerpts = (
        rows.join(F.broadcast(chosen.select("lang", "h")), ["lang", "h"], "left_semi")
        .select("lang", "h", F.col("text").substr(start.cast("int"), F.lit(excerpt)).alias("t"))
        .dropDuplicates(["lang", "h"])
    )
    found: dict[str, list[tuple[int, str]]] = {}
    for row in excerpts.collect():
        found.setdefault(row["lang"], []).append((row["h"], row["t"]))
    content = {lang: normalise(" ".join(dict.fromkeys(t for _, t in sorted(parts)))) for lang, parts in sorted(found.items())}
    return {lang: data for lang, data in content.items() if len(data) >= 8}


def identify(
    docs: DataFrame, dictionaries: dict[str, bytes], level: int = 6, margin: float = 0.005
) -> DataFrame:
    """Columns of ``docs`` that are kept (doc_id) plus lang_pred, score, margin
    and rejected.

    lang_pred: the language of the smallest output (equal sizes: the first
    name); ``und`` if the text is null or has no letter, or nothing was
    learned. score: share of 2^-(bytes above the smallest) over all languages
    that the winner holds, 0 for und. margin: lead over the second, relative
    to the smallest output without the constant frame overhead; 1 with one language. Outputs are sums over
    the pieces of the text, so neither lead nor score fades with its length. rejected: und, or margin
    below the parameter. Rows are independent of each other, so repeated rows,
    empty tables and long texts need nothing special. Other columns are
    ignored.
    """
    prepare(docs.sparkSession)
    measure = classifier(dictionaries, level)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pred, score, lead = measure(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(lead, pa.float64())],
                names=["doc_id", "lang_pred", "score", "margin"],
            )

    found = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, lang_pred string, score double, margin double"
    )
    return found.withColumn("rejected", (F.col("lang_pred") == UNDETERMINED) | (F.col("margin") < margin))


def classifier(dictionaries: dict[str, bytes], level: int) -> Callable[[pa.Array], tuple[list, list, list]]:
    """Texts to their lang_pred, score and margin. Dictionaries are prepared
    once per task, in the task."""
    langs, ready = sorted(dictionaries), {}

    def tools() -> list[tuple]:
        if not ready:
            import zstandard

            ready["all"] = []
            for lang in langs:
                content = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                content.precompute_compress(level)
                one = zstandard.ZstdCompressor(dict_data=content, write_content_size=False, write_checksum=False)
                ready["all"].append((one, len(one.compress(b""))))
        return ready["all"]

    def measure(texts: pa.Array) -> tuple[list, list, list]:
        pred, score, lead = [], [], []
        for value in texts:
            text = value.as_py()
            if not langs or text is None or not has_letter(text):
                pred.append(UNDETERMINED), score.append(0.0), lead.append(0.0)
                continue
            parts = pieces(normalise(text))
            sizes = np.array([sum(len(t.compress(part)) - empty for part in parts) for t, empty in tools()])
            best = int(sizes.argmin())
            rest = np.delete(sizes, best)
            above = np.exp2(-np.minimum(sizes - sizes[best], 1000).astype(float))
            pred.append(langs[best])
            score.append(float(1.0 / above.sum()))
            lead.append(float((rest.min() - sizes[best]) / max(sizes[best], 1)) if len(rest) else 1.0)
        return pred, score, lead

    return measure


def keep_identified(docs: DataFrame, dictionaries: dict[str, bytes], level: int = 6, margin: float = 0.005) -> DataFrame:
    """The rows of ``docs`` that ``identify`` does not reject."""
    prepare(docs.sparkSession)
    measure = classifier(dictionaries, level)

    def times(columns: list[pa.Array]) -> np.ndarray:
        pred, _, lead = measure(columns[0])
        return np.array([p != UNDETERMINED and m >= margin for p, m in zip(pred, lead, strict=True)], dtype=bool)

    return repeat_rows(docs, [F.col("text").cast("string").alias("text")], times)


def training_rows(docs: DataFrame) -> DataFrame:
    """Rows that may be learned from: crc32 of the id modulo 4 is not 2."""
    return docs.where(fold(F.col("doc_id"), 4) != 2)


def classify(docs: DataFrame, level: int = 6, margin: float = 0.005) -> DataFrame:
    """Learn from the training rows of ``docs`` and identify all of them."""
    return identify(docs, learn(training_rows(docs)), level, margin)
