"""Helpers shared by the training-data operators.

Text helpers work on the UTF-8 bytes of a whole Arrow column at once. Words
are runs of bytes other than space and 0x09-0x0D, which are single bytes in
UTF-8, so byte and character splitting agree.
"""

from __future__ import annotations


import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Bytes of text handled by one numpy pass (a single longer text is one pass).
PASS_BYTES = 2 << 20
#: Rows per Arrow batch: long texts must not add up to a huge batch.
ARROW_ROWS = 500

_STAGED: list[tuple[DataFrame, str]] = []


def prepare(spark: SparkSession) -> None:
    """Bound the Arrow batches that Python workers receive."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``. Unset: a temporary
    folder on a one-machine master, an error on a cluster."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="knnrec-shared-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def stage(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage
    and survives the loss of executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    _STAGED.append((table, path))
    return table


def _delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def unstage(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for df in tables:
        for entry in [t for t in _STAGED if t[0] is df]:
            _STAGED.remove(entry)
            _delete(df.sparkSession, entry[1])


def drop_stages(spark: SparkSession, keep: int = 0) -> None:
    """Delete the tables staged after the first ``keep`` ones; call it once
    their results are written."""
    while len(_STAGED) > keep:
        _delete(spark, _STAGED.pop()[1])


def staged_count() -> int:
    return len(_STAGED)


def hot_join(rows: DataFrame, facts: DataFrame, keys: list[str], how: str = "inner", parts: int = 1000) -> DataFrame:
    """``rows`` (staged: read several times) joined with ``facts`` (one row
    per key; ``how``: inner or left). Keys that hold more than 1 / ``parts`` of
    the rows, of which there are at most ``parts``, are joined by broadcast, so
    that no hot key is shuffled; the others by an ordinary join."""
    spark = rows.sparkSession
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_"))
    total = rows.count()
    found = counts.where(F.col("n_") * parts > max(total, ARROW_ROWS * parts)).select(*keys).collect()  # <= parts rows
    if not found:
        return rows.join(facts, keys, how)
    hot = F.broadcast(spark.createDataFrame(found, rows.select(*keys).schema))
    few = F.broadcast(facts.join(hot, keys, "left_semi"))
    split = rows.join(hot, keys, "left_semi").join(few, keys, how)
    return split.unionByName(rows.join(hot, keys, "left_anti").join(facts, keys, how))


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % F.lit(modulus)


def task_id() -> int:
    from pyspark import TaskContext

    context = TaskContext.get()
    return context.partitionId() if context else 0


# --------------------------------------------------------------------- text

_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes that end a word of letters and digits.
NOT_ALNUM = np.ones(256, dtype=bool)
NOT_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MULTIPLIER = 0x9E3779B97F4A7C15 | 5
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_powers = {"n": 0}


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _powers["n"] < n:
        size = max(n, PASS_BYTES, 2 * _powers["n"])
        for key, base in (("up", _MULTIPLIER), ("down", _INVERSE)):
            table = np.full(size, base, dtype=np.uint64)
            table[0] = 1
            _powers[key] = np.multiply.accumulate(table)
        _powers["n"] = size
    return _powers["up"], _powers["down"]


def column_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the n + 1 offsets; null counts as ''."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    array = array.cast(pa.large_string())
    if array.null_count:
        array = array.fill_null("")
    _, offsets, data = array.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64)[array.offset : array.offset + len(array) + 1]
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[offs[0] : offs[-1]], offs - offs[0]


def passes(array: pa.Array, limit: int = PASS_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) in runs of about ``limit`` bytes."""
    buf, offs = column_bytes(array)
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1)
        yield lo, hi, buf[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        lo = hi


class Words:
    """The words of a run of texts: byte spans, text index, 64-bit hash."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray, lower: bool = True, ends: np.ndarray = _SEPARATOR):
        inside = ~ends[buf]
        filled = offs[:-1] < offs[1:]
        before = np.empty_like(inside)
        before[1:] = inside[:-1]
        before[offs[:-1][filled]] = False
        after = np.empty_like(inside)
        after[:-1] = inside[1:]
        after[offs[1:][filled] - 1] = False
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.bytes = _LOWER[buf] if lower else buf
        self.texts = len(offs) - 1
        self.first = np.searchsorted(self.starts, offs)  # words before each text
        self.counts = np.diff(self.first)
        self.of = np.repeat(np.arange(self.texts), self.counts)
        up, down = _power_tables(len(buf) + 1)
        sums = np.zeros(len(buf) + 1, dtype=np.uint64)
        np.cumsum((self.bytes.astype(np.uint64) + np.uint64(1)) * up[: len(buf)], out=sums[1:])
        size = (self.ends - self.starts).astype(np.uint64)
        raw = (sums[self.ends] - sums[self.starts]) * down[self.starts]
        self.hash = mix64(raw ^ (size * np.uint64(0xD6E8FEB86659FD93)))


def shingles(words: Words, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``size``-word windows and the window offsets per text. A
    text with fewer words has its whole sequence as one, without words none."""
    n = words.counts
    windows = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    offs = np.concatenate(([0], np.cumsum(windows)))
    at = np.arange(offs[-1]) - np.repeat(offs[:-1], windows) + np.repeat(words.first[:-1], windows)
    short = np.repeat(np.minimum(n, size), windows)
    padded = np.concatenate((words.hash, np.zeros(size, np.uint64)))
    total = short.astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
    for j in range(size):
        term = padded[at + j] if not len(at) or short.min() > j else np.where(short > j, padded[at + j], np.uint64(0))
        total = mix64(total * np.uint64(0xE7037ED1A0B428DB) + term)
    return total, offs


def arrays(schema: pa.Schema, columns: dict) -> pa.RecordBatch:
    """A record batch from numpy arrays or lists, cast to ``schema``."""
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)




def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal whole-number ``keys`` in sorted batches. Holds
    one run at a time; callers bound the size of runs."""
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        ids = np.stack([t[k].to_numpy() for k in keys], axis=1)
        cuts = [0, *(np.flatnonzero((ids[1:] != ids[:-1]).any(axis=1)) + 1).tolist(), len(ids)]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            if held and any(held[0][k][0].as_py() != ids[lo, i] for i, k in enumerate(keys)):
                yield pa.concat_tables(held)
                held = []
            held.append(t.slice(lo, hi - lo))
    if held:
        yield pa.concat_tables(held)


def repeat_rows(docs: DataFrame, inputs: list[Column], times: Callable[[list[pa.Array]], np.ndarray]) -> DataFrame:
    """Each row of ``docs`` as often as ``times`` (of the ``inputs`` columns of
    a batch) says, 0 included, with all columns and without a join."""
    k = len(docs.columns)
    wide = docs.select("*", *inputs)
    wide = wide.toDF(*(f"c{i}" for i in range(len(wide.columns))))
    names = wide.columns[:k]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.array(np.repeat(np.arange(batch.num_rows), times(batch.columns[k:])))
            yield pa.RecordBatch.from_arrays([c.take(rows) for c in batch.columns[:k]], names=names)

    return wide.mapInArrow(run, StructType(wide.schema.fields[:k])).toDF(*docs.columns)
