"""Session construction and lineage control."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: adaptive execution (runtime coalescing,
# skew-join splitting, broadcast conversion from measured sizes), UTC
# dates, and no web UI.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when that costs one more shuffle (the
    # joins here are usually followed by an aggregate on the same key).
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Hash instead of sort for a shuffled join only when AQE has measured
    # every partition below this size; larger (or skewed) partitions keep
    # the spillable sort-merge join.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str = "local[8]",
    shuffle_partitions: int = 8,
    app_name: str = "knnrec",
    driver_memory: str = "16g",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Local session for tests and the benchmark. On a cluster, use the
    session the platform provides and only apply ``DEFAULT_CONF``."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", driver_memory)
    )
    for key, value in {**DEFAULT_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def sizing_conf(input_bytes: int, total_cores: int, partition_bytes: int = 128 << 20) -> dict[str, str]:
    """Shuffle and scan sizing for a cluster run: enough initial shuffle
    partitions that each holds about ``partition_bytes`` of the input
    (AQE coalesces small ones and splits skewed ones at run time), at
    least two waves of tasks, and scan splits of the same size."""
    partitions = max(2 * total_cores, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only on a one-machine master with nothing configured (a laptop or a test
    run) a private folder is created; on a cluster that is an error."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="knnrec-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_pinned: list[DataFrame] = []
_tables: list[tuple[DataFrame, str]] = []
# Row groups are what scans can split a file into: small enough that a
# coalesced file still feeds many tasks.
ROW_GROUP = 8 << 20


def write_table(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back. Later plans start
    from that scan: they stay small however many steps came before, and a lost
    executor costs its tasks only."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.option("parquet.block.size", ROW_GROUP).parquet(path)
    return delete_later(spark.read.schema(df.schema).parquet(path), path)


def delete_later(df: DataFrame, path: str) -> DataFrame:
    """``df``, whose files at ``path`` go with ``release`` or ``release_all``."""
    _tables.append((df, path))
    return df


def _delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def materialize(df: DataFrame, mode: str = "table") -> DataFrame:
    """Pin an intermediate that several consumers read.

    ``table``: written to the shared folder and read back (``write_table``).
    ``persist``: MEMORY_AND_DISK; a lost block is recomputed from lineage.
    Both are freed by ``release`` or, with all others, by ``release_all``.
    ``checkpoint``: written to the reliable checkpoint folder, which cuts
    the lineage (for long iterative plans or flaky executors).
    ``none``: leave it lazy."""
    if mode == "table":
        return write_table(df)
    if mode == "persist":
        _pinned.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return df
    if mode == "checkpoint":
        ensure_checkpoint_dir(df.sparkSession)
        return df.checkpoint(eager=True)
    if mode == "none":
        return df
    raise ValueError(f"unknown materialize mode: {mode!r}")


_sources: list[tuple[DataFrame, DataFrame]] = []


def made_of(df: DataFrame, source: DataFrame) -> DataFrame:
    """``df``, a view of the pinned ``source``, which ``release(df)`` frees."""
    _sources.append((df, source))
    return df


def release(*frames: DataFrame) -> None:
    for df in frames:
        if df is None:
            continue
        for entry in [s for s in _sources if s[0] is df]:
            _sources.remove(entry)
            release(entry[1])
        if df.is_cached:
            df.unpersist(blocking=False)
        for entry in [t for t in _tables if t[0] is df]:
            _tables.remove(entry)
            _delete(df.sparkSession, entry[1])


def release_all() -> None:
    """Free everything ``materialize`` has kept: call it when a result has
    been written."""
    _sources.clear()
    while _pinned:
        release(_pinned.pop())
    while _tables:
        df, path = _tables.pop()
        if df.sparkSession.sparkContext._jsc is not None:  # a stopped session's folder is gone or its owner's
            _delete(df.sparkSession, path)
