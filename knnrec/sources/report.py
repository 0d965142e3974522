"""JSON result sink: one row of nested structs per run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def as_json(df: DataFrame, column: str = "report") -> DataFrame:
    """Each row as one JSON document (``to_json(struct(*))``)."""
    return df.select(F.to_json(F.struct(*df.columns)).alias(column))


def write_report(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write nested result rows as JSON lines (one small file)."""
    df.coalesce(1).write.mode(mode).json(path)
