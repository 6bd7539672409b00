"""Sinks for plain tables: overwrite (S4) and clustered history appends."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tidemark import schemas
from tidemark.operators.clustering import clustered


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a table, schema included (the writer overwrites files and schema)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def append_history(df: DataFrame, path: str, cluster_by: Sequence[str] = ("site_code", "reading_ts"),
                   files: int | None = None) -> None:
    """Append readings, clustered so Parquet min/max statistics skip files.

    The rows are laid along a space-filling curve through ``cluster_by``
    (``operators.clustering``), so a filter on the site alone and one on the
    time alone both skip most files.  Appends are at-least-once: duplicate
    rows are allowed, and the newest-row-per-key aggregate is insensitive to
    exact duplicates.
    """
    cols = [c for c in schemas.HISTORY.names if c in df.columns]
    out = df.select(*[df[c].cast(schemas.HISTORY[c].dataType).alias(c) for c in cols])
    with _times_with_statistics(df.sparkSession):
        clustered(out, cluster_by, files).write.mode("append").parquet(path)


@contextmanager
def _times_with_statistics(spark: SparkSession):
    """Spark's default form of a time in Parquet (INT96) has no minima and maxima; the one in microseconds has."""
    name = "spark.sql.parquet.outputTimestampType"
    before = spark.conf.get(name)
    spark.conf.set(name, "TIMESTAMP_MICROS")
    try:
        yield
    finally:
        spark.conf.set(name, before)
