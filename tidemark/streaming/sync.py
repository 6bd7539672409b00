"""M1: keep a keyed copy of a source table, in three modes.

- ``snapshot``: one batch job that replaces the copy (``KeyedTable.overwrite``);
- ``triggered``: an available-now stream over the source's new files that
  upserts them and stops;
- ``continuous``: the same stream on a processing-time trigger.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.sources.history import stream_table
from tidemark.streaming.keyed import KeyedTable
from tidemark.streaming.sink import upsert_stream

MODES = ("snapshot", "triggered", "continuous")


def sync_snapshot(source: DataFrame, target: str, keys: Sequence[str] | str,
                  buckets: int | None = None, order_by: Sequence[str] | str | None = None) -> KeyedTable:
    spark = source.sparkSession
    keys = [keys] if isinstance(keys, str) else list(keys)
    table = KeyedTable.create(spark, target, source.schema, keys, buckets=buckets)
    table.overwrite(source, order_by=order_by)
    return table


def sync_table(spark: SparkSession, source_path: str, target: str, keys: Sequence[str] | str,
               checkpoint: str | None = None, mode: str = "snapshot",
               interval: str = "1 second", buckets: int | None = None,
               order_by: Sequence[str] | str | None = None) -> KeyedTable | StreamingQuery:
    """Sync ``source_path`` (Parquet) into the keyed table at ``target``.

    ``order_by`` keeps the newest row of a key, whatever file it comes in.
    Returns the table for ``snapshot``, the running query otherwise.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if mode == "snapshot":
        return sync_snapshot(spark.read.parquet(source_path), target, keys, buckets, order_by)
    trigger = "availableNow" if mode == "triggered" else interval
    stream = stream_table(spark, source_path)
    return upsert_stream(stream, target, keys, checkpoint, output_mode="append",
                         trigger=trigger, buckets=buckets, order_by=order_by)
