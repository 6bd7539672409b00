"""The live-state plan: newest reading per key → dimension → status.

One definition serves a batch DataFrame and a streaming one: the newest-row
aggregate is an ordinary ``groupBy().agg(max_by(...))``, the enrichment a left
join to a static dimension and the status a
``CASE`` expression, all inside Catalyst.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import classify_status
from tidemark.operators.enrich import enrich_left
from tidemark.operators.latest import latest_per_key

# Columns the live table takes from the dimension (the reading brings the rest).
SENSOR_DIM_COLUMNS = ["sensor_asset_id", "site_code", "site_name", "energy_source",
                      "measurement_type", "unit_of_measure", "alarm_low", "alarm_high"]
LIVE_COLUMNS = ["sensor_asset_id", "scada_tag", "site_code", "site_name", "energy_source",
                "measurement_type", "unit_of_measure", "value", "quality_code", "status",
                "reading_ts", "updated_ts"]


def live_rows(latest: DataFrame, dim: DataFrame, keys: Sequence[str] | str,
              value: str = "value", low: str = "alarm_low", high: str = "alarm_high") -> DataFrame:
    """Left-join newest readings to the dimension and add ``status``."""
    return (enrich_left(latest, dim, keys)
            .withColumn("status", classify_status(value, low, high)))


def sensor_latest(history: DataFrame, watermark: str | None = None) -> DataFrame:
    """Newest reading per sensor (optionally under an event-time watermark).

    The watermark is not a grouping key here, so it neither drops late rows nor
    expires state: a late row for a known key re-emits the unchanged newest row.
    """
    payload = ["value", "quality_code", "scada_tag"]
    if watermark:
        history = history.withWatermark("reading_ts", watermark)
    return latest_per_key(history, "sensor_asset_id", "reading_ts", payload)


def sensor_live(history: DataFrame, dim: DataFrame, watermark: str | None = None) -> DataFrame:
    """History (batch or stream) → rows of the live table, ``updated_ts`` = now."""
    latest = sensor_latest(history, watermark)
    return (live_rows(latest, dim.select(*SENSOR_DIM_COLUMNS), "sensor_asset_id")
            .withColumn("updated_ts", F.current_timestamp())
            .select(*LIVE_COLUMNS))


def start_live_state(spark, history_path: str, dim_path: str, target: str, checkpoint: str,
                     watermark: str = "30 seconds", trigger=None, output_mode: str = "update",
                     reload_dim: bool = False, query_name: str = "asset_live_state",
                     max_files_per_trigger: int | None = None):
    """The whole job: stream the history, keep the newest reading per sensor,
    enrich, classify and upsert into the keyed live table.

    With ``reload_dim`` the dimension is re-read inside every micro-batch, so a
    changed dimension is picked up without a restart (a plain static
    DataFrame pins its file list when the query starts).  If ``dim_path``
    holds a keyed table, each batch reads only the dimension buckets its keys
    fall in, instead of joining against the whole dimension.
    """
    from tidemark import schemas
    from tidemark.sources.history import read_table, stream_history
    from tidemark.streaming.sink import upsert_stream

    history = stream_history(spark, history_path, max_files_per_trigger)
    if not reload_dim:
        live = sensor_live(history, read_table(spark, dim_path, schemas.DIMENSION), watermark)
        return upsert_stream(live, target, schemas.LIVE_STATE_KEY, checkpoint, output_mode=output_mode,
                             trigger=trigger, defaults=schemas.LIVE_STATE_DEFAULTS,
                             query_name=query_name, unique=True)

    latest = sensor_latest(history, watermark)
    from tidemark.operators.enrich import enrich_from_keyed
    from tidemark.streaming.keyed import KeyedTable
    keyed_dim = KeyedTable.exists(spark, dim_path)

    def enrich(batch: DataFrame) -> DataFrame:
        if keyed_dim:
            # A dimension kept as a keyed table: read only the buckets this batch touches.
            joined = enrich_from_keyed(batch, KeyedTable(batch.sparkSession, dim_path), "sensor_asset_id",
                                       SENSOR_DIM_COLUMNS)
            rows = joined.withColumn("status", classify_status("value", "alarm_low", "alarm_high"))
        else:
            dim = read_table(batch.sparkSession, dim_path, schemas.DIMENSION)
            rows = live_rows(batch, dim.select(*SENSOR_DIM_COLUMNS), "sensor_asset_id")
        return rows.withColumn("updated_ts", F.current_timestamp()).select(*LIVE_COLUMNS)

    return upsert_stream(latest, target, schemas.LIVE_STATE_KEY, checkpoint, output_mode=output_mode,
                         trigger=trigger, transform=enrich, stage_before_transform=keyed_dim,
                         defaults=schemas.LIVE_STATE_DEFAULTS, query_name=query_name, unique=True)
