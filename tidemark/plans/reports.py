"""Batch queries over the live table.

Each takes the live rows as a DataFrame (a keyed table read, or the batch
live plan) so the same report runs on either.  ``as_of`` replaces ``now()``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import micros_between, ms_between
from tidemark.operators.ranking import group_quantiles
from tidemark.streaming.progress import in_window


def alarms_now(live: DataFrame, ts: str = "reading_ts") -> DataFrame:
    """L1: keys not OK, newest reading first (a NULL status is excluded, as in SQL)."""
    return live.where(F.col("status") != "OK").orderBy(F.col(ts).desc())


def recent_updates(live: DataFrame, updated: str = "updated_ts", key: str = "sensor_asset_id",
                   n: int = 20) -> DataFrame:
    """L2: the ``n`` most recently updated rows (key breaks ties); a top-k, planned as TakeOrderedAndProject."""
    return live.orderBy(F.col(updated).desc(), F.col(key).asc()).limit(n)


def alarm_counts(live: DataFrame) -> DataFrame:
    """L3: HIGH, LOW and total in one row."""
    return live.agg(F.count_if(F.col("status") == "HIGH").alias("high"),
                    F.count_if(F.col("status") == "LOW").alias("low"),
                    F.count(F.lit(1)).alias("total"))


def status_breakdown(live: DataFrame) -> DataFrame:
    """Rows per status."""
    return live.groupBy("status").agg(F.count(F.lit(1)).alias("rows"))


def landing_report(live: DataFrame, as_of: Column, window_seconds: int,
                   key: str = "sensor_asset_id", event_ts: str = "reading_ts",
                   updated_ts: str = "updated_ts") -> DataFrame:
    """Total rows, rows and keys updated in the window (and per second), staleness, event-to-upsert p50/p95.

    "Upserts in the window" counts rows whose last update falls in it (one row
    per key).  Percentiles are exact (``percentile_cont``), in whole ms, and
    null when the window is empty.  Aggregates run with partial aggregation;
    the percentiles come from counts per distinct latency (``group_quantiles``),
    so no single task collects the window's rows.
    """
    win = in_window(updated_ts, as_of, window_seconds)
    base = live.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(win).alias("win_upserts"),
        F.count_distinct(F.when(win, F.col(key))).alias("win_sensors"),
        F.round(micros_between(as_of, F.max(updated_ts)) / F.lit(1000.0)).alias("staleness_ms"))
    lat = (live.where(win)
               .select((ms_between(updated_ts, event_ts) / F.lit(1000.0)).alias("lat_s")))
    q = group_quantiles(lat, [], "lat_s", {"p50": 0.5, "p95": 0.95}, method="cont")
    q = q.select(F.round(F.col("p50") * 1000).alias("p50_ms"), F.round(F.col("p95") * 1000).alias("p95_ms"))
    # Two one-row results side by side: union them and take each column's non-null value.
    both = base.unionByName(q, allowMissingColumns=True)
    return (both.agg(*[F.max(c).alias(c) for c in base.columns + q.columns])
                .withColumn("upserts_per_s", F.col("win_upserts") / F.lit(float(window_seconds))))
