"""The demo fleet and the end-to-end proof: 2000 readings → one row per sensor."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tidemark import schemas
from tests.fleet import BAD_QUALITY, GOOD_QUALITY, fleet_dimension
from tidemark.plans.live import sensor_live
from tidemark.plans.reports import alarm_counts, status_breakdown
from tidemark.sources.history import stream_history
from tidemark.sources.tables import append_history
from tidemark.streaming import sink
from tidemark.streaming.keyed import KeyedTable


def _readings(dim_rows, n=2000, seed=42):
    rnd = random.Random(seed)
    t0 = dt.datetime(2026, 6, 23, 10, 0, 0)
    out = []
    for i in range(n):
        s = dim_rows[i] if i < len(dim_rows) else rnd.choice(dim_rows)   # every sensor at least once
        ts = t0 + dt.timedelta(milliseconds=500 * i)
        lo, hi = s.alarm_low, s.alarm_high
        mid = ((lo or 0.0) + (hi if hi is not None else (lo or 0.0) + 100.0)) / 2
        q = GOOD_QUALITY if rnd.random() > 0.02 else rnd.choice(BAD_QUALITY)
        out.append((s.sensor_asset_id, s.scada_tag, s.site_code, ts, round(mid, 3), q, ts))
    # the newest readings of two sensors leave their bands
    last = t0 + dt.timedelta(hours=1)
    bearing = next(s for s in dim_rows if s.sensor_asset_id.endswith("GEN-BRG-T"))
    soh = next(s for s in dim_rows if s.sensor_asset_id.endswith("-SOH"))
    out.append((bearing.sensor_asset_id, bearing.scada_tag, bearing.site_code, last, 109.53, GOOD_QUALITY, last))
    out.append((soh.sensor_asset_id, soh.scada_tag, soh.site_code, last, 65.0, GOOD_QUALITY, last))
    return out, bearing.sensor_asset_id, soh.sensor_asset_id


def test_fleet_has_184_sensors(spark):
    dim = fleet_dimension(spark)
    assert dim.count() == 184 and dim.select("sensor_asset_id").distinct().count() == 184
    r = dim.where(F.col("sensor_asset_id") == "NRDG-WTG02-PWR-ACT").first()
    assert r.scada_tag == "NRDG_WTG02_PWR-ACT_PV" and r.alarm_low is None and r.energy_source == "wind"
    assert [(f.name, f.dataType) for f in dim.schema] == [(f.name, f.dataType) for f in schemas.DIMENSION]


def test_proof_run_batch_and_stream(spark, workdir):
    dim = fleet_dimension(spark)
    rows, bearing, soh = _readings(dim.collect())
    history = spark.createDataFrame(rows, schemas.HISTORY)
    batch = sensor_live(history, dim)
    assert batch.count() == 184
    st = {r.sensor_asset_id: r.status for r in batch.collect()}
    assert st[bearing] == "HIGH" and st[soh] == "LOW"
    counts = alarm_counts(batch).first()
    assert (counts.high, counts.low, counts.total) == (1, 1, 184)

    # the same through the stream: clustered history appends, two runs, upsert by key
    path = f"{workdir}/history"
    append_history(history.limit(1000), path, files=2)
    target, chk = f"{workdir}/live", f"{workdir}/chk"

    def run():
        live = sensor_live(stream_history(spark, path, max_files_per_trigger=1), dim, watermark="30 seconds")
        q = sink.upsert_stream(live, target, "sensor_asset_id", chk, trigger="availableNow", unique=True,
                               defaults=schemas.LIVE_STATE_DEFAULTS, query_name="asset_live_state")
        sink.await_completion(q, 300)

    run()
    first = KeyedTable(spark, target).read().count()
    append_history(history.subtract(history.limit(1000)), path, files=2)
    run()
    table = KeyedTable(spark, target).read()
    assert table.count() == 184 and first <= 184
    got = {r.sensor_asset_id: (r.status, r.value) for r in table.collect()}
    want = {r.sensor_asset_id: (r.status, r.value) for r in batch.collect()}
    assert got == want
    assert {r.status: r.rows for r in status_breakdown(table).collect()} == {"OK": 182, "HIGH": 1, "LOW": 1}
