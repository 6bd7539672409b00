"""Streaming upsert: late rows, restart, replay, validation, progress log, other sources."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators.latest import latest_per_key
from tidemark.sources.history import parse_json_events, rate_events, stream_table
from tidemark.streaming import sink
from tidemark.streaming.keyed import KeyedTable
from tidemark.streaming.progress import ProgressLog, parse_progress

SCHEMA = "k string, ts timestamp, v double"


def _run(spark, src, target, chk, **kw):
    stream = stream_table(spark, src, schema=spark.createDataFrame([], SCHEMA).schema)
    latest = latest_per_key(stream.withWatermark("ts", "30 seconds"), "k", "ts", ["v"])
    q = sink.upsert_stream(latest, target, "k", chk, trigger="availableNow", unique=True, **kw)
    sink.await_completion(q, 300)
    return q


def test_late_rows_restart_and_reemit(spark, workdir):
    src, target, chk = f"{workdir}/src", f"{workdir}/live", f"{workdir}/chk"
    t = lambda h, m: dt.datetime(2024, 1, 1, h, m)
    spark.createDataFrame([("a", t(12, 0), 1.0), ("a", t(12, 10), 2.0)], SCHEMA).write.mode("append").parquet(src)
    _run(spark, src, target, chk)
    assert {r.k: r.v for r in KeyedTable(spark, target).read().collect()} == {"a": 2.0}
    # second run resumes from the checkpoint; a late row for a known key and an old row for a new key
    spark.createDataFrame([("a", t(12, 1), 3.0), ("b", t(9, 0), 4.0)], SCHEMA).write.mode("append").parquet(src)
    q = _run(spark, src, target, chk)
    state = {r.k: (r.ts, r.v) for r in KeyedTable(spark, target).read().collect()}
    assert state["a"][1] == 2.0 and state["a"][0].replace(tzinfo=None) == t(12, 10)   # unchanged newest row
    assert state["b"][1] == 4.0                                                          # accepted, not dropped
    writer = sink.query_id(spark, chk)
    last = max(b for (w, b) in sink.SINK_ROWS if w == writer)
    assert sink.SINK_ROWS[(writer, last)] == 2       # a re-emitted unchanged, b inserted
    assert q.lastProgress is None or q.lastProgress["numInputRows"] >= 0


def test_replay_of_a_batch_is_skipped(spark, workdir):
    fn = sink.upsert_batch_fn(f"{workdir}/t", ["k"], writer="w")
    b = spark.createDataFrame([("a", dt.datetime(2024, 1, 1), 1.0)], SCHEMA)
    fn(b, 0)
    fn(spark.createDataFrame([("a", dt.datetime(2024, 1, 2), 9.0)], SCHEMA), 0)
    assert KeyedTable(spark, f"{workdir}/t").read().first().v == 1.0
    assert sink.SINK_ROWS[("w", 0)] == 0


def test_validation(spark):
    df = spark.createDataFrame([], "k string, d boolean, v double")
    with pytest.raises(ValueError, match="complete"):
        sink.validate_output_mode("complete")
    assert sink.validate_output_mode("Append") == "append"
    with pytest.raises(ValueError, match="real-time"):
        sink.trigger_args({"realTime": "5 seconds"})
    assert sink.trigger_args("once") == {"availableNow": True}
    assert sink.trigger_args(None) == {"processingTime": "1 second"}
    assert sink.trigger_args("0 seconds") == {"processingTime": "0 seconds"}
    assert sink.parse_key(' "k" , v ') == ["k", "v"]
    with pytest.raises(ValueError):
        sink.parse_key("")
    with pytest.raises(ValueError, match="not in the DataFrame"):
        sink.validate_key(df.schema, ["x"])
    with pytest.raises(TypeError):
        sink.validate_key(df.schema, ["d"])
    sink.validate_key(df.schema, ["k", "v"], ["v", "k"])       # in any order
    with pytest.raises(ValueError, match="differs"):
        sink.validate_key(df.schema, ["k"], ["k", "v"])


def test_a_folder_named_like_a_file_is_streamed_whole(spark, workdir):
    path = f"{workdir}/x.parquet"
    spark.range(100).repartition(4).write.parquet(path)
    spark.range(7).withColumn("p", F.lit(1)).write.partitionBy("p").parquet(f"{workdir}/other")     # a partitioned neighbour
    spark.range(3).coalesce(1).write.parquet(f"{workdir}/one")
    import glob
    import os
    file = glob.glob(f"{workdir}/one/part-*")[0]
    os.link(file, f"{workdir}/single.parquet")
    for name, n in (("x.parquet", 100), ("single.parquet", 3)):
        q = sink.insert_stream(stream_table(spark, f"{workdir}/{name}"), f"{workdir}/out-{n}", f"{workdir}/chk-{n}", trigger="availableNow")
        sink.await_completion(q, 300)
        assert spark.read.parquet(f"{workdir}/out-{n}").count() == n


def test_a_new_checkpoint_is_a_new_writer(spark, workdir):
    """Batch 0 of a new checkpoint, also at the old path, is no replay."""
    src, target, chk = f"{workdir}/src", f"{workdir}/live", f"{workdir}/chk"
    spark.createDataFrame([("a", dt.datetime(2024, 1, 1), 1.0)], SCHEMA).write.mode("append").parquet(src)
    _run(spark, src, target, chk)
    import os
    os.rename(chk, f"{chk}-lost")
    spark.createDataFrame([("b", dt.datetime(2024, 1, 1), 2.0)], SCHEMA).write.mode("append").parquet(src)
    _run(spark, src, target, chk)
    assert {r.k: r.v for r in KeyedTable(spark, target).read().collect()} == {"a": 1.0, "b": 2.0}


def test_retry_only_what_may_pass(spark, workdir, monkeypatch):
    t = KeyedTable.create(spark, f"{workdir}/t", spark.createDataFrame([], "k string, v double").schema, "k")
    calls = []

    def failing(error):
        def merge(self, batch, **kw):
            calls.append(error)
            raise error
        return merge

    for error, tries in ((OSError("connection reset by peer"), 3), (RuntimeError("division by zero"), 1), (ValueError("null key"), 1)):
        calls.clear()
        monkeypatch.setattr(KeyedTable, "merge", failing(error))
        with pytest.raises(type(error)):
            sink._merge_with_retry(t, None, "w", 0, None, True, retries=2, backoff=0.0)
        assert len(calls) == tries


def test_progress_log_and_errors(spark, workdir):
    log = ProgressLog(spark, f"{workdir}/progress")
    spark.streams.addListener(log)
    try:
        src = f"{workdir}/src"
        spark.createDataFrame([("a", dt.datetime(2024, 1, 1), 1.0), ("b", dt.datetime(2024, 1, 1), 2.0)],
                              SCHEMA).write.parquet(src)
        _run(spark, src, f"{workdir}/live", f"{workdir}/chk")
        import time
        time.sleep(1.0)
        assert log.flush() >= 1
        rows = log.read().collect()
        assert any(r.num_input_rows == 2 and r.num_output_rows == 2 for r in rows)
        # a failure while recording is swallowed and counted

        class E:
            class progress:
                @property
                def id(self):
                    raise RuntimeError("no id")
            progress = progress()
        with pytest.warns(UserWarning):
            log.onQueryProgress(E())
        assert log.errors == 1
        # a failure while writing keeps the documents for the next flush
        log._docs.append((json.dumps({"batchId": 77}), dt.datetime(2024, 1, 1), 5))
        good, log.path = log.path, "nosuchscheme://x/progress"
        with pytest.warns(UserWarning):
            assert log.flush() == 0
        assert log.pending() == 1
        log.path = good
        assert log.flush() == 1
        assert log.read().where("batch_id = 77").first().num_output_rows == 5
        # of other queries nothing is recorded when a name is given
        named = ProgressLog(spark, f"{workdir}/other", query_name="mine")

        class P:
            id, name, batchId, json = "q", "theirs", 0, "{}"

        class F_:
            progress = P
        named.onQueryProgress(F_())
        assert named.pending() == 0
    finally:
        spark.streams.removeListener(log)


def test_progress_defaults(spark):
    docs = [json.dumps({"batchId": 3, "numInputRows": 5, "timestamp": "2024-01-01T00:00:00.000Z",
                        "sink": {"numOutputRows": 4}, "durationMs": {"triggerExecution": 7}}),
            json.dumps({"timestamp": "2024-01-01T00:00:01.000Z"})]
    got = parse_progress(spark.createDataFrame([(d,) for d in docs], "json string")).collect()
    assert (got[0].batch_id, got[0].num_input_rows, got[0].num_output_rows, got[0].batch_duration_ms) == (3, 5, 4, 7.0)
    assert (got[1].batch_id, got[1].num_input_rows, got[1].num_output_rows, got[1].batch_duration_ms) == (-1, 0, -1, None)


def test_insert_only_stream_and_sources(spark, workdir):
    src = f"{workdir}/src"
    spark.createDataFrame([("a", dt.datetime(2024, 1, 1), 1.0)] * 3, SCHEMA).write.parquet(src)
    stream = stream_table(spark, src, schema=spark.createDataFrame([], SCHEMA).schema)
    q = sink.insert_stream(stream, f"{workdir}/out", f"{workdir}/chk", trigger="availableNow")
    sink.await_completion(q, 300)
    q = sink.insert_stream(stream, f"{workdir}/out", f"{workdir}/chk", trigger="availableNow")
    sink.await_completion(q, 300)                 # restart: nothing new, nothing duplicated
    assert spark.read.parquet(f"{workdir}/out").count() == 3
    payload = json.dumps({"device_id": "d1", "temperature": 21.5, "humidity": 40.0, "status": "OK",
                          "event_ts": "2024-01-01T00:00:00Z"})
    parsed = parse_json_events(spark.createDataFrame([(bytearray(payload.encode()),)], "value binary")).first()
    assert parsed.device_id == "d1" and parsed.temperature == 21.5
    rate = rate_events(spark, rows_per_second=10, micro_batch=True)
    q = rate.writeStream.format("memory").queryName("rate_t").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert set(spark.table("rate_t").columns) == {"device_id", "temperature", "humidity", "status", "event_ts"}


def test_start_live_state_with_dimension_reload(spark, workdir):
    """The one-call job; with reload_dim a changed dimension applies from the next micro-batch."""
    from tidemark import schemas
    from tests.fleet import fleet_dimension
    from tidemark.plans.live import start_live_state
    dim_path, hist = f"{workdir}/dim", f"{workdir}/history"
    dim = fleet_dimension(spark)
    dim.write.parquet(dim_path)
    sid = "IRON-BMS01-SOH"
    ts = dt.datetime(2026, 6, 23, 10, 0)
    row = (sid, "IRON_BMS01_SOH_PV", "IRON", ts, 80.0, 192, ts)
    spark.createDataFrame([row], schemas.HISTORY).write.mode("append").parquet(hist)
    q = start_live_state(spark, hist, dim_path, f"{workdir}/live", f"{workdir}/chk", trigger="availableNow",
                         reload_dim=True)
    sink.await_completion(q, 300)
    assert KeyedTable(spark, f"{workdir}/live").lookup(sid).first().status == "OK"
    # raise the SOH low band above the reading: the next batch re-reads the dimension
    dim.withColumn("alarm_low", F.when(F.col("sensor_asset_id") == sid, F.lit(90.0)).otherwise(F.col("alarm_low"))) \
       .write.mode("overwrite").parquet(dim_path)
    later = dt.datetime(2026, 6, 23, 10, 1)
    spark.createDataFrame([(sid, "IRON_BMS01_SOH_PV", "IRON", later, 81.0, 192, later)],
                          schemas.HISTORY).write.mode("append").parquet(hist)
    q = start_live_state(spark, hist, dim_path, f"{workdir}/live", f"{workdir}/chk", trigger="availableNow",
                         reload_dim=True)
    sink.await_completion(q, 300)
    r = KeyedTable(spark, f"{workdir}/live").lookup(sid).first()
    assert (r.value, r.status) == (81.0, "LOW") and r.updated_ts is not None


def test_table_overwrite_and_landing(spark, workdir):
    from tidemark.plans.reports import landing_report
    from tidemark.sources.tables import overwrite
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    overwrite(df, f"{workdir}/t")
    overwrite(df.limit(1).select("k"), f"{workdir}/t")
    assert spark.read.parquet(f"{workdir}/t").columns == ["k"]
    t0 = dt.datetime(2024, 1, 1)
    live = spark.createDataFrame([(str(i), t0, t0 + dt.timedelta(milliseconds=i)) for i in range(101)],
                                 "sensor_asset_id string, reading_ts timestamp, updated_ts timestamp")
    as_of = F.lit(dt.datetime(2024, 1, 1, 0, 0, 1))
    exact = landing_report(live, as_of, 10).first()
    assert (exact.total, exact.win_upserts, exact.win_sensors) == (101, 101, 101)
    assert exact.p50_ms == 50.0 and exact.p95_ms == 95.0 and exact.staleness_ms == 900.0
    assert exact.upserts_per_s == 10.1


def test_sync_triggered_and_kafka_gate(spark, workdir):
    from tidemark.sources.history import kafka_events
    from tidemark.streaming.sync import sync_table
    src = f"{workdir}/cust"
    spark.read.parquet("/root/testdata/sf0.001/customer.parquet").write.parquet(src)
    q = sync_table(spark, src, f"{workdir}/copy", "c_custkey", f"{workdir}/chk", mode="triggered")
    sink.await_completion(q, 300)
    got = KeyedTable(spark, f"{workdir}/copy").read()
    assert got.count() == spark.read.parquet(src).count()
    snap = sync_table(spark, src, f"{workdir}/snap", "c_custkey", mode="snapshot")
    assert snap.read().count() == got.count()
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka_events(spark, "localhost:9092", "t")


def test_job_flushes_progress_of_a_failed_query(spark):
    from tidemark.job import await_with_progress
    flushed = []

    class Query:
        def awaitTermination(self, sec):
            raise RuntimeError("the query failed")

    class Log:
        def flush(self):
            flushed.append(1)

    with pytest.raises(RuntimeError):
        await_with_progress(Query(), Log())
    assert flushed == [1]


def test_a_cluster_must_name_a_shared_folder(spark, monkeypatch):
    import tidemark.session as session

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "yarn"}.get(key, default)

    class Context:
        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session._checkpoint_base(Session())


def test_job_run_and_report(spark, workdir, capsys):
    """The command-line job: run the stream with a progress log, then print both reports."""
    from tidemark import schemas
    from tidemark.job import main
    from tests.fleet import fleet_dimension
    dim = fleet_dimension(spark)
    dim.write.parquet(f"{workdir}/dim")
    ts = dt.datetime(2026, 6, 23, 10, 0)
    rows = [(r.sensor_asset_id, r.scada_tag, r.site_code, ts, 1.0, 192, ts) for r in dim.collect()]
    spark.createDataFrame(rows, schemas.HISTORY).write.parquet(f"{workdir}/history")
    args = ["run", "--history", f"{workdir}/history", "--dim", f"{workdir}/dim", "--target", f"{workdir}/live",
            "--checkpoint", f"{workdir}/chk", "--trigger", "availableNow", "--progress", f"{workdir}/progress"]
    assert main(args, spark) == 0
    capsys.readouterr()
    prev = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")      # the report must not depend on it
    try:
        assert main(["report", "--target", f"{workdir}/live", "--progress", f"{workdir}/progress",
                     "--window", "3600"], spark) == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["landing"]["total"] == 184 and out["landing"]["win_upserts"] == 184
    assert out["progress"]["batches"] >= 1 and out["progress"]["in_rows"] == 184
    assert out["progress"]["out_rows"] == 184 and out["progress"]["out_unknown"] is False


def test_processing_time_stream_picks_up_new_files(spark, workdir):
    """A running stream on the default 1 s trigger upserts files as they arrive (continuous sync)."""
    from tidemark.streaming.sync import sync_table
    src = f"{workdir}/src"
    schema = "k string, ts timestamp, v double"
    spark.createDataFrame([("a", dt.datetime(2024, 1, 1), 1.0)], schema).write.mode("append").parquet(src)
    q = sync_table(spark, src, f"{workdir}/copy", "k", f"{workdir}/chk", mode="continuous", interval="1 second")
    try:
        q.processAllAvailable()
        assert {r.k: r.v for r in KeyedTable(spark, f"{workdir}/copy").read().collect()} == {"a": 1.0}
        spark.createDataFrame([("a", dt.datetime(2024, 1, 2), 2.0), ("b", dt.datetime(2024, 1, 2), 3.0)],
                              schema).write.mode("append").parquet(src)
        q.processAllAvailable()
        assert {r.k: r.v for r in KeyedTable(spark, f"{workdir}/copy").read().collect()} == {"a": 2.0, "b": 3.0}
        assert q.isActive
    finally:
        q.stop()


def test_keyed_dimension_reads_only_touched_buckets(spark, workdir):
    from tidemark import schemas
    from tidemark.operators.enrich import enrich_from_keyed
    from tests.fleet import fleet_dimension
    from tidemark.plans.live import start_live_state
    dim = fleet_dimension(spark)
    table = KeyedTable.create(spark, f"{workdir}/dim", dim.schema, "sensor_asset_id", buckets=32)
    table.merge(dim, unique=True)
    few = dim.limit(3).select("sensor_asset_id")
    touched = table.buckets_of(few)
    assert 1 <= len(touched) <= 3
    assert table.read_buckets(touched).count() < 184
    joined = enrich_from_keyed(few, table, "sensor_asset_id", ["site_code", "alarm_high"])
    assert joined.count() == 3 and joined.where(F.col("site_code").isNull()).count() == 0
    # the live job with a keyed dimension (re-read per batch, pruned to touched buckets)
    sid = "IRON-BMS01-SOH"
    ts = dt.datetime(2026, 6, 23, 10, 0)
    spark.createDataFrame([(sid, "IRON_BMS01_SOH_PV", "IRON", ts, 65.0, 192, ts)],
                          schemas.HISTORY).write.parquet(f"{workdir}/history")
    q = start_live_state(spark, f"{workdir}/history", f"{workdir}/dim", f"{workdir}/live", f"{workdir}/chk",
                         trigger="availableNow", reload_dim=True)
    sink.await_completion(q, 300)
    r = KeyedTable(spark, f"{workdir}/live").lookup(sid).first()
    assert (r.site_code, r.status) == ("IRON", "LOW")


def test_target_by_table_name(spark, workdir):
    name = f"live_{abs(hash(workdir)) % 10**8}"
    path = sink.resolve_target(spark, name)
    assert path.endswith("/" + name) and sink.resolve_target(spark, "/a/b") == "/a/b"
    src = f"{workdir}/src"
    spark.createDataFrame([("a", dt.datetime(2024, 1, 1), 1.0)], SCHEMA).write.parquet(src)
    stream = stream_table(spark, src, schema=spark.createDataFrame([], SCHEMA).schema)
    q = sink.upsert_stream(stream, name, "k", f"{workdir}/chk", output_mode="append", trigger="availableNow")
    sink.await_completion(q, 300)
    assert KeyedTable(spark, path).read().count() == 1


def test_stream_recovers_after_a_failed_commit(spark, workdir, monkeypatch):
    """The merge of a micro-batch dies after writing data, before its commit; the query
    fails; a restart from the checkpoint replays that batch and the state is exact."""
    src, target, chk = f"{workdir}/src", f"{workdir}/live", f"{workdir}/chk"
    t = lambda d: dt.datetime(2024, 1, d)
    spark.createDataFrame([("a", t(1), 1.0), ("b", t(1), 2.0)], SCHEMA).write.mode("append").parquet(src)
    _run(spark, src, target, chk)                                   # batch 0 committed
    spark.createDataFrame([("a", t(2), 3.0), ("c", t(2), 4.0)], SCHEMA).write.mode("append").parquet(src)
    real = KeyedTable._commit
    calls = {"n": 0}

    def crash_once(self, entry):
        calls["n"] += 1
        if calls["n"] == 1:
            raise OSError("simulated crash after the data write, before the entry")
        return real(self, entry)

    monkeypatch.setattr(KeyedTable, "_commit", crash_once)
    stream = stream_table(spark, src, schema=spark.createDataFrame([], SCHEMA).schema)
    latest = latest_per_key(stream.withWatermark("ts", "30 seconds"), "k", "ts", ["v"])
    q = sink.upsert_stream(latest, target, "k", chk, trigger="availableNow", unique=True, retries=0)
    with pytest.raises(Exception):
        sink.await_completion(q, 300)
    assert {r.k: r.v for r in KeyedTable(spark, target).read().collect()} == {"a": 1.0, "b": 2.0}
    _run(spark, src, target, chk)                                   # restart replays the batch
    assert {r.k: r.v for r in KeyedTable(spark, target).read().collect()} == {"a": 3.0, "b": 2.0, "c": 4.0}
    assert calls["n"] >= 2


def test_live_stream_plan_shape(spark, workdir):
    """The stateful stream pre-aggregates before its shuffle and broadcasts the small dimension."""
    import contextlib
    import io

    from tidemark.plans import suite
    from tidemark.plans.live import live_rows
    sf = "/root/testdata/sf0.001"
    stream = stream_table(spark, f"{sf}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    latest = latest_per_key(stream.withWatermark("ts", "30 seconds"), "user_id", "ts", ["value"])
    out = live_rows(latest, suite.dimension(spark, sf), "user_id")
    q = (out.writeStream.outputMode("update").format("noop").option("checkpointLocation", f"{workdir}/chk")
         .trigger(availableNow=True).start())
    sink.await_completion(q, 300)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        q.explain()
    plan = buf.getvalue()
    assert "partial_max_by" in plan and "StateStoreSave" in plan and "BroadcastHashJoin" in plan
