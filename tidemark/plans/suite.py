"""The registered queries, expressed on the supplied test tables.

The data model maps onto the test tables as follows:

- history: ``events`` (key ``user_id``, event time ``ts``, reading ``value``);
- dimension: ``customer`` ⋈ ``nation``, keyed by ``c_custkey`` = ``user_id``;
- alarm bands: fixed per market segment (below);
- ``upd``: a stand-in for ``updated_ts`` derived from the data
  (``ts + (event_id % 5000)`` ms), so clock-dependent reports are deterministic;
- ``as_of``: a fixed instant replacing ``now()``.

Every builder takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
tables.  Timestamps are returned as ``timestamp_ntz`` like the inputs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions import classify_status, clip_to_range, micros_between, utc_wall_clock
from tidemark.operators.changes import change_history
from tidemark.operators.enrich import enrich_left
from tidemark.operators.expand import expand_dimension
from tidemark.operators.latency import delivery_overall, delivery_per_second, delivery_report, fifo_match, nearest_rank, with_in_flight
from tidemark.operators.latest import latest_per_key
from tidemark.plans.live import live_rows
from tidemark.plans.reports import alarm_counts, alarms_now, landing_report, recent_updates, status_breakdown
from tidemark.session import shared_dir
from tidemark.sources.history import from_wire, parse_json_events, read_table, stream_table
from tidemark.sources.tables import append_history, overwrite
from tidemark.streaming.delivery import delivery_stream, match_stream
from tidemark.streaming.keyed import KeyedTable
from tidemark.streaming.progress import parse_progress, progress_report, running_totals
from tidemark.streaming.sink import await_completion, insert_stream, upsert_stream
from tidemark.streaming.sync import sync_snapshot, sync_table

# ---- fixed values ---------------------------------------------------------
# Alarm bands (low, high) per market segment; None = no band on that side.
SEGMENT_BANDS = {
    "AUTOMOBILE": (None, None),
    "BUILDING": (None, 60.0),
    "FURNITURE": (20.0, None),
    "HOUSEHOLD": (10.0, 80.0),
    "MACHINERY": (15.0, 75.0),
}
# Fixed instant that replaces now() in the reports, and their window.
AS_OF = "2024-01-31 00:00:00"
WINDOW_SECONDS = 10 * 24 * 3600
# ---------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _band(seg: Column, side: int) -> Column:
    expr = None
    for name, band in SEGMENT_BANDS.items():
        val = F.lit(band[side]).cast("double")
        expr = F.when(seg == name, val) if expr is None else expr.when(seg == name, val)
    return expr.otherwise(F.lit(None).cast("double"))


def dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per user: name, nation, segment and alarm bands."""
    cust = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    seg = F.col("c_mktsegment")
    return (cust.join(nation, cust.c_nationkey == nation.n_nationkey, "left")
                .select(F.col("c_custkey").alias("user_id"), "c_name", "n_name", "c_mktsegment",
                        _band(seg, 0).alias("alarm_low"), _band(seg, 1).alias("alarm_high")))


def latest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return latest_per_key(events, "user_id", "ts", ["value", "event_type", "event_id"])


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_left(latest_events(spark, sf_dir), dimension(spark, sf_dir), "user_id")


def live(spark: SparkSession, sf_dir: str) -> DataFrame:
    return live_rows(latest_events(spark, sf_dir), dimension(spark, sf_dir), "user_id")


def with_upd(df: DataFrame) -> DataFrame:
    """Stand-in for updated_ts, taken from the data rather than the clock."""
    return df.withColumn("upd", F.col("ts") + F.make_dt_interval(
        secs=(F.col("event_id") % 5000).cast("decimal(10,3)") / 1000))


# ---- A1, J1, C1 -----------------------------------------------------------

def q_latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_events(spark, sf_dir)


def q_enrich_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enriched(spark, sf_dir)


def q_status_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    dim = dimension(spark, sf_dir).select("user_id", "alarm_low", "alarm_high")
    return (enrich_left(events, dim, "user_id")
            .withColumn("status", classify_status("value", "alarm_low", "alarm_high")))


# ---- shared pieces for the remaining queries -------------------------------

def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp_ntz")


def _ntz_out(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return df


def _events_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    return stream_table(spark, path, max_files_per_trigger=max_files).withColumn(
        "ts", F.col("ts").cast("timestamp"))


def events_folder(spark: SparkSession, sf_dir: str, files: int = 8) -> DataFrame:
    """The events dealt to ``files`` numbers, so every file spans the whole time and later files hold late rows."""
    return table(spark, sf_dir, "events").withColumn("_file", F.pmod(F.xxhash64("event_id"), F.lit(files)).cast("int"))


ROW_GROUP_BYTES = 8 << 20


def write_files(df: DataFrame, path: str, first: int, last: int) -> None:
    """Append files ``first`` to ``last - 1`` of a numbered frame, one Parquet file each, in row groups that are read side by side."""
    part = df.where(F.col("_file").between(first, last - 1))
    part.repartitionById(last - first, F.col("_file") - first).drop("_file") \
        .write.option("parquet.block.size", str(ROW_GROUP_BYTES)).mode("append").parquet(path)


LIVE_OUT = ["user_id", "ts", "value", "event_type", "event_id", "c_name", "n_name",
            "c_mktsegment", "alarm_low", "alarm_high", "status"]


# ---- S1/S13: streaming scans into an insert-only sink ------------------------

def _insert_only_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = shared_dir(spark, "insert_only")
    src = _events_stream(spark, f"{sf_dir.rstrip('/')}/events.parquet")
    q = insert_stream(src, f"{work}/table", f"{work}/checkpoint", trigger="availableNow")
    await_completion(q)
    return spark.read.parquet(f"{work}/table")


def q_stream_scan_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _insert_only_run(spark, sf_dir).groupBy("event_type").agg(F.count(F.lit(1)).alias("rows"))


def q_insert_only_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _insert_only_run(spark, sf_dir).select("event_id", "user_id", "event_type", "ts", "value")
    return _ntz_out(out, "ts")


# ---- S12/T1-T3/T7/T11: the streaming upsert of the live state -----------------

def q_live_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream events → newest per key (watermark 30 s) → dimension → status → keyed upsert.

    Eight files are eight micro-batches: the state is carried from one to the
    next, and as every file spans the whole time, each but the first brings
    late rows.  Between the fourth and the fifth the stream is started anew
    from its checkpoint.
    """
    work = shared_dir(spark, "live_state")
    events, folder = events_folder(spark, sf_dir), f"{work}/events.parquet"
    for first in (0, 4):
        write_files(events, folder, first, first + 4)
        stream = _events_stream(spark, folder, max_files=1)
        latest = latest_per_key(stream.withWatermark("ts", "30 seconds"), "user_id", "ts",
                                ["value", "event_type", "event_id"])
        out = (live_rows(latest, dimension(spark, sf_dir), "user_id")
               .withColumn("updated_ts", F.current_timestamp()))
        q = upsert_stream(out, f"{work}/table", "user_id", f"{work}/checkpoint", output_mode="update",
                          trigger="availableNow", unique=True, query_name=None)
        await_completion(q)
    return _ntz_out(KeyedTable(spark, f"{work}/table").read().select(*LIVE_OUT), "ts")


def q_stream_dir_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that is a folder of files with a name like a file's."""
    work = shared_dir(spark, "stream_dir")
    write_files(events_folder(spark, sf_dir), f"{work}/events.parquet", 0, 8)
    q = insert_stream(_events_stream(spark, f"{work}/events.parquet"), f"{work}/table", f"{work}/checkpoint", trigger="availableNow")
    await_completion(q)
    return spark.read.parquet(f"{work}/table").groupBy("event_type").agg(F.count(F.lit(1)).alias("rows"))


def q_stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checkpoint is lost; a new one reads all files again and its batches all count."""
    work = shared_dir(spark, "stream_restart")
    events, folder = events_folder(spark, sf_dir), f"{work}/events.parquet"
    for run, (first, last) in enumerate(((0, 3), (3, 8))):
        write_files(events, folder, first, last)
        stream = _events_stream(spark, folder, max_files=2).select("user_id", "ts", "value")
        q = upsert_stream(stream, f"{work}/table", "user_id", f"{work}/checkpoint-{run}", output_mode="append",
                          trigger="availableNow", order_by=["ts"])
        await_completion(q)
    return _ntz_out(KeyedTable(spark, f"{work}/table").read(), "ts")


def q_live_state_stateless(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No stream state; each micro-batch is reduced, enriched and merged with a ts guard."""
    work = shared_dir(spark, "live_state_stateless")
    write_files(events_folder(spark, sf_dir), f"{work}/events", 0, 8)
    stream = _events_stream(spark, f"{work}/events", max_files=1)
    dim = dimension(spark, sf_dir)

    def per_batch(b: DataFrame) -> DataFrame:
        return live_rows(latest_per_key(b, "user_id", "ts", ["value", "event_type", "event_id"]), dim, "user_id")

    q = upsert_stream(stream, f"{work}/table", "user_id", f"{work}/checkpoint", output_mode="append",
                      trigger="availableNow", order_by=["ts"], unique=True, transform=per_batch)
    await_completion(q)
    return _ntz_out(KeyedTable(spark, f"{work}/table").read().select(*LIVE_OUT), "ts")


def q_composite_key_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A two-column upsert key, newest wins across micro-batches."""
    work = shared_dir(spark, "composite_key")
    write_files(events_folder(spark, sf_dir), f"{work}/events", 0, 8)
    stream = _events_stream(spark, f"{work}/events", max_files=1).select("user_id", "event_type", "ts", "value")
    q = upsert_stream(stream, f"{work}/table", "event_type, user_id", f"{work}/checkpoint",
                      output_mode="append", trigger="availableNow", order_by=["ts"])
    await_completion(q)
    return _ntz_out(KeyedTable(spark, f"{work}/table").read(), "ts")


def q_point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The live row of one key, read from its bucket only."""
    work = shared_dir(spark, "point_lookup")
    rows = live(spark, sf_dir)
    t = KeyedTable.create(spark, f"{work}/table", rows.schema, "user_id")
    t.merge(rows, unique=True)
    return t.lookup(7).select(*LIVE_OUT)


# ---- S9/C13, S10/C11, C12 ----------------------------------------------------

def q_wire_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as wire records (times as epoch microseconds) and back to history rows."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    e = table(spark, sf_dir, "events")
    micros = micros_between("ts", epoch)
    wire = e.select(F.col("event_id").cast("string").alias("sensor_asset_id"), F.col("event_type").alias("scada_tag"),
                    F.col("user_id").cast("string").alias("site_code"), micros.alias("reading_ts"), "value",
                    F.lit(192).alias("quality_code"), micros.alias("ingest_ts"))
    back = utc_wall_clock("reading_ts")
    rows = from_wire(wire).select(F.col("sensor_asset_id").cast("long").alias("event_id"), back.alias("ts_back"), "value", "quality_code")
    return (rows.join(e.select("event_id", "ts"), "event_id")
                .select("event_id", micros_between("ts", epoch).alias("ts_micros"), "ts_back", "value", "quality_code",
                        (F.col("ts_back") == F.col("ts")).alias("same")))


def q_json_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bus records whose value is JSON as bytes."""
    record = F.to_json(F.struct("event_type", F.from_json("props", "k int").getField("k").alias("k"))).cast("binary")
    bus = table(spark, sf_dir, "events").select(record.alias("value"))
    parsed = parse_json_events(bus, T.StructType.fromDDL("event_type string, k int"))
    return parsed.groupBy("event_type").agg(F.sum("k").alias("k_sum"), F.count("k").alias("k_count"))


def q_clip_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select("event_id", "value", clip_to_range("value", 1.0, 100.0, 3).alias("clipped"))


# ---- P4/C5/C6: dimension expansion -------------------------------------------

def unit_specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Specs per plant type from ``part``: each type (a region) takes the part types whose hash it shares."""
    part = table(spark, sf_dir, "part").groupBy("p_type").agg(
        F.min("p_partkey").alias("first"), F.min("p_size").alias("low"), F.max("p_size").alias("high"))
    regions = table(spark, sf_dir, "region").select(F.col("r_name").alias("type"), F.col("r_regionkey").alias("rk"))
    # One pair of rests per spec and type: an equi-join on the rest of a division.
    return (part.withColumn("rest", F.explode(F.array(F.col("first") % 5, (F.col("first") + 2) % 5))).join(
                regions.withColumn("rest", F.col("rk") % 5), "rest")
            .select("type", F.upper("p_type").alias("key"), F.lower("p_type").alias("measurement_type"),
                    F.lit("pcs").alias("unit_of_measure"), F.when(F.col("low") > 1, F.col("low")).alias("alarm_low"),
                    F.col("high").alias("alarm_high")))


def q_dim_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as plants (1-3 units by nation key), region as type, specs of the type for every unit."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    plants = (nation.join(region, nation.n_regionkey == region.r_regionkey)
                    .select(F.col("n_name").alias("site_code"), F.col("r_name").alias("type"),
                            F.upper(F.substring("r_name", 1, 3)).alias("unit_prefix"),
                            (F.col("n_nationkey") % 3 + 1).alias("num_units")))
    return expand_dimension(plants, unit_specs(spark, sf_dir)).select(
        "sensor_asset_id", "scada_tag", "site_code", "type", "unit_id",
        "measurement_type", "unit_of_measure", "alarm_low", "alarm_high")


# ---- L1-L5, A14: reports over the live state ---------------------------------

def q_alarms_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alarms_now(live(spark, sf_dir), "ts").select("user_id", "ts", "value", "status", "c_mktsegment")


def q_recent_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recent_updates(with_upd(live(spark, sf_dir)), "upd", "user_id", 20).select(
        "user_id", "upd", "ts", "value", "status")


def q_alarm_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alarm_counts(live(spark, sf_dir))


def q_status_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status_breakdown(live(spark, sf_dir))


def q_landing_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing_report(with_upd(latest_events(spark, sf_dir)), as_of(), WINDOW_SECONDS,
                          key="user_id", event_ts="ts", updated_ts="upd")


# ---- C10, L6, A11: progress ---------------------------------------------------

def progress_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Progress-like JSON documents, one per hour of events.

    ``sink`` is left out for hours 0-2 and ``durationMs`` for hours 3-4, so
    the parser's defaults are exercised.
    """
    e = table(spark, sf_dir, "events")
    hour = F.date_trunc("hour", F.col("ts"))
    per = e.groupBy(hour.alias("hour")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("users"),
        (F.max("event_id") - F.min("event_id")).alias("id_span"))
    h = F.hour("hour")
    epoch_hour = F.timestamp_diff("HOUR", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"), F.col("hour"))
    doc = F.struct(
        epoch_hour.alias("batchId"),
        F.date_format(F.col("hour") + F.expr("INTERVAL 1 HOUR"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("timestamp"),
        F.col("n").alias("numInputRows"),
        (F.col("n") / F.lit(3600.0)).alias("inputRowsPerSecond"),
        (F.col("n") * F.lit(1000.0) / (F.col("id_span") + 1)).alias("processedRowsPerSecond"),
        F.when(h >= 3, F.struct(F.when(~h.isin(3, 4), F.col("id_span")).alias("triggerExecution"))
               ).alias("durationMs"),
        F.when(h >= 3, F.struct(F.col("users").alias("numOutputRows"))).alias("sink"))
    return per.select(F.to_json(doc).alias("json"))


def q_progress_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ntz_out(parse_progress(progress_json(spark, sf_dir)), "event_ts")


def q_progress_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _ntz_out(parse_progress(progress_json(spark, sf_dir)), "event_ts")
    return progress_report(rows, as_of(), WINDOW_SECONDS)


def q_progress_running_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    day = F.to_date("ts").cast("timestamp_ntz")
    return running_totals(e, day, "rows").withColumnRenamed("period", "day")


# ---- J3, A12, A13: delivery latency --------------------------------------------

def _fifo(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    sends = e.where(F.col("event_type") == "click").select("user_id", F.col("ts").alias("sent_ts"), "event_id")
    acks = e.where(F.col("event_type") == "view").select("user_id", F.col("ts").alias("acked_ts"), "event_id")
    return fifo_match(sends, acks, "user_id", order_tiebreak=["event_id"])


def q_fifo_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fifo(spark, sf_dir)


#: How long a query waits for its stream of the whole table: its time grows with the stream keys.
STREAM_DAY_SEC = 86_400


def _delivery_streams(spark: SparkSession, sf_dir: str, work: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Streams of sends, acks and errors: eight files, each with rows up to two days younger or older than its neighbours'."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    day = F.timestamp_diff("DAY", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts")) + F.pmod(F.xxhash64("event_id"), F.lit(3))
    files = e.withColumn("_file", F.least(F.greatest(F.floor(day / 4), F.lit(0)), F.lit(7)).cast("int"))
    # Rows of one far time on all sides, also on a side that has no rows or ends early, let the watermark pass all others; they themselves wait for ever.
    last = e.agg((F.max("ts") + F.expr("INTERVAL 100 DAYS")).alias("ts")).select(
        F.lit(-1).cast("long").alias("event_id"), "ts", F.lit(-1).cast("long").alias("user_id"),
        F.explode(F.array(*map(F.lit, ("click", "view", "error")))).alias("event_type"), F.lit(8).alias("_file"))
    files = files.unionByName(last)
    for k in range(9):   # one after the other, so that they are read in this order
        write_files(files, f"{work}/events", k, k + 1)
    stream = _events_stream(spark, f"{work}/events", max_files=1)
    return (stream.where(F.col("event_type") == "click").select("user_id", F.col("ts").alias("sent_ts"), "event_id"),
            stream.where(F.col("event_type") == "view").select("user_id", F.col("ts").alias("acked_ts"), "event_id"),
            stream.where(F.col("event_type") == "error").select(F.col("ts").alias("failed_ts")))


def q_fifo_match_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3 on a stream with disorder over its files."""
    work = shared_dir(spark, "fifo_match_stream")
    sends, acks, _ = _delivery_streams(spark, sf_dir, work)
    pairs = match_stream(sends, acks, "user_id", order_tiebreak=["event_id"], delay="4 days")
    await_completion(insert_stream(pairs, f"{work}/pairs", f"{work}/checkpoint", trigger="availableNow"), STREAM_DAY_SEC)
    return _ntz_out(spark.read.parquet(f"{work}/pairs"), "sent_ts", "acked_ts")


def q_delivery_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A13 over time on a stream: matcher and two windowed aggregations in one query."""
    work = shared_dir(spark, "delivery_stream")
    sends, acks, errors = _delivery_streams(spark, sf_dir, work)
    per = delivery_stream(sends, acks, "user_id", errors, order_tiebreak=["event_id"], delay="4 days")
    await_completion(insert_stream(per, f"{work}/seconds", f"{work}/checkpoint", trigger="availableNow"), STREAM_DAY_SEC)
    return _ntz_out(with_in_flight(spark.read.parquet(f"{work}/seconds")), "second")


def q_nearest_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_rank(table(spark, sf_dir, "events"), ["event_type"], "value", {"p50": 0.5, "p95": 0.95})


def _errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").where(F.col("event_type") == "error").select("user_id", F.col("ts").alias("failed_ts"))


def q_delivery_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery_report(_fifo(spark, sf_dir), "user_id", _errors(spark, sf_dir))


def q_delivery_per_second(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery_per_second(_fifo(spark, sf_dir), _errors(spark, sf_dir))


def q_delivery_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delivery_overall(_fifo(spark, sf_dir), _errors(spark, sf_dir))


# ---- M1, M2: sync and change history --------------------------------------------

def q_sync_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A keyed copy of ``customer``: first loaded with stale rows, then replaced by a snapshot."""
    work = shared_dir(spark, "sync_snapshot")
    cust = table(spark, sf_dir, "customer")
    stale = cust.where(F.col("c_acctbal") < 0).withColumn("c_custkey", F.col("c_custkey") + 10_000_000)
    t = KeyedTable.create(spark, f"{work}/table", cust.schema, "c_custkey")
    t.merge(stale, unique=True)
    sync_snapshot(cust, f"{work}/table", "c_custkey")
    return KeyedTable(spark, f"{work}/table").read()


def orders_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second version of ``orders``: finished orders removed, urgent ones repriced (+100), pending ones re-keyed."""
    o = table(spark, sf_dir, "orders")
    kept = (o.where(F.col("o_orderstatus") != "F")
             .withColumn("o_totalprice", F.when(F.col("o_orderpriority") == "1-URGENT",
                                                F.col("o_totalprice") + F.lit(100.0))
                         .otherwise(F.col("o_totalprice"))))
    added = o.where(F.col("o_orderstatus") == "P").withColumn("o_orderkey", F.col("o_orderkey") + 10_000_000)
    return kept.unionByName(added)


def q_change_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = change_history(table(spark, sf_dir, "orders"), orders_v2(spark, sf_dir), "o_orderkey", 2,
                         ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"])
    return out.select("o_orderkey", "change_type", "version", "old_o_totalprice", "new_o_totalprice",
                      "old_o_orderstatus", "new_o_orderstatus")


def q_keyed_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2 on a keyed table: urgent orders repriced and pending ones re-keyed by a merge, between two stored versions."""
    work = shared_dir(spark, "keyed_changes")
    o = table(spark, sf_dir, "orders")
    t = KeyedTable.create(spark, f"{work}/table", o.schema, "o_orderkey")
    t.overwrite(o, unique=True)
    before = t.version
    urgent = o.where(F.col("o_orderpriority") == "1-URGENT").select("o_orderkey", (F.col("o_totalprice") + 100.0).alias("o_totalprice"))
    t.merge(urgent, unique=True)
    t.merge(o.where(F.col("o_orderstatus") == "P").withColumn("o_orderkey", F.col("o_orderkey") + 10_000_000), unique=True)
    out = t.changes(before, columns=["o_totalprice", "o_orderstatus"])
    return out.select("o_orderkey", "change_type", "old_o_totalprice", "new_o_totalprice", "old_o_orderstatus", "new_o_orderstatus")


def q_sync_triggered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1, triggered: a keyed copy of the newest event per user, fed by an available-now stream of the files."""
    work = shared_dir(spark, "sync_triggered")
    write_files(events_folder(spark, sf_dir, 4).drop("props"), f"{work}/source", 0, 4)
    q = sync_table(spark, f"{work}/source", f"{work}/table", "user_id", mode="triggered", checkpoint=f"{work}/checkpoint", order_by=["ts", "event_id"])
    await_completion(q)
    return KeyedTable(spark, f"{work}/table").read()


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as history rows, users dealt to seven sites."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("sensor_asset_id"), F.col("event_type").alias("scada_tag"),
        F.concat(F.lit("S"), (F.col("user_id") % 7).cast("string")).alias("site_code"), F.col("ts").alias("reading_ts"),
        "value", F.lit(192).alias("quality_code"), F.col("ts").alias("ingest_ts"))


def q_history_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings appended twice as a clustered history; the second load overwrites a summary."""
    work = shared_dir(spark, "history_append")
    rows = readings(spark, sf_dir)
    for rest in (0, 1):
        append_history(rows.where(F.col("sensor_asset_id").cast("long") % 2 == rest), f"{work}/history")
    history = read_table(spark, f"{work}/history", schemas.HISTORY)
    per_site = history.groupBy("site_code").agg(F.count(F.lit(1)).alias("readings"), F.max("value").alias("max_value"))
    overwrite(per_site.limit(0), f"{work}/summary")
    overwrite(per_site, f"{work}/summary")
    return read_table(spark, f"{work}/summary")


def q_history_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings clustered by site and time; one site, and one day, each read from the files that may hold them."""
    work = shared_dir(spark, "history_clustered")
    append_history(readings(spark, sf_dir), f"{work}/history", files=64)
    history = read_table(spark, f"{work}/history", schemas.HISTORY)
    ts = utc_wall_clock("reading_ts")
    start, stop = F.lit("2024-01-10 00:00:00 UTC").cast("timestamp"), F.lit("2024-01-11 00:00:00 UTC").cast("timestamp")
    one_site = history.where(F.col("site_code") == "S3").groupBy("scada_tag").agg(
        F.lit("site").alias("filter"), F.count(F.lit(1)).alias("readings"), F.max("value").alias("max_value"), F.max(ts).alias("newest"))
    one_day = history.where((F.col("reading_ts") >= start) & (F.col("reading_ts") < stop)).groupBy("scada_tag").agg(
        F.lit("day").alias("filter"), F.count(F.lit(1)).alias("readings"), F.max("value").alias("max_value"), F.max(ts).alias("newest"))
    return one_site.unionByName(one_day)


QUERIES = {
    "latest_per_key": q_latest_per_key,
    "enrich_left": q_enrich_left,
    "status_classify": q_status_classify,
    "stream_scan_count": q_stream_scan_count,
    "insert_only_stream": q_insert_only_stream,
    "stream_dir_scan": q_stream_dir_scan,
    "stream_restart": q_stream_restart,
    "live_state": q_live_state,
    "live_state_stateless": q_live_state_stateless,
    "composite_key_upsert": q_composite_key_upsert,
    "point_lookup": q_point_lookup,
    "wire_timestamp": q_wire_timestamp,
    "json_parse": q_json_parse,
    "clip_range": q_clip_range,
    "dim_expand": q_dim_expand,
    "alarms_now": q_alarms_now,
    "recent_updates": q_recent_updates,
    "alarm_counts": q_alarm_counts,
    "status_breakdown": q_status_breakdown,
    "landing_report": q_landing_report,
    "progress_parse": q_progress_parse,
    "progress_report": q_progress_report,
    "progress_running_total": q_progress_running_total,
    "fifo_match": q_fifo_match,
    "fifo_match_stream": q_fifo_match_stream,
    "delivery_stream": q_delivery_stream,
    "nearest_rank": q_nearest_rank,
    "delivery_report": q_delivery_report,
    "delivery_per_second": q_delivery_per_second,
    "delivery_overall": q_delivery_overall,
    "history_append": q_history_append,
    "history_clustered": q_history_clustered,
    "sync_snapshot": q_sync_snapshot,
    "sync_triggered": q_sync_triggered,
    "change_history": q_change_history,
    "keyed_changes": q_keyed_changes,
}
