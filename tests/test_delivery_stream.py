"""Streaming ack matching against the batch form."""

import datetime as dt
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.oracle import compare
from tidemark.operators.latency import delivery_per_second, fifo_match, with_in_flight
from tidemark.plans import suite
from tidemark.plans.suite_sql import SQL
from tidemark.sources.history import stream_table
from tidemark.streaming.delivery import delivery_stream, match_stream
from tidemark.streaming.sink import await_completion, insert_stream

SCHEMA = "k string, j int, ts timestamp, acked boolean, i long"
START = dt.datetime(2024, 1, 1)


def events(seed, count=600, keys=("a", "b", "c", "d", None)):
    """Sends and acks, some at the same time, acks before sends too; key a has half of them."""
    rnd = random.Random(seed)
    return [("a" if rnd.random() < 0.5 else rnd.choice(keys), rnd.randint(0, 1), START + dt.timedelta(milliseconds=250 * rnd.randint(0, 4 * 600)),
             rnd.random() < 0.45, i) for i in range(count)]


def batches(rows, files, jitter, seed):
    """Rows by time into files, each up to ``jitter`` seconds out of place."""
    rnd = random.Random(seed)
    out = [[] for _ in range(files)]
    for r in rows:
        at = (r[2] - START).total_seconds() + rnd.uniform(0, jitter)
        out[min(files - 1, int(at / 600 * files))].append(r)
    return out


def run(spark, src, work):
    stream = stream_table(spark, src, schema=spark.createDataFrame([], SCHEMA).schema, max_files_per_trigger=1)
    sends = stream.where(~F.col("acked")).select("k", "j", F.col("ts").alias("sent_ts"), "i")
    acks = stream.where("acked").select("k", "j", F.col("ts").alias("acked_ts"), "i")
    pairs = match_stream(sends, acks, ["k", "j"], order_tiebreak=["i"], delay="60 seconds")
    await_completion(insert_stream(pairs, f"{work}/pairs", f"{work}/checkpoint", trigger="availableNow"), 300)
    return {(r.k, r.j, r.n): (r.sent_ts, r.acked_ts, r.latency_ms) for r in spark.read.parquet(f"{work}/pairs").collect()}


def batch(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    m = fifo_match(df.where(~F.col("acked")).select("k", "j", F.col("ts").alias("sent_ts"), "i"),
                   df.where("acked").select("k", "j", F.col("ts").alias("acked_ts"), "i"), ["k", "j"], order_tiebreak=["i"])
    return {(r.k, r.j, r.n): (r.sent_ts, r.acked_ts, r.latency_ms) for r in m.where("sent_ts is not null and acked_ts is not null").collect()}


def append(spark, src, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(src)


def far(seconds=10_000):
    """Rows that let the watermark of both sides pass."""
    return [("far", 0, START + dt.timedelta(seconds=seconds), acked, 0) for acked in (False, True)]


def test_stream_equals_batch_over_several_runs(spark, workdir):
    rows = events(1)
    parts = batches(rows, 6, 50, 2)
    for part in parts[:3]:
        append(spark, f"{workdir}/src", part)
    early = run(spark, f"{workdir}/src", workdir)            # stopped, and started anew from the checkpoint
    for part in [*parts[3:], far()]:
        append(spark, f"{workdir}/src", part)
    got = run(spark, f"{workdir}/src", workdir)
    want = batch(spark, rows)
    assert got == want and len(want) > 100
    assert early and all(got[k] == v for k, v in early.items())     # what left early was right, and left once


def test_state_does_not_grow_with_the_run(spark, workdir):
    """Sends that are all acked: the state holds what arrived within the delay, however long the run."""
    rows = [("a", 0, START + dt.timedelta(seconds=s, milliseconds=500 * acked), bool(acked), s) for s in range(600) for acked in (0, 1)]
    for part in [*batches(rows, 5, 0, 0), far()]:
        append(spark, f"{workdir}/src", part)
    assert len(run(spark, f"{workdir}/src", workdir)) == 600
    held = spark.read.format("statestore").option("stateVarName", "waiting").load(f"{workdir}/checkpoint").count()
    assert held == 2                                           # the two far rows


@pytest.mark.parametrize("rows", [[], [("a", 0, None, True, 1), ("a", 0, None, False, 2)], [("a", 0, START, True, None)] * 3])
def test_nothing_to_match(spark, workdir, rows):
    append(spark, f"{workdir}/src", rows + far())
    assert run(spark, f"{workdir}/src", workdir) == {}


def per_second(spark, src, work):
    stream = stream_table(spark, src, schema=spark.createDataFrame([], SCHEMA).schema, max_files_per_trigger=1)
    sends = stream.where(~F.col("acked")).select("k", "j", F.col("ts").alias("sent_ts"), "i")
    acks = stream.where("acked").select("k", "j", F.col("ts").alias("acked_ts"), "i")
    errors = stream.where("i % 50 = 0").select(F.col("ts").alias("failed_ts"))
    per = delivery_stream(sends, acks, ["k", "j"], errors, order_tiebreak=["i"], delay="60 seconds")
    await_completion(insert_stream(per, f"{work}/seconds", f"{work}/seconds_checkpoint", trigger="availableNow"), 300)
    return with_in_flight(spark.read.parquet(f"{work}/seconds"))


def test_seconds_equal_batch_over_several_runs(spark, workdir):
    """Acks behind their sends: the rows are those of the batch form; closed seconds leave no state."""
    rnd = random.Random(5)
    rows = []
    for i in range(300):
        at = START + dt.timedelta(milliseconds=rnd.randint(0, 500_000))
        k, j = rnd.choice("ab"), rnd.randint(0, 1)
        rows.append((k, j, at, False, 2 * i))
        if i % 10:
            rows.append((k, j, at + dt.timedelta(milliseconds=rnd.randint(1, 4000)), True, 2 * i + 1))
    parts = batches(rows, 6, 50, 2)
    for part in parts[:3]:
        append(spark, f"{workdir}/src", part)
    early = {tuple(r) for r in per_second(spark, f"{workdir}/src", workdir).collect()}
    for part in [*parts[3:], [(*r[:4], 50) for r in far()]]:
        append(spark, f"{workdir}/src", part)
    cols = ["second", "sent", "acked", "errors", "p50_ms", "p95_ms", "max_ms", "in_flight"]
    got = {tuple(r) for r in per_second(spark, f"{workdir}/src", workdir).select(cols).collect()}
    df = spark.createDataFrame(rows, SCHEMA)
    m = fifo_match(df.where(~F.col("acked")).select("k", "j", F.col("ts").alias("sent_ts"), "i"),
                   df.where("acked").select("k", "j", F.col("ts").alias("acked_ts"), "i"), ["k", "j"], order_tiebreak=["i"])
    want = {tuple(r) for r in delivery_per_second(m, df.where("i % 50 = 0").select(F.col("ts").alias("failed_ts"))).select(cols).collect()}
    assert got == want and len(want) > 200 and early
    for operator in (0, 1):     # the two windowed aggregations hold the far second alone
        assert spark.read.format("statestore").option("operatorId", operator).load(f"{workdir}/seconds_checkpoint").count() <= 1


@pytest.mark.parametrize("name", ["fifo_match_stream", "delivery_stream"])
def test_queries_in_a_session_with_default_state(spark, workdir, name):
    """The registered queries where the session keeps Spark's default state provider; no errors, and the acks end long before the sends."""
    rnd = random.Random(7)
    rows = [(i, START + dt.timedelta(milliseconds=250 * rnd.randint(0, 4 * 86400 * 2)), rnd.randint(1, 3), rnd.choice(("click", "view"))) for i in range(200)]
    rows += [(200 + i, START + dt.timedelta(days=300, seconds=i), 1, "click") for i in range(50)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string").coalesce(1).write.parquet(f"{workdir}/events.parquet")
    other = spark.newSession()
    provider = "spark.sql.streaming.stateStore.providerClass"
    default = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    other.conf.set(provider, default)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{workdir}/events.parquet/*.parquet')")
    got = compare(other, workdir, name, suite.QUERIES[name], SQL[name], con)
    assert got["match"] and got["spark_rows"] > 30, got
    assert other.conf.get(provider) == default     # the session's own setting is back
