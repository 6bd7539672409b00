"""The streaming matcher works on buckets of stream keys, not key by key."""

import datetime as dt
import random
from collections import defaultdict

from pyspark.sql import functions as F

from tests.test_delivery_stream import START, append, batch, far, run
from tidemark.operators.latency import fifo_match
from tidemark.sources.history import stream_table
from tidemark.streaming import delivery
from tidemark.streaming.sink import await_completion, insert_stream


def test_matched_against_queues():
    """Several rounds of due rows: numbers, pairs and queues are those of plain queues per key."""
    rnd = random.Random(3)
    table, queues, count = delivery._open([], [], [], [], []), defaultdict(lambda: ([], [])), defaultdict(int)
    for start in range(0, 8000, 1000):
        # From round to round other keys; some times are equal.
        due = [(rnd.choice(("a", "b", "", "é", f"k{rnd.randint(0, 30)}")), rnd.random() < 0.4 + start / 20000, start + rnd.randint(0, 99) * 10, str(rnd.randint(0, 9)))
               for _ in range(rnd.choice((1, 40, 200)))]
        table, got = delivery.matched(table, delivery._rows(*zip(*due)))
        want = []
        for key, acked, us, _ in sorted(due, key=lambda r: (r[0], r[2], r[3])):
            queues[key][acked].append(us)
        for key in sorted({r[0] for r in due}):
            sends, acks = queues[key]
            while sends and acks:
                count[key] += 1
                want.append((key, count[key], sends.pop(0), acks.pop(0)))
        assert sorted(zip(got["key"], got["n"], got["sent_us"], got["acked_us"])) == sorted(want)
        assert [t.value // 1000 for t in got["matched_ts"]] == [max(s, a) for s, a in zip(got["sent_us"], got["acked_us"])]
        held = {r["key"]: r for r in delivery._unpacked(delivery._packed(table)).to_pylist()}
        assert {k: r["n"] for k, r in held.items()} == {k: count[k] for k in queues}
        for key, (sends, acks) in queues.items():
            assert held[key]["left"] == (acks or sends) and (held[key]["acked"] or not acks)


def test_many_keys_share_the_state_of_a_bucket(spark, workdir):
    """Rows of 1500 keys wait in at most two packed lists for each bucket, and leave as the batch form says."""
    rows = [(f"k{k}", k % 2, START + dt.timedelta(seconds=k % 7 + 10 * acked), bool(acked), k) for k in range(1500) for acked in (0, 1) if k % 10 or not acked]
    append(spark, f"{workdir}/src", rows)
    assert run(spark, f"{workdir}/src", workdir) == {}
    assert spark.read.format("statestore").option("stateVarName", "waiting").load(f"{workdir}/checkpoint").count() <= 2 * delivery.BUCKETS
    append(spark, f"{workdir}/src", far())
    got = run(spark, f"{workdir}/src", workdir)
    assert got == batch(spark, rows) and len(got) == 1350


def test_keys_of_any_type(spark, workdir):
    """Whole numbers beyond 2^53 beside nulls, doubles, times, bytes and lists come back as they were."""
    schema = "l long, d double, t timestamp, b binary, a array<string>, ts timestamp, acked boolean, i long"
    keys = [(2**60 + 1, 0.5, START, b"\xff\x00", ["x", None]), (2**60, None, None, b"", []), (None, 1e-300, START + dt.timedelta(microseconds=1), None, None),
            (7, float("nan"), START, b'"', ['"\\\n']), (None, 0.0, None, None, None)]
    rows = [(*k, START + dt.timedelta(seconds=10 * n + 3 * acked), bool(acked), n) for k in keys for n in range(3) for acked in (0, 1) if n < 2 or not acked]
    rows += [(None, -0.0, None, None, None, START + dt.timedelta(seconds=50), True, 9)]      # belongs to 0.0
    last = [(*[None] * 5, START + dt.timedelta(seconds=9999), acked, 0) for acked in (False, True)]
    for part in (rows, last):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{workdir}/src")
    by = ["l", "d", "t", "b", "a"]

    def sides(df):
        return df.where(~F.col("acked")).select(*by, F.col("ts").alias("sent_ts"), "i"), df.where("acked").select(*by, F.col("ts").alias("acked_ts"), "i")

    pairs = delivery.match_stream(*sides(stream_table(spark, f"{workdir}/src", max_files_per_trigger=1)), by, order_tiebreak=["i"], delay="60 seconds")
    await_completion(insert_stream(pairs, f"{workdir}/pairs", f"{workdir}/checkpoint", trigger="availableNow"), 300)
    got = spark.read.parquet(f"{workdir}/pairs")
    assert dict(got.dtypes) | {"latency_ms": None} == dict(spark.createDataFrame([], schema).select(*by).dtypes) | {
        "n": "bigint", "sent_ts": "timestamp", "acked_ts": "timestamp", "latency_ms": None}
    want = fifo_match(*sides(spark.createDataFrame(rows, schema)), ["l", "d", "t", "b", "a"], order_tiebreak=["i"]).where("sent_ts is not null and acked_ts is not null")
    cols = [F.col("d").cast("string").alias("d") if c == "d" else c for c in got.columns]
    assert sorted(map(str, got.select(cols).collect())) == sorted(map(str, want.select(cols).collect())) and got.count() == 11
