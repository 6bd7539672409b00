"""Golden cases for the scalar functions and the newest-row aggregate."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions import classify_status, clip_to_range, compose_id, compose_tag, micros_to_ts
from tidemark.operators.latest import latest_per_key

NAN = float("nan")


def test_status_golden(spark):
    rows = [(None, 0.0, 10.0, "OK"), (10.0, 0.0, 10.0, "OK"), (NAN, 0.0, 10.0, "HIGH"), (NAN, 0.0, None, "OK"),
            (-1.0, 0.0, None, "LOW"), (11.0, None, None, "OK"), (11.0, 12.0, 10.0, "HIGH"), (109.53, 15.0, 95.0, "HIGH")]
    df = spark.createDataFrame(rows, "v double, lo double, hi double, want string")
    got = df.select(classify_status("v", "lo", "hi").alias("s"), "want").collect()
    assert [r.s for r in got] == [r.want for r in got]


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(None,), (0.5,), (50.12345,), (200.0,)], "v double")
    got = [r.c for r in df.select(clip_to_range("v", 1.0, 100.0).alias("c")).collect()]
    assert got == [None, 1.0, 50.123, 100.0]


def test_ids_and_tags(spark):
    df = spark.createDataFrame([("NRDG", "WTG", 2, "PWR-ACT")], "s string, p string, u int, k string")
    r = df.select(compose_id("s", "p", "u", "k").alias("i"), compose_tag("s", "p", "u", "k").alias("t")).first()
    assert r.i == "NRDG-WTG02-PWR-ACT" and r.t == "NRDG_WTG02_PWR-ACT_PV"


def test_wire_micros(spark):
    micros = 1_704_067_200_123_456
    r = spark.createDataFrame([(micros,)], "m long").select(micros_to_ts("m").alias("t")).first()
    assert r.t.replace(tzinfo=None) == dt.datetime(2024, 1, 1, 0, 0, 0, 123456)


def test_latest_null_and_ties(spark):
    t1, t2 = dt.datetime(2024, 1, 1, 12), dt.datetime(2024, 1, 1, 13)
    rows = [("a", None, 1.0, 1), ("a", t1, 2.0, 2),          # null ts never wins
            ("b", None, 3.0, 1), ("b", None, 4.0, 2),         # all null → nulls
            ("c", t2, 5.0, 1), ("c", t2, 6.0, 2)]             # tie → tiebreak decides
    df = spark.createDataFrame(rows, "k string, ts timestamp, v double, tb int")
    plain = {r.k: r for r in latest_per_key(df, "k", "ts", ["v", "tb"]).collect()}
    assert plain["a"].v == 2.0
    assert plain["b"].ts is None and plain["b"].v is None
    tied = {r.k: r for r in latest_per_key(df, "k", "ts", ["v"], tiebreak=["tb"]).collect()}
    assert tied["c"].v == 6.0 and tied["a"].v == 2.0 and tied["b"].v is None


def test_latest_has_partial_aggregation(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").cast("timestamp").alias("ts"),
                                  F.col("id").cast("double").alias("v"))
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        latest_per_key(df, "k", "ts", ["v"]).explain()
    assert "partial_max_by" in buf.getvalue()


def test_micros_to_ntz_ignores_session_zone(spark):
    from tidemark.functions import micros_between, micros_to_ntz
    prev = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        micros = 1_704_067_200_123_456
        r = spark.createDataFrame([(micros,)], "m long").select(micros_to_ntz("m").alias("t")).first()
        assert r.t == dt.datetime(2024, 1, 1, 0, 0, 0, 123456)
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        back = spark.createDataFrame([(r.t,)], "t timestamp_ntz").select(micros_between("t", epoch).alias("m")).first()
        assert back.m == micros
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)


def test_from_wire(spark):
    from tidemark import schemas
    from tidemark.sources.history import from_wire
    micros = 1_704_067_200_000_000
    wire = spark.createDataFrame([("S-1", "S_1_PV", "SITE", micros, 1.5, 192, micros + 1)], schemas.WIRE)
    r = from_wire(wire).first()
    assert [f.name for f in from_wire(wire).schema] == schemas.HISTORY.names
    assert r.reading_ts.replace(tzinfo=None) == dt.datetime(2024, 1, 1) and r.quality_code == 192
    assert (r.ingest_ts - r.reading_ts) == dt.timedelta(microseconds=1)


def test_fleet_ranges_clip(spark):
    from tests.fleet import fleet_ranges
    readings = spark.createDataFrame([("SOC", 120.0), ("PWR", -3000.0), ("SOH", None)], "key string, v double")
    got = {r.key: r.c for r in readings.join(fleet_ranges(spark), "key")
           .select("key", clip_to_range("v", F.col("min"), F.col("max")).alias("c")).collect()}
    assert got == {"SOC": 100.0, "PWR": -2500.0, "SOH": None}


def test_utc_wall_clock(spark):
    from tidemark.functions import utc_wall_clock
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Asia/Kolkata", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            r = spark.createDataFrame([(1_704_067_200_000_000,)], "m long").select(
                utc_wall_clock(micros_to_ts("m")).alias("t")).first()
            assert r.t == dt.datetime(2024, 1, 1), zone
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)


def test_join_strategy_follows_bytes(spark):
    """No job runs while the plan is built; a small dimension is broadcast, a large one is shuffled."""
    from tidemark.operators.enrich import enrich_left
    facts, dim = spark.range(1000).withColumnRenamed("id", "k"), spark.range(100000).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 10).alias("n"))
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    plans = []
    try:
        for limit in ("100m", "1k"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            plans.append(enrich_left(facts, dim, "k")._jdf.queryExecution().executedPlan().toString())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
    assert "BroadcastHashJoin" in plans[0] and "SortMergeJoin" in plans[1]
