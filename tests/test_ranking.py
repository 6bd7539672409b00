"""Row numbers and exact quantiles against plain Python."""

import datetime as dt
import math
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

import pytest

from tidemark.operators.latency import delivery_overall, delivery_per_second, delivery_report, fifo_match
from tidemark.operators.ranking import group_quantiles, group_row_number


def at_rank(values, q):
    """The value at rank (n-1)q, half to even, of the sorted values."""
    s = sorted(values)
    return s[min(len(s) - 1, round((len(s) - 1) * q))]


def between_ranks(values, q):
    """Linear between the values around rank (n-1)q."""
    s, pos = sorted(values), (len(values) - 1) * q
    lo = math.floor(pos)
    return s[lo] if lo == pos else s[lo] + (pos - lo) * (s[lo + 1] - s[lo])


def test_rank_rule(spark):
    for n, want in ((1, 0), (4, 2), (6, 2), (10, 4)):     # 1.5 and 2.5 round to the even rank, 4.5 too
        df = spark.range(n).select(F.lit(1).alias("g"), F.col("id").alias("v"))
        assert group_quantiles(df, ["g"], "v", {"p50": 0.5}, "nearest").first().p50 == want


def test_row_number_matches_window_on_a_hot_key(spark):
    rnd = random.Random(7)
    # key 0 holds about a third of all rows
    data = [(0 if rnd.random() < 0.34 else rnd.randint(1, 20), rnd.randint(0, 500), i) for i in range(3000)]
    df = spark.createDataFrame(data, "g long, o long, tb long")
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("o", "tb")))
    b = {(r.g, r.tb): r.rn for r in want.collect()}
    got = group_row_number(df, ["g"], ["o", "tb"], "rn")
    assert {(r.g, r.tb): r.rn for r in got.collect()} == b


def jobs_run(spark, build):
    """Spark jobs that ``build`` starts."""
    sc = spark.sparkContext
    sc.setJobGroup("building", "plan only")
    try:
        build()
        return len(sc.statusTracker().getJobIdsForGroup("building"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_no_job_while_the_plan_is_built(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("g"), F.col("id").cast("double").alias("v"), F.col("id").alias("t"))
    assert jobs_run(spark, lambda: (group_quantiles(df, ["g"], "v", {"p": 0.5}), group_row_number(df, ["g"], ["t"]))) == 0


def test_null_groups_and_null_values(spark):
    rows = [(None if i % 3 == 0 else i % 3, None if i % 5 == 0 else i % 7, i) for i in range(1000)]
    df = spark.createDataFrame(rows, "g long, o long, tb long")
    got = {r.tb: r.rn for r in group_row_number(df, ["g"], ["o", "tb"]).collect()}
    want = {}
    for g in (None, 1, 2):
        order = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        want.update({r[2]: n + 1 for n, r in enumerate(order)})
    assert got == want
    q = {r.g: r.p for r in group_quantiles(df, ["g"], "o", {"p": 0.5}, "nearest").collect()}
    assert q == {g: at_rank([r[1] for r in rows if r[0] == g and r[1] is not None], 0.5) for g in (None, 1, 2)}


def test_ties_strings_and_times(spark):
    """Nine of ten values are equal; order columns of any type."""
    rows = [(1, "same" if i % 10 else f"s{i:04d}", dt.datetime(2024, 1, 1) + dt.timedelta(seconds=0 if i % 10 else 37 * i), float("nan") if i == 7 else i % 4 - 1.5, i)
            for i in range(2000)]
    df = spark.createDataFrame(rows, "g long, s string, t timestamp_ntz, d double, i long")
    for c in ("s", "t", "d"):
        want = {r.i: r.rn for r in df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy(c, "i"))).collect()}
        assert {r.i: r.rn for r in group_row_number(df, ["g"], [c, "i"]).collect()} == want
    got = group_quantiles(df, ["g"], "s", {"lo": 0.0, "p50": 0.5, "hi": 1.0}, "nearest").first()
    assert (got.lo, got.p50, got.hi) == ("s0000", at_rank([r[1] for r in rows], 0.5), "same")
    with pytest.raises(TypeError, match="number"):
        group_quantiles(df, ["g"], "s", {"p50": 0.5}, "cont")


def test_quantiles_match_python(spark):
    rnd = random.Random(3)
    groups = {0: [rnd.uniform(0, 100) for _ in range(2000)], 1: [5.0], 2: [1.0, 2.0, 3.0, 4.0],
              3: [float(x) for x in range(6)], 4: [2.0, 2.0, 2.0, 9.0]}
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs] + [(5, None)], "g long, v double")
    qs = {"p50": 0.5, "p95": 0.95, "p0": 0.0, "p100": 1.0}
    cont = {r.g: r for r in group_quantiles(df, ["g"], "v", qs, "cont").collect()}
    near = {r.g: r for r in group_quantiles(df, ["g"], "v", qs, "nearest").collect()}
    assert 5 not in cont
    for g, vs in groups.items():
        for name, q in qs.items():
            assert abs(cont[g][name] - between_ranks(vs, q)) < 1e-9
            assert near[g][name] == at_rank(vs, q)


def test_fifo_and_delivery(spark):
    sends = spark.createDataFrame([("s", 1, 0), ("s", 2, 10), ("s", 3, 20), ("t", 1, 5)],
                                  "stream string, seq int, sent long").select(
        "stream", F.col("sent").cast("timestamp").alias("sent_ts"))
    acks = spark.createDataFrame([("s", 4), ("s", 13), ("u", 1)], "stream string, at long").select(
        "stream", F.col("at").cast("timestamp").alias("acked_ts"))
    m = {(r.stream, r.n): r for r in fifo_match(sends, acks, "stream").collect()}
    assert m[("s", 1)].latency_ms == 4000.0 and m[("s", 2)].latency_ms == 3000.0
    assert m[("s", 3)].acked_ts is None and m[("u", 1)].sent_ts is None
    rep = {r.stream: r for r in delivery_report(fifo_match(sends, acks, "stream"), "stream").collect()}
    assert (rep["s"].sent, rep["s"].acked, rep["s"].in_flight) == (3, 2, 1)
    # latencies 4000 and 3000: n=2, q=.5 → index round_half_even(0.5) = 0 → 3000
    assert rep["s"].p50_ms == 3000.0 and rep["s"].p95_ms == 4000.0 and rep["s"].max_ms == 4000.0
    assert rep["u"].sent == 0 and rep["u"].acked == 1 and rep["u"].p50_ms is None
    errors = spark.createDataFrame([("s",), ("s",), ("t",)], "stream string")
    rep = {r.stream: r for r in delivery_report(fifo_match(sends, acks, "stream"), "stream", errors).collect()}
    assert (rep["s"].errors, rep["t"].errors, rep["u"].errors) == (2, 1, 0)
    assert rep["s"].sent == 3                  # errors consume no send
    only = delivery_report(fifo_match(sends, acks, "stream"), "stream", spark.createDataFrame([("z",)], "stream string"))
    assert {r.stream: (r.sent, r.errors) for r in only.collect()}["z"] == (0, 1)


def test_fifo_keeps_null_streams(spark):
    sends = spark.createDataFrame([(None, 1), (None, 2), ("a", 1)], "s string, t long").select("s", F.timestamp_seconds("t").alias("sent_ts"))
    acks = spark.createDataFrame([(None, 4)], "s string, t long").select("s", F.timestamp_seconds("t").alias("acked_ts"))
    m = fifo_match(sends, acks, "s")
    assert sorted((r.s or "", r.n, r.latency_ms) for r in m.collect() if r.latency_ms) == [("", 1, 3000.0)] and m.count() == 3
    rep = {r.s: r for r in delivery_report(m, "s").collect()}
    assert (rep[None].sent, rep[None].acked, rep[None].p50_ms) == (2, 1, 3000.0)


def test_delivery_over_time_and_overall(spark):
    sends = spark.createDataFrame([("s", 1), ("s", 1), ("s", 2), ("s", 5)], "s string, t long").select("s", F.timestamp_seconds("t").alias("sent_ts"))
    acks = spark.createDataFrame([("s", 2), ("s", 4), ("x", 4)], "s string, t long").select("s", F.timestamp_seconds("t").alias("acked_ts"))
    errors = spark.createDataFrame([(4,), (9,)], "t long").select(F.timestamp_seconds("t").alias("failed_ts"))
    m = fifo_match(sends, acks, "s")
    got = [(r.second.second, r.sent, r.acked, r.in_flight, r.errors, r.p50_ms, r.max_ms) for r in delivery_per_second(m, errors).orderBy("second").collect()]
    assert got == [(1, 2, 0, 2, 0, None, None), (2, 1, 1, 2, 0, 1000.0, 1000.0), (4, 0, 2, 1, 1, 3000.0, 3000.0),
                   (5, 1, 0, 2, 0, None, None), (9, 0, 0, 2, 1, None, None)]
    one = delivery_overall(m, errors).first()
    assert (one.sent, one.acked, one.in_flight, one.errors, one.acked_per_s, one.p50_ms, one.p95_ms, one.max_ms) == (4, 3, 2, 2, 1.0, 1000.0, 3000.0, 3000.0)
    nothing = delivery_overall(m.limit(0), errors.limit(0)).first()
    assert (nothing.sent, nothing.errors, nothing.acked_per_s, nothing.p50_ms) == (0, 0, None, None)


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

samples = st.lists(st.tuples(st.sampled_from([0, 0, 0, 1, 2]), st.integers(-5, 5)), min_size=1, max_size=60)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(samples)
def test_quantiles_and_ranks_match_python_on_random_groups(spark, rows):
    """Group 0 is hot and values repeat."""
    df = spark.createDataFrame([(g, float(v), i) for i, (g, v) in enumerate(rows)], "g long, v double, i long")
    qs = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    groups = {}
    for g, v in rows:
        groups.setdefault(g, []).append(float(v))
    cont = {r.g: r for r in group_quantiles(df, ["g"], "v", qs, "cont").collect()}
    near = {r.g: r for r in group_quantiles(df, ["g"], "v", qs, "nearest").collect()}
    assert set(cont) == set(groups) == set(near)
    for g, vs in groups.items():
        for name, q in qs.items():
            assert abs(cont[g][name] - between_ranks(vs, q)) < 1e-9
            assert near[g][name] == at_rank(vs, q)
    ranked = group_row_number(df, ["g"], ["v", "i"], "rn").collect()
    want = {}
    for g, vs in groups.items():
        order = sorted((float(v), i) for i, (gg, v) in enumerate(rows) if gg == g)
        want.update({(g, i): n + 1 for n, (_, i) in enumerate(order)})
    assert {(r.g, r.i): r.rn for r in ranked} == want


def windows_over(df, by):
    """Rows of the largest task at each level of the descent: (level, rows of the fullest window)."""
    from tidemark.operators.ranking import _with_digits
    counts, digits = _with_digits(df.groupBy(*by, "v").agg(F.count(F.lit(1)).alias("_c")), by, "v")
    levels = [counts.select(*by, *digits[:k + 1]).distinct().groupBy(*by, *digits[:k]) for k in range(len(digits))]
    return [g.count().agg(F.max("count")).first()[0] for g in [*levels, counts.groupBy(*by, *digits)]]


HOT = {
    "doubles between 0 and 1": lambda i: F.rand(3),
    "doubles close together": lambda i: F.lit(1000.0) + F.rand(3) / 1000,
    "doubles of both signs and any size": lambda i: (F.rand(3) - 0.5) * F.pow(F.lit(10.0), (F.rand(4) - 0.5) * 400),
    "wide whole numbers": lambda i: F.xxhash64(i),
    "strings": lambda i: F.md5(i.cast("string")),
    "strings with one beginning": lambda i: F.concat(F.lit("https://example.org/a/path/that/all/of/them/share/"), F.md5(i.cast("string"))),
}


@pytest.mark.parametrize("kind", list(HOT))
def test_distinct_values_of_a_hot_group_spread(spark, kind, workdir, monkeypatch):
    """No window of the descent holds more than a small part of the hot group's values, and the numbers are right."""
    n = 20_000
    df = spark.range(n).select(F.when(F.col("id") % 20 != 0, F.lit("hot")).otherwise(F.concat(F.lit("g"), (F.col("id") % 100).cast("string"))).alias("g"),
                               HOT[kind](F.col("id")).alias("v"), "id")
    df.write.parquet(f"{workdir}/rows")     # rand() is drawn once
    df = spark.read.parquet(f"{workdir}/rows")
    # With digits of 11 bits in place of 22, as there are only 20,000 rows.
    with monkeypatch.context() as m:
        m.setattr("tidemark.functions.order.DIGIT_BITS", 11)
        m.setattr("tidemark.functions.order.STRING_BYTES", 1)
        assert max(windows_over(df, ["g"])) <= 2048
    rows = df.collect()
    hot = sorted(r.v for r in rows if r.g == "hot")
    got = {r.id: r.rn for r in group_row_number(df, ["g"], ["v"], "rn").where("g = 'hot'").collect()}
    value = {r.id: r.v for r in rows}
    assert [value[i] for i in sorted(got, key=got.get)] == hot and sorted(got.values()) == list(range(1, len(hot) + 1))
    q = group_quantiles(df, ["g"], "v", {"a": 0.5, "b": 0.95}, "nearest").where("g = 'hot'").first()
    assert (q.a, q.b) == (at_rank(hot, 0.5), at_rank(hot, 0.95))


def test_strings_that_begin_alike_in_some_groups_only(spark):
    data = [("a", "pre" * 500 + str(i)) for i in range(50)] + [("b", s) for s in ("", "é", "z", "日本語", "日本", "\x01", None)] + [(None, "only")]
    df = spark.createDataFrame(data, "g string, v string")
    got = {}
    for r in group_row_number(df, ["g"], ["v"], "rn").collect():
        got.setdefault(r.g, []).append((r.rn, r.v))
    for g in ("a", "b", None):
        mine = sorted((v for k, v in data if k == g), key=lambda v: (v is not None, (v or "").encode()))
        assert [v for _, v in sorted(got[g])] == mine
