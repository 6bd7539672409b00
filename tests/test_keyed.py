"""Merge rules of the keyed table, replay safety and lookups."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

import tidemark.streaming.keyed as keyed
from tidemark.streaming.keyed import KeyedTable

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("name", T.StringType()),
                       T.StructField("v", T.DoubleType()), T.StructField("ts", T.LongType()),
                       T.StructField("created", T.StringType())])


def rows(t):
    return {r.k: r.asDict() for r in t.read().collect()}


def table(spark, workdir, **kw):
    return KeyedTable.create(spark, f"{workdir}/t", SCHEMA, "k", defaults={"created": "'default'"}, buckets=4, **kw)


def test_insert_default_partial_update_and_null_overwrite(spark, workdir):
    t = table(spark, workdir)
    assert t.merge(spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k long, name string, v double")) == 2
    s = rows(t)
    assert s[1] == {"k": 1, "name": "a", "v": 1.0, "ts": None, "created": "default"}
    # partial update: only v supplied; name and created keep their values; a supplied null overwrites
    t.merge(spark.createDataFrame([(1, None), (3, 3.0)], "k long, v double"))
    s = rows(t)
    assert s[1]["name"] == "a" and s[1]["v"] is None and s[1]["created"] == "default"
    assert s[3] == {"k": 3, "name": None, "v": 3.0, "ts": None, "created": "default"}
    assert len(s) == 3


def test_null_key_fails_and_empty_batch(spark, workdir):
    t = table(spark, workdir)
    with pytest.raises(ValueError, match="null key"):
        t.merge(spark.createDataFrame([(None, 1.0)], "k long, v double"))
    assert t.merge(spark.createDataFrame([], "k long, v double"), writer="w", batch_id=0) == 0
    assert t.read().count() == 0 and t.last_batch("w") == 0


def test_unknown_column_and_missing_key(spark, workdir):
    t = table(spark, workdir)
    with pytest.raises(ValueError, match="not in the table"):
        t.merge(spark.createDataFrame([(1, 1.0)], "k long, other double"))
    with pytest.raises(ValueError, match="key"):
        t.merge(spark.createDataFrame([(1.0,)], "v double"))


def test_replay_same_batch_is_noop(spark, workdir):
    t = table(spark, workdir)
    b = spark.createDataFrame([(1, 1.0)], "k long, v double")
    assert t.merge(b, writer="q", batch_id=5) == 1
    before = t.version
    assert t.merge(spark.createDataFrame([(1, 9.0)], "k long, v double"), writer="q", batch_id=5) == 0
    assert t.version == before and rows(t)[1]["v"] == 1.0


def test_order_by_keeps_newer(spark, workdir):
    t = table(spark, workdir)
    t.merge(spark.createDataFrame([(1, 5.0, 10)], "k long, v double, ts long"), order_by="ts")
    t.merge(spark.createDataFrame([(1, 4.0, 9), (2, 1.0, 1), (2, 2.0, 2)], "k long, v double, ts long"), order_by="ts")
    s = rows(t)
    assert s[1]["v"] == 5.0 and s[1]["ts"] == 10   # older incoming row loses
    assert s[2]["v"] == 2.0                          # newest within the batch wins
    # without order_by the incoming row always wins (unconditional overwrite)
    t.merge(spark.createDataFrame([(1, 4.0, 9)], "k long, v double, ts long"))
    assert rows(t)[1]["ts"] == 9


def written_rows(t, since):
    return sum(e.get("rows") or 0 for e in map(t._entry, t._numbers()) if e["seq"] > since and e.get("path"))


def test_a_batch_costs_what_it_holds(spark, workdir, monkeypatch):
    t = table(spark, workdir)
    t.overwrite(spark.range(20000).select(F.col("id").alias("k"), F.lit(1.0).alias("v")), unique=True)
    before = t.version
    t.merge(spark.createDataFrame([(k, 2.0) for k in range(0, 20000, 1000)], "k long, v double"))
    assert written_rows(t, before) == 20          # 0.1 % of the keys, 0.1 % of the rows
    assert t.read().count() == 20000 and t.lookup(7000).first().v == 2.0 and t.lookup(7).first().v == 1.0
    plan = t.lookup(7)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(_bucket" in plan or "_bucket#" in plan.split("PartitionFilters:")[1][:80]
    # batches add up to half of the base: a new base folds them
    t.merge(spark.range(0, 20000, 2).select(F.col("id").alias("k"), F.lit(3.0).alias("v")))
    assert t.state()["root"]["kind"] == "base" and not t.state()["deltas"]
    assert {r.v: r["count"] for r in t.read().groupBy("v").count().collect()} == {3.0: 10000, 1.0: 10000}


def test_base_has_one_file_per_bucket(spark, workdir):
    t = KeyedTable.create(spark, f"{workdir}/even", SCHEMA, "k", buckets=16)
    t.overwrite(spark.range(5000).select(F.col("id").alias("k"), F.lit(1.0).alias("v")), unique=True)
    base = t.state()["root"]["path"]
    folders = [n for n in t.fs.list_names(base) if n.startswith("_bucket=")]
    assert len(folders) == 16
    for f in folders:
        assert len([n for n in t.fs.list_names(f"{base}/{f}") if n.endswith(".parquet")]) == 1


def test_concurrent_writers_all_land(spark, workdir):
    from concurrent.futures import ThreadPoolExecutor
    table(spark, workdir)

    def write(w):
        t = KeyedTable(spark, f"{workdir}/t")
        for b in range(3):
            t.merge(spark.createDataFrame([(100 * w + b, float(w)), (1, float(w))], "k long, v double"), writer=f"w{w}", batch_id=b)

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(write, range(1, 5)))
    t = KeyedTable(spark, f"{workdir}/t")
    assert set(rows(t)) == {1} | {100 * w + b for w in range(1, 5) for b in range(3)}
    assert all(t.last_batch(f"w{w}") == 2 for w in range(1, 5))
    assert not t.fs.create_new(f"{workdir}/t/_log/{0:020d}.json", "{}")     # never overwritten


def test_versions_and_changes(spark, workdir):
    t = table(spark, workdir)
    t.overwrite(spark.createDataFrame([(k, float(k)) for k in range(100)], "k long, v double"), unique=True)
    v1 = t.version
    t.merge(spark.createDataFrame([(1, 10.0), (200, 1.0), (2, 2.0)], "k long, v double"))
    v2 = t.version
    t.merge(spark.createDataFrame([(1, 11.0)], "k long, v double"))
    assert t.read(v1).count() == 100 and t.read(v2).where("k = 1").first().v == 10.0 and rows(t)[1]["v"] == 11.0
    got = {r.k: (r.change_type, r.old_v, r.new_v) for r in t.changes(v1, v2, ["v"]).collect()}
    assert got == {1: ("update", 1.0, 10.0), 200: ("insert", None, 1.0)}       # 2 got the same value
    t.overwrite(spark.createDataFrame([(1, 11.0)], "k long, v double"))
    got = {r.k: r.change_type for r in t.changes(v2, None, ["v"]).collect()}
    assert got[1] == "update" and got[200] == "delete" and len(got) == 101


def test_mixed_orders_and_columns(spark, workdir):
    """A batch with another order or, if ordered, other columns, folds what was there first."""
    t = table(spark, workdir)
    t.merge(spark.createDataFrame([(1, 1.0, 10, "a")], "k long, v double, ts long, name string"), order_by="ts")
    t.merge(spark.createDataFrame([(1, 12, "b")], "k long, ts long, name string"), order_by="ts")
    t.merge(spark.createDataFrame([(1, 9.0, 11)], "k long, v double, ts long"), order_by="ts")
    assert rows(t)[1] == {"k": 1, "v": 1.0, "ts": 12, "name": "b", "created": "default"}
    t.merge(spark.createDataFrame([(1, 5.0, 2)], "k long, v double, ts long"))
    assert rows(t)[1]["v"] == 5.0 and rows(t)[1]["ts"] == 2
    t.merge(spark.createDataFrame([(1, 6.0, 3), (2, 6.0, None)], "k long, v double, ts long"), order_by="ts")
    assert rows(t)[1]["v"] == 6.0 and rows(t)[2]["v"] == 6.0


def test_defaults_are_fixed_when_written(spark, workdir):
    t = KeyedTable.create(spark, f"{workdir}/d", SCHEMA, "k", defaults={"created": "cast(uuid() as string)"}, buckets=2)
    t.merge(spark.createDataFrame([(1, 1.0)], "k long, v double"))
    first = rows(t)[1]["created"]
    t.merge(spark.createDataFrame([(1, 2.0)], "k long, v double"))
    assert rows(t)[1]["created"] == first == rows(t)[1]["created"] and rows(t)[1]["v"] == 2.0
    t.compact()
    assert rows(t)[1]["created"] == first
    t.merge(spark.createDataFrame([(1, None)], "k long, created string"))
    assert rows(t)[1]["created"] is None


def test_crash_before_commit_leaves_state_and_replay_recovers(spark, workdir, monkeypatch):
    t = table(spark, workdir)
    t.merge(spark.createDataFrame([(1, 1.0)], "k long, v double"), writer="q", batch_id=0)
    real = KeyedTable._commit
    calls = {"n": 0}

    def failing(self, entry):
        calls["n"] += 1
        raise OSError("simulated crash before the entry is written")

    monkeypatch.setattr(KeyedTable, "_commit", failing)
    with pytest.raises(OSError):
        t.merge(spark.createDataFrame([(1, 2.0), (2, 2.0)], "k long, v double"), writer="q", batch_id=1)
    monkeypatch.setattr(KeyedTable, "_commit", real)
    assert rows(t) == {1: {"k": 1, "name": None, "v": 1.0, "ts": None, "created": "default"}}
    assert t.merge(spark.createDataFrame([(1, 2.0), (2, 2.0)], "k long, v double"), writer="q", batch_id=1) == 2
    assert {k: r["v"] for k, r in rows(t).items()} == {1: 2.0, 2: 2.0}


def test_overwrite_and_vacuum(spark, workdir):
    t = table(spark, workdir)
    t.merge(spark.createDataFrame([(1, 1.0), (2, 2.0)], "k long, v double"))
    t.overwrite(spark.createDataFrame([(3, 3.0)], "k long, v double"))
    assert set(rows(t)) == {3}
    t.vacuum(retain_seconds=-10)
    assert set(rows(t)) == {3} and t.version == 2
    assert len(t.fs.list_names(f"{t.path}/data")) == 1 and len(t._numbers()) == 1
    t.merge(spark.createDataFrame([(4, 4.0)], "k long, v double"))
    t.vacuum(retain_seconds=3600)
    assert set(rows(t)) == {3, 4}


def test_key_types_and_order(spark, workdir):
    """Numbers of every kind and strings are keys; the order in which key columns are named does not matter."""
    from decimal import Decimal
    t = KeyedTable.create(spark, f"{workdir}/num", T.StructType.fromDDL("d decimal(10,2), f double, v int"), ["d", "f"], buckets=4)
    t.merge(spark.createDataFrame([(Decimal("1.50"), 0.0, 1), (Decimal("2.00"), 1.5, 2)], "d decimal(10,2), f double, v int"))
    KeyedTable.create(spark, f"{workdir}/num", t.schema, ["f", "d"])
    t.merge(spark.createDataFrame([(Decimal("1.50"), -0.0, 3)], "d decimal(10,2), f double, v int"))
    t.compact()
    assert sorted((float(r.d), r.f, r.v) for r in t.read().collect()) == [(1.5, 0.0, 3), (2.0, 1.5, 2)]
    assert t.lookup(Decimal("2.00"), 1.5).first().v == 2 and t.lookup(1.5, 0.0).first().v == 3
    with pytest.raises(ValueError, match="keyed by"):
        KeyedTable.create(spark, f"{workdir}/num", t.schema, ["d"])
    with pytest.raises(TypeError):
        KeyedTable.create(spark, f"{workdir}/bad", T.StructType([T.StructField("b", T.BooleanType())]), "b")
    with pytest.raises(ValueError):
        KeyedTable.create(spark, f"{workdir}/bad2", SCHEMA, "nope")


batches = st.lists(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 50)), max_size=8), min_size=1, max_size=4)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batches)
def test_properties_idempotent_and_boundary_free(spark, workdir, bs):
    """upsert(upsert(s, b), b) = upsert(s, b); with order_by the result ignores batch boundaries."""
    import uuid
    base = f"{workdir}/{uuid.uuid4().hex}"
    split = KeyedTable.create(spark, f"{base}/a", SCHEMA, "k", buckets=4)
    for b in bs:
        df = spark.createDataFrame([(k, float(ts), ts) for k, ts in b], "k long, v double, ts long")
        split.merge(df, order_by="ts")
        state = rows(split)
        split.merge(df, order_by="ts")
        assert rows(split) == state
    whole = KeyedTable.create(spark, f"{base}/b", SCHEMA, "k", buckets=4)
    flat = [(k, float(ts), ts) for b in bs for k, ts in b]
    whole.merge(spark.createDataFrame(flat, "k long, v double, ts long"), order_by="ts")
    newest = {}
    for k, _, ts in flat:
        newest[k] = max(newest.get(k, -1), ts)
    assert {k: r["ts"] for k, r in rows(split).items()} == newest
    assert {k: r["ts"] for k, r in rows(whole).items()} == newest


def test_order_by_must_be_supplied_and_overwrite_reduces(spark, workdir):
    t = table(spark, workdir)
    with pytest.raises(ValueError, match="order_by"):
        t.merge(spark.createDataFrame([(1, 1.0)], "k long, v double"), order_by="ts")
    n = t.overwrite(spark.createDataFrame([(1, 1.0), (1, 2.0), (2, 3.0)], "k long, v double"))
    assert n == 2 and t.read().count() == 2 and rows(t)[1]["v"] in (1.0, 2.0)


def test_periodic_vacuum_bounds_storage(spark, workdir, monkeypatch):
    from tidemark.streaming.sink import upsert_batch_fn
    monkeypatch.setattr(keyed, "COMPACT_BATCHES", 3)
    target = f"{workdir}/v"
    fn = upsert_batch_fn(target, ["k"], writer="w", vacuum_every=3, retain_seconds=-10)
    for i in range(10):
        fn(spark.createDataFrame([(i % 3, float(i))], "k long, v double"), i)
    t = KeyedTable(spark, target)
    assert len(t._numbers()) <= 8
    assert len(t.fs.list_names(f"{target}/data")) <= 8
    assert {k: r["v"] for k, r in {r.k: r.asDict() for r in t.read().collect()}.items()} == {0: 9.0, 1: 7.0, 2: 8.0}
