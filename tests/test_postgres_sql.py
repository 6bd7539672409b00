"""SQL text of the Postgres writer, executed on DuckDB in-process (no server here)."""

import duckdb

import pytest

from tidemark.streaming.postgres import insert_sql, is_transient, newest_rows, upsert_sql, write_partition_rows


def test_upsert_text():
    sql = upsert_sql("public.asset_live_state", ["sensor_asset_id", "value", "status"], ["sensor_asset_id"])
    assert sql == ('INSERT INTO "public"."asset_live_state" ("sensor_asset_id", "value", "status") '
                   'VALUES (%s, %s, %s) ON CONFLICT ("sensor_asset_id") DO UPDATE SET '
                   '"value" = EXCLUDED."value", "status" = EXCLUDED."status"')
    assert upsert_sql("t", ["k"], ["k"]).endswith("DO NOTHING")
    assert insert_sql("t", ["a", "b"]) == 'INSERT INTO "t" ("a", "b") VALUES (%s, %s)'


class _Conn:
    """Minimal DB-API connection over DuckDB for the writer loop."""

    def __init__(self, con):
        self.con = con

    def cursor(self):
        con = self.con

        class Cur:
            def __enter__(self):
                return self

            def __exit__(self, *a):
                return False

            def executemany(self, sql, rows):
                con.executemany(sql, rows)
        return Cur()

    def commit(self):
        pass

    def rollback(self):
        pass

    def close(self):
        pass


def test_upsert_semantics_on_duckdb():
    con = duckdb.connect()
    con.execute('CREATE TABLE t (k INTEGER PRIMARY KEY, a TEXT, b DOUBLE, note TEXT DEFAULT \'kept\')')
    sql = upsert_sql("t", ["k", "a", "b"], ["k"], placeholder="?")
    n = write_partition_rows(iter([(1, "x", 1.0), (2, "y", 2.0), (3, "z", 3.0)]), lambda: _Conn(con), sql, batch_size=2)
    assert n == 3
    con.execute("UPDATE t SET note = 'custom' WHERE k = 1")
    write_partition_rows(iter([(1, "x2", None)]), lambda: _Conn(con), sql)
    assert con.execute("SELECT k, a, b, note FROM t ORDER BY k").fetchall() == [
        (1, "x2", None, "custom"), (2, "y", 2.0, "kept"), (3, "z", 3.0, "kept")]


def test_pages_flush_by_size_or_time():
    con = duckdb.connect()
    con.execute("CREATE TABLE t (k INTEGER PRIMARY KEY, a TEXT)")
    sql = upsert_sql("t", ["k", "a"], ["k"], placeholder="?")
    pages = []

    class Counting(_Conn):
        def cursor(self):
            inner = super().cursor()

            class Cur:
                def __enter__(self):
                    return self

                def __exit__(self, *a):
                    return False

                def executemany(self, q, rows):
                    pages.append(len(rows))
                    inner.executemany(q, rows)
            return Cur()

    ticks = iter(range(0, 10_000, 60))           # 60 ms between rows
    n = write_partition_rows(iter([(i, "x") for i in range(7)]), lambda: Counting(con), sql,
                             batch_size=1000, flush_interval_ms=100, clock=lambda: next(ticks) / 1000)
    assert n == 7 and sum(pages) == 7 and max(pages) <= 3      # time-based flushes
    pages.clear()
    n = write_partition_rows(iter([(i, "y") for i in range(7)]), lambda: Counting(con), sql,
                             batch_size=3, flush_interval_ms=1e9)
    assert pages == [3, 3, 1]                                   # size-based flushes
    assert con.execute("SELECT count(*), min(a) FROM t").fetchone() == (7, "y")


class OperationalError(Exception):
    """As the driver names a lost connection, which has no SQLSTATE."""

    sqlstate = None


def test_a_lost_connection_is_opened_anew():
    con = duckdb.connect()
    con.execute("CREATE TABLE t (k INTEGER PRIMARY KEY, a TEXT)")
    opened, failures = [], [OperationalError("server closed the connection"), OperationalError("again")]

    class Flaky(_Conn):
        def cursor(self):
            if self.dead:
                raise OperationalError("connection already closed")
            if failures:
                self.dead = True
                raise failures.pop()
            return super().cursor()

    def connect():
        c = Flaky(con)
        c.dead = False
        opened.append(c)
        return c

    sql = upsert_sql("t", ["k", "a"], ["k"], placeholder="?")
    n = write_partition_rows(iter([(1, "x"), (2, "y")]), connect, sql, backoff=0.0)
    assert n == 2 and len(opened) == 3 and con.execute("SELECT count(*) FROM t").fetchone() == (2,)


def test_errors_that_stay_are_raised_at_once():
    class Bad(Exception):
        sqlstate = "22P02"

    opened = []

    def connect():
        opened.append(1)
        raise Bad("invalid text")

    with pytest.raises(Bad):
        write_partition_rows(iter([(1,)]), connect, "x", backoff=0.0)
    assert len(opened) == 1
    assert not is_transient(KeyError("x")) and is_transient(ConnectionResetError())


def test_newest_row_per_key(spark):
    df = spark.createDataFrame([(1, 5, "old", 9), (1, 7, "new", 1), (2, 1, "x", 0), (2, None, "null", 99)], "k int, ts int, a string, b int")
    got = {r.k: (r.ts, r.a) for r in newest_rows(df, ["k"], ["ts"]).collect()}
    assert got == {1: (7, "new"), 2: (1, "x")}
    assert newest_rows(df, ["k"]).columns == df.columns
