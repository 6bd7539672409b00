"""Upsert of a DataFrame into a Postgres table (the row-store target of the articles).

Each partition is sorted by the upsert key (so concurrent transactions take
row locks in one order and do not deadlock), sent in pages of ``batch_size``
rows through ``executemany`` and committed per page; transient failures
(lost connection, deadlock, throttling) are retried with back-off.  The
driver module ``psycopg`` is imported only on the executors and only when the
writer runs.  Untested against a server here: no Postgres server or driver is
available in this environment; the SQL text is tested.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def quote_ident(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def upsert_sql(table: str, columns: Sequence[str], keys: Sequence[str], placeholder: str = "%s") -> str:
    """``INSERT ... ON CONFLICT (keys) DO UPDATE SET`` non-key columns (or DO NOTHING)."""
    tbl = ".".join(quote_ident(p) for p in table.split("."))
    cols = ", ".join(quote_ident(c) for c in columns)
    vals = ", ".join(placeholder for _ in columns)
    conflict = ", ".join(quote_ident(k) for k in keys)
    sets = [f"{quote_ident(c)} = EXCLUDED.{quote_ident(c)}" for c in columns if c not in keys]
    action = "DO UPDATE SET " + ", ".join(sets) if sets else "DO NOTHING"
    return f"INSERT INTO {tbl} ({cols}) VALUES ({vals}) ON CONFLICT ({conflict}) {action}"


def insert_sql(table: str, columns: Sequence[str], placeholder: str = "%s") -> str:
    tbl = ".".join(quote_ident(p) for p in table.split("."))
    return (f"INSERT INTO {tbl} ({', '.join(quote_ident(c) for c in columns)}) "
            f"VALUES ({', '.join(placeholder for _ in columns)})")


#: Worth another try: serialization failure, deadlock, too many connections, shutdown, lost connections.
TRANSIENT_SQLSTATES = {"40001", "40P01", "53300", "57P01", "57P02", "57P03", "08000", "08001", "08003", "08004", "08006"}


def is_transient(e: Exception) -> bool:
    """By SQLSTATE; a lost connection has none and counts by its class."""
    code = getattr(e, "sqlstate", None) or getattr(getattr(e, "diag", None), "sqlstate", None)
    if code is not None:
        return code in TRANSIENT_SQLSTATES
    return isinstance(e, (ConnectionError, TimeoutError)) or type(e).__name__ in ("OperationalError", "InterfaceError")


class PageWriter:
    """Sends pages of tuples over one connection, which is opened anew when it was lost."""

    def __init__(self, connect: Callable, sql: str, retries: int = 3, backoff: float = 0.5, sleep: Callable[[float], None] = time.sleep):
        self.connect, self.sql, self.retries, self.backoff, self.sleep = connect, sql, retries, backoff, sleep
        self.conn = None

    def send(self, page: list[tuple]) -> None:
        """One transaction; transient failures are tried again on a new connection."""
        for attempt in range(self.retries + 1):
            try:
                if self.conn is None:
                    self.conn = self.connect()
                with self.conn.cursor() as cur:
                    cur.executemany(self.sql, page)
                self.conn.commit()
                return
            except Exception as e:
                self.close()   # its transaction is rolled back with it
                if attempt == self.retries or not is_transient(e):
                    raise
                self.sleep(self.backoff * 2 ** attempt)

    def close(self) -> None:
        conn, self.conn = self.conn, None
        try:
            if conn is not None:
                conn.close()
        except Exception:
            pass   # a lost connection cannot be closed


def pages(rows: Iterable, batch_size: int, interval_ms: float, clock: Callable[[], float] = time.monotonic) -> Iterator[list[tuple]]:
    """Rows in pages: full at ``batch_size`` rows, or when the first has waited ``interval_ms``.

    The rows of a partition are at hand, so the time only passes while rows
    are computed; it is looked at with every row.
    """
    page, since = [], 0.0
    for r in rows:
        if not page:
            since = clock()
        page.append(tuple(r))
        if len(page) >= batch_size or (clock() - since) * 1000.0 >= interval_ms:
            yield page
            page = []
    if page:
        yield page


def write_partition_rows(rows: Iterable, connect: Callable, sql: str, batch_size: int = 1000, retries: int = 3,
                         backoff: float = 0.5, flush_interval_ms: float = 100.0,
                         clock: Callable[[], float] = time.monotonic) -> int:
    """Write an iterator of tuples in pages; returns the number of rows written."""
    writer, written = PageWriter(connect, sql, retries, backoff), 0
    try:
        for page in pages(rows, batch_size, flush_interval_ms, clock):
            writer.send(page)
            written += len(page)
    finally:
        writer.close()
    return written


def newest_rows(batch: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """One row per key: the newest by ``order_by`` (without: any, the same on a replay)."""
    payload = [c for c in batch.columns if c not in keys]
    if not payload:
        return batch.distinct()
    row = F.struct(*payload)
    pick = F.max_by(row, F.struct(*order_by, row)) if order_by else F.max(row)
    return batch.groupBy(*keys).agg(pick.alias("_r")).select(*keys, "_r.*").select(*batch.columns)


def write_postgres(df: DataFrame, conninfo: str, table: str, keys: Sequence[str] | None = None,
                   batch_size: int = 1000, retries: int = 3, flush_interval_ms: float = 100.0) -> int:
    """Upsert (``keys`` given) or insert ``df`` into ``table``, key-sorted within partitions; returns the rows written."""
    columns = df.columns
    sql = upsert_sql(table, columns, keys) if keys else insert_sql(table, columns)
    out = df.repartition(*keys).sortWithinPartitions(*keys) if keys else df

    def run(batches):
        import psycopg  # imported on the executor, only when used
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        n = write_partition_rows(rows, lambda: psycopg.connect(conninfo), sql, batch_size, retries, flush_interval_ms=flush_interval_ms)
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    return out.mapInArrow(run, "n long").agg(F.sum("n")).first()[0] or 0


def postgres_upsert_stream(df: DataFrame, conninfo: str, table: str, key: str | Sequence[str] | None,
                           checkpoint: str, output_mode: str = "update", trigger=None,
                           query_name: str | None = None, batch_size: int = 1000, retries: int = 3,
                           flush_interval_ms: float = 100.0, order_by: Sequence[str] | str | None = None) -> StreamingQuery:
    """Stream into a Postgres table by endpoint/database/table coordinates (``conninfo``).

    With ``key`` each micro-batch is reduced to one row per key, the newest by
    ``order_by`` (a row store refuses two updates of one key in one statement
    batch), and upserted; a replayed batch re-sends the same upserts, which is
    harmless for ``ON CONFLICT DO UPDATE``.  Without ``key`` rows are only
    inserted, and a replayed batch inserts them again.
    """
    from tidemark.streaming.sink import parse_key, trigger_args, validate_key, validate_output_mode

    keys = parse_key(key) if key else None
    order = [order_by] if isinstance(order_by, str) else list(order_by or [])
    if keys:
        validate_key(df.schema, keys)
    mode = validate_output_mode(output_mode)

    def run(batch: DataFrame, batch_id: int) -> None:
        write_postgres(newest_rows(batch, keys, order) if keys else batch, conninfo, table, keys, batch_size, retries, flush_interval_ms)

    w = (df.writeStream.outputMode(mode).foreachBatch(run)
         .option("checkpointLocation", checkpoint).trigger(**trigger_args(trigger)))
    if query_name:
        w = w.queryName(query_name)
    return w.start()
