"""Streaming sinks: keyed upsert (S12), insert-only (S13), Postgres upsert writer.

``upsert_stream`` is ``writeStream.foreachBatch`` + ``KeyedTable.merge``: each
micro-batch is merged as an ordinary batch job on the executors.  It accepts
output modes ``update`` and ``append`` (both upsert; ``append`` inserts keys
that do not exist yet and updates those that do) and rejects ``complete``.
Replays are idempotent: the merge records the last batch id per writer (the
query id that Spark keeps in the checkpoint), so the batch Spark re-runs after
a failure is skipped if it had already been committed, and a new checkpoint is
a new writer whose batches all count.
"""

from __future__ import annotations

import json
import time
import uuid
from collections import OrderedDict
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.session import rocksdb_state
from tidemark.sources.files import FileSystem
from tidemark.streaming.keyed import KEY_TYPES, KeyedTable

# Rows written per (query id, batch id), read by the progress log, since a
# foreachBatch sink reports numOutputRows = -1.  The oldest are forgotten.
SINK_ROWS: OrderedDict[tuple[str, int], int] = OrderedDict()
SINK_ROWS_KEPT = 10_000


def _note_rows(writer: str, batch_id: int, n: int) -> None:
    SINK_ROWS[(writer, int(batch_id))] = n
    while len(SINK_ROWS) > SINK_ROWS_KEPT:
        SINK_ROWS.popitem(last=False)


def query_id(spark, checkpoint: str) -> str:
    """The id of the query that a checkpoint belongs to."""
    return json.loads(FileSystem(spark, checkpoint).read_text(f"{checkpoint.rstrip('/')}/metadata"))["id"]


DEFAULT_TRIGGER = "1 second"


def parse_key(key: str | Sequence[str]) -> list[str]:
    """``"a, b"`` or ``["a", "b"]`` → ``["a", "b"]``; quoted names are unquoted."""
    parts = key.split(",") if isinstance(key, str) else list(key)
    out = [p.strip().strip('"').strip("`") for p in parts]
    if not out or any(not p for p in out):
        raise ValueError(f"upsert key must name one or more columns, got {key!r}")
    if len(set(out)) != len(out):
        raise ValueError(f"upsert key repeats a column: {key!r}")
    return out


def validate_key(schema: T.StructType, keys: Sequence[str], target_keys: Sequence[str] | None = None) -> None:
    """Upsert-key rules: columns of the frame, numeric or string, equal to the target's key."""
    names = schema.names
    missing = [k for k in keys if k not in names]
    if missing:
        raise ValueError(f"upsert key column(s) {missing} not in the DataFrame columns {names}")
    for k in keys:
        t = schema[k].dataType
        if not isinstance(t, KEY_TYPES):
            raise TypeError(f"upsert key column {k!r} must be numeric or string, not {t.simpleString()}")
    if target_keys is not None and sorted(target_keys) != sorted(keys):
        raise ValueError(f"upsert key {list(keys)} differs from the target's key {list(target_keys)}")


def resolve_target(spark, target: str) -> str:
    """A path, or a bare table name placed under the session's warehouse folder (``toTable`` style)."""
    if "/" in target or "://" in target:
        return target
    name = target.replace(".", "/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    return f"{warehouse}/{name}"


def validate_output_mode(mode: str) -> str:
    m = mode.lower()
    if m == "complete":
        raise ValueError("output mode 'complete' is not supported by an upsert sink; use 'update' or 'append'")
    if m not in ("update", "append"):
        raise ValueError(f"unknown output mode {mode!r}")
    return m


def trigger_args(trigger: str | Mapping | None) -> dict:
    """Map a trigger spec to ``DataStreamWriter.trigger`` keyword arguments.

    ``None`` → processing time every second; a string → processing time;
    ``"availableNow"`` / ``"once"`` → available-now (``once`` is its
    deprecated form); ``realTime`` is rejected: this Spark has no real-time mode.
    """
    if trigger is None:
        return {"processingTime": DEFAULT_TRIGGER}
    if isinstance(trigger, str):
        if trigger in ("availableNow", "once"):
            return {"availableNow": True}
        if trigger.lower() in ("realtime", "real_time"):
            raise ValueError("real-time trigger mode is not available in this Spark version; "
                             "use processingTime (for example '0 seconds') or availableNow")
        return {"processingTime": trigger}
    spec = dict(trigger)
    if "realTime" in spec:
        raise ValueError("real-time trigger mode is not available in this Spark version; "
                         "use processingTime (for example '0 seconds') or availableNow")
    if spec.pop("once", False):
        spec["availableNow"] = True
    if len(spec) != 1:
        raise ValueError(f"exactly one trigger expected, got {trigger!r}")
    return spec


#: Words in the errors of lost connections and stores that are briefly not there.
TRANSIENT = ("timed out", "timeout", "connection", "temporarily", "unavailable", "throttl", "slow down", "reset by peer")


def _merge_with_retry(table: KeyedTable, batch: DataFrame, writer: str, batch_id: int,
                      order_by, unique: bool, retries: int, backoff: float) -> int:
    """Retries what may pass: a merge commits at its end only, so running it again is safe.

    Errors in the plan or the data come back at once.  Commits of other
    writers are no errors (the commit takes the next number).
    """
    for attempt in range(retries + 1):
        try:
            return table.merge(batch, writer=writer, batch_id=batch_id, order_by=order_by, unique=unique)
        except (ValueError, TypeError, AnalysisException):
            raise
        except Exception as e:
            if attempt == retries or not (isinstance(e, OSError) or any(w in str(e).lower() for w in TRANSIENT)):
                raise
            time.sleep(backoff * (2 ** attempt))
    return 0


def upsert_batch_fn(target: str, keys: Sequence[str], writer: str | None = None,
                    order_by: Sequence[str] | str | None = None, unique: bool = False,
                    transform: Callable[[DataFrame], DataFrame] | None = None,
                    defaults: Mapping[str, str] | None = None, buckets: int | None = None,
                    retries: int = 2, backoff: float = 1.0, vacuum_every: int = 100,
                    retain_seconds: float = 3600.0, checkpoint: str | None = None,
                    stage_before_transform: bool = False) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function of an upsert stream (usable on its own for batch jobs).

    The writer is ``writer`` or the query id in ``checkpoint``.  Every
    ``vacuum_every`` batches, what only reads older than ``retain_seconds``
    could use is dropped, so a continuous job keeps bounded storage.
    ``stage_before_transform`` writes the raw micro-batch to the shared folder
    before ``transform`` runs, for transforms that run several actions (each
    action on a micro-batch would otherwise re-run a stateful upstream plan).
    """
    keys = list(keys)
    opened: dict[str, KeyedTable] = {}
    named = {"writer": writer}

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if named["writer"] is None:
            named["writer"] = query_id(spark, checkpoint)
        writer = named["writer"]
        known = opened.get("t") or (KeyedTable(spark, target) if KeyedTable.exists(spark, target) else None)
        if known is not None and known.last_batch(writer) >= batch_id:
            _note_rows(writer, batch_id, 0)      # a replay of a committed batch
            return
        raw_dir = None
        if transform and stage_before_transform:
            raw_dir = f"{target.rstrip('/')}/data/{int(time.time()):012d}-in-{uuid.uuid4().hex}"
            batch.write.mode("errorifexists").parquet(raw_dir)
            batch = spark.read.schema(batch.schema).parquet(raw_dir)
        try:
            _upsert(spark, transform(batch) if transform else batch, batch_id, writer)
        finally:
            if raw_dir:
                FileSystem(spark, raw_dir).delete(raw_dir)

    def _upsert(spark, b: DataFrame, batch_id: int, writer: str) -> None:
        table = opened.get("t")
        if table is None:
            if KeyedTable.exists(spark, target):
                table = KeyedTable(spark, target)
                validate_key(b.schema, keys, table.keys)
            else:
                validate_key(b.schema, keys)
                table = KeyedTable.create(spark, target, b.schema, keys, defaults, buckets)
            opened["t"] = table
        else:
            validate_key(b.schema, keys)
        n = _merge_with_retry(table, b, writer, batch_id, order_by, unique, retries, backoff)
        _note_rows(writer, batch_id, n)
        if vacuum_every and batch_id > 0 and batch_id % vacuum_every == 0:
            table.vacuum(retain_seconds)

    return run


def upsert_stream(df: DataFrame, target: str, key: str | Sequence[str], checkpoint: str,
                  output_mode: str = "update", trigger: str | Mapping | None = None,
                  query_name: str | None = None, order_by: Sequence[str] | str | None = None,
                  unique: bool = False, transform: Callable[[DataFrame], DataFrame] | None = None,
                  defaults: Mapping[str, str] | None = None, buckets: int | None = None,
                  retries: int = 2, stage_before_transform: bool = False) -> StreamingQuery:
    """Start a stream that upserts every micro-batch into the keyed table at ``target``
    (a path, or a table name placed under the warehouse folder).

    - ``key``: upsert key, a column name, comma-separated names or a list;
    - ``checkpoint``: required; the query id kept in it identifies the writer for replay checks;
    - ``order_by``: keep the newer of stored and incoming rows by these columns
      (default: incoming always wins, like ``ON CONFLICT DO UPDATE``);
    - ``unique``: the stream has at most one row per key per batch (true for the
      update output of a keyed aggregate), which skips a reduction;
    - ``transform``: applied to each micro-batch before the merge (for example an
      enrichment that re-reads a changing dimension).
    The target is created on first use from the batch's schema.
    """
    if not checkpoint:
        raise ValueError("checkpoint location is required")
    mode = validate_output_mode(output_mode)
    target = resolve_target(df.sparkSession, target)
    keys = parse_key(key)
    if transform is None:
        validate_key(df.schema, keys)
    if KeyedTable.exists(df.sparkSession, target) and transform is None:
        validate_key(df.schema, keys, KeyedTable(df.sparkSession, target).keys)
    fn = upsert_batch_fn(target, keys, None, order_by, unique, transform, defaults, buckets, retries,
                         checkpoint=checkpoint, stage_before_transform=stage_before_transform)
    w = (df.writeStream.outputMode(mode).foreachBatch(fn)
         .option("checkpointLocation", checkpoint).trigger(**trigger_args(trigger)))
    if query_name:
        w = w.queryName(query_name)
    return w.start()


def insert_stream(df: DataFrame, path: str, checkpoint: str, trigger: str | Mapping | None = None,
                  query_name: str | None = None, partition_by: Sequence[str] = ()) -> StreamingQuery:
    """Append every row to a Parquet table (Spark's file sink: exactly-once per batch).

    State, if the plan has any, is kept in RocksDB, as ``match_stream`` and ``delivery_stream`` need.
    """
    if not checkpoint:
        raise ValueError("checkpoint location is required")
    w = (df.writeStream.format("parquet").outputMode("append")
         .option("path", path).option("checkpointLocation", checkpoint)
         .trigger(**trigger_args(trigger)))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if query_name:
        w = w.queryName(query_name)
    with rocksdb_state(df.sparkSession):
        return w.start()


def await_completion(q: StreamingQuery, timeout_sec: float = 600) -> None:
    """Wait for an available-now query to finish; raise its error or a timeout."""
    done = q.awaitTermination(timeout_sec)
    if not done:
        q.stop()
        raise TimeoutError(f"stream {q.name or q.id} did not finish within {timeout_sec}s")
    err = q.exception()
    if err is not None:
        raise RuntimeError(f"stream {q.name or q.id} failed: {err}")
