"""J3 and A13 on streams: the n-th acknowledgement of a stream key belongs to its n-th send; latency per second.

The batch form (``operators.latency.fifo_match``) numbers both sides by time.
Here rows may arrive in any order within the watermark delay, on either side
first, so a row waits in the state of its key until the watermark has passed
its time.  A timer then puts the waiting rows, in order of time, at the end of
the key's queue of sends or of acks, and as many pairs as both queues hold
leave with their numbers.  What is left in a queue is in flight.

The unit of work and of state is a bucket of stream keys, by their hash: a
call for each key, with some round trips to the state store in each, made the
time grow with the keys.  State per bucket, in the state store (RocksDB): a
list of waiting rows, packed by batch and side, and one packed table with the
queue and the number of pairs so far of each key.  It holds what arrived within
the delay, what is in flight and a number per key, so it doesn't grow with the
length of the run.  A batch reads and writes the buckets that it has rows for,
so the number of buckets goes with the number of keys (some thousand keys in
each); like the number of state partitions it is fixed when the checkpoint is
created.  FIFO order within one stream key is sequential, and a batch of a hot
key is bounded by the source's rate limits.

Matched pairs equal those of the batch form over all rows that are older than
the watermark.  Rows that arrive later than the delay are dropped, as by every
event-time operator.  Rows without a time are left out; the key may be null.

``delivery_stream`` chains two windowed aggregations behind the matcher: counts
per second and latency, then one row per second with exact percentiles.  The
event time of a pair is the later of its two times, which is never older than
the watermark of the batch before.  A second leaves once, when the watermark has
passed its end, and its state goes with it.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidemark.functions import ms_between
from tidemark.operators.latency import PERCENTILES

# The processor runs on executors, which need no copy of this library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Buckets that the stream keys are dealt to.
BUCKETS = 512
_PAIRS = "n long, sent_us long, acked_us long, matched_ts timestamp"
_NESTED = ("array", "map", "struct")


class FifoMatcher(StatefulProcessor):
    """Pairs of the stream keys of one bucket: of each key in the order of their times."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "acked boolean, rows binary")
        self.open = handle.getValueState("open", "keys binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pa.concat_tables([_rows(part["key"], part["acked"], part["us"], part["tie"]) for part in rows] or [_rows([], [], [], [])])
        if len(new):
            self.waiting.appendList(_by_side(new))
            at = self._after(pc.min(new["us"]).as_py())
            if not any(t <= at for t in self.handle.listTimers()):     # an earlier timer sets the next itself
                self.handle.registerTimer(at)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        rows = pa.concat_tables([_unpacked(r[1]) for r in self.waiting.get()] or [_rows([], [], [], [])])
        due = pc.less(rows["us"], passed)
        later, due = rows.filter(pc.invert(due)), rows.filter(due)
        if not len(due):
            return
        if len(later):
            self.waiting.put(_by_side(later))
            self.handle.registerTimer(self._after(pc.min(later["us"]).as_py()))     # the timer that has run is still listed
        else:
            self.waiting.clear()
        before = _unpacked(self.open.get()[0]) if self.open.exists() else _open([], [], [], [], [])
        after, pairs = matched(before, due)
        self.open.update((_packed(after),))
        if len(pairs):
            yield pairs

    @staticmethod
    def _after(us: int) -> int:
        """The first millisecond after the row."""
        return us // 1000 + 1

    def close(self) -> None:
        pass


def _rows(key, acked, us, tie) -> pa.Table:
    return pa.table([pa.array(key, pa.string()), pa.array(acked, pa.bool_()), pa.array(us, pa.int64()), pa.array(tie, pa.string())],
                    ["key", "acked", "us", "tie"])


def _open(key, n, acked, stop, us) -> pa.Table:
    """Per stream key its number of pairs, and the side and times of what is in its queue."""
    left = pa.LargeListArray.from_arrays(pa.array([0, *stop], pa.int64()), pa.array(us, pa.int64()))
    return pa.table([pa.array(key, pa.string()), pa.array(n, pa.int64()), pa.array(acked, pa.bool_()), left], ["key", "n", "acked", "left"])


def _packed(table: pa.Table) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, table.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as w:
        w.write_table(table)
    return out.getvalue().to_pybytes()


def _unpacked(raw: bytes) -> pa.Table:
    return pa.ipc.open_stream(bytes(raw)).read_all()


def _by_side(rows: pa.Table) -> list[tuple[bool, bytes]]:
    sides = ((side, rows.filter(pc.equal(rows["acked"], side))) for side in (False, True))
    return [(side, _packed(part)) for side, part in sides if len(part)]


def matched(before: pa.Table, due: pa.Table) -> tuple[pa.Table, pd.DataFrame]:
    """The open keys (see :func:`_open`) after the due rows, and the pairs that these make, by key in order of time.

    At most one side of a key is in its queue, and its rows are before the due ones.
    """
    due = due.take(pc.sort_indices(due, [("key", "ascending"), ("us", "ascending"), ("tie", "ascending")]))
    codes = due["key"].combine_chunks().dictionary_encode()
    names, code = codes.dictionary, codes.indices.to_numpy()
    us, acked = due["us"].to_numpy(), due["acked"].to_numpy(zero_copy_only=False)
    # Open keys that have due rows; the others stay as they are.
    at = pc.index_in(before["key"], names).combine_chunks()
    now = before.filter(at.is_valid())
    at = at.drop_null().to_numpy()
    n, side = np.zeros(len(names), np.int64), now["acked"].to_numpy(zero_copy_only=False)
    n[at] = now["n"].to_numpy()
    size = pc.list_value_length(now["left"]).to_numpy()
    old_code, old_side, old_us = np.repeat(at, size), np.repeat(side, size), pc.list_flatten(now["left"]).to_numpy()
    queues = []
    for s in (False, True):
        c = np.concatenate((old_code[old_side == s], code[acked == s]))
        order = np.argsort(c, kind="stable")
        c, t = c[order], np.concatenate((old_us[old_side == s], us[acked == s]))[order]
        count = np.bincount(c, minlength=len(names))
        queues.append((c, t, np.arange(len(c)) - (np.cumsum(count) - count)[c], count))
    k = np.minimum(queues[0][3], queues[1][3])
    (c, sent, place, _), (_, ack, ack_place, _) = queues
    pairs = place < k[c]
    c, place, sent, ack = c[pairs], place[pairs], sent[pairs], ack[ack_place < k[queues[1][0]]]
    out = pd.DataFrame({"key": names.take(pa.array(c)).to_pandas(), "n": n[c] + place + 1, "sent_us": sent, "acked_us": ack,
                        "matched_ts": pd.to_datetime(np.maximum(sent, ack), unit="us", utc=True)})
    rest = queues[1][3] > k        # the side of what is left
    times, stop = [], np.cumsum(np.maximum(queues[0][3], queues[1][3]) - k)
    for c, t, place, _ in queues:
        times.append((c[place >= k[c]], t[place >= k[c]]))
    order = np.argsort(np.concatenate([c for c, _ in times]), kind="stable")
    changed = _open(names, n + k, rest, stop, np.concatenate([t for _, t in times])[order])
    return pa.concat_tables([before.filter(pc.invert(pc.is_in(before["key"], names))), changed]), out


def _as_text(both: DataFrame, c: str) -> Column:
    """A key column as a string of which :func:`_from_text` makes the same value; equal values have equal strings."""
    kind = both.schema[c].dataType.typeName()
    if kind in ("float", "double"):
        return F.when(F.col(c) == 0, F.lit("0.0")).otherwise(F.col(c).cast("string"))      # -0.0 is 0.0
    if kind == "timestamp":
        return F.unix_micros(c).cast("string")
    if kind == "binary":
        return F.hex(c)
    return F.to_json(F.array(c)) if kind in _NESTED else F.col(c).cast("string")


def _from_text(text: Column, kind: T.DataType) -> Column:
    if kind.typeName() == "timestamp":
        return F.timestamp_micros(text.cast("long"))
    if kind.typeName() == "binary":
        return F.unhex(text)
    return F.from_json(text, T.ArrayType(kind))[0] if kind.typeName() in _NESTED else text.cast(kind)


def _pairs(sends: DataFrame, acks: DataFrame, stream: Sequence[str] | str, sent_ts: str, acked_ts: str,
           order_tiebreak: Sequence[str], delay: str, buckets: int) -> DataFrame:
    """Stream keys and ``_PAIRS``; ``matched_ts``, the later time of the pair, is the event time."""
    by = [stream] if isinstance(stream, str) else list(stream)

    def side(df: DataFrame, ts: str, acked: bool) -> DataFrame:
        def part(c: str):
            if df.schema[c].dataType.typeName() == "string":
                return F.coalesce(F.col(c), F.lit(""))
            # Digits of one length sort like the numbers.
            return F.lpad((F.coalesce(F.col(c), F.lit(0)).cast("decimal(38,0)") + F.lit(10**18)).cast("string"), 20, "0")
        tie = F.concat_ws("\x01", *map(part, order_tiebreak)) if order_tiebreak else F.lit("")
        rows = df.select(*by, F.col(ts).cast("timestamp").alias("ts"), tie.alias("tie")).where("ts is not null").withWatermark("ts", delay)
        return rows.select(*by, "ts", F.lit(acked).alias("acked"), F.unix_micros("ts").alias("us"), "tie")

    both = side(sends, sent_ts, False).unionByName(side(acks, acked_ts, True))
    # One string for the key: pandas has no whole numbers beside nulls.
    both = both.select(F.to_json(F.array(*[_as_text(both, c) for c in by])).alias("key"), "ts", "acked", "us", "tie")
    dealt = both.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int"))
    pairs = dealt.groupBy("bucket").transformWithStateInPandas(FifoMatcher(), f"key string, {_PAIRS}", "append", "EventTime", eventTimeColumnName="matched_ts")
    texts = F.from_json("key", "array<string>")
    return pairs.select(*[_from_text(texts[i], sends.schema[c].dataType).alias(c) for i, c in enumerate(by)], "n", "sent_us", "acked_us", "matched_ts")


def match_stream(sends: DataFrame, acks: DataFrame, stream: Sequence[str] | str, sent_ts: str = "sent_ts", acked_ts: str = "acked_ts",
                 order_tiebreak: Sequence[str] = (), delay: str = "10 seconds", buckets: int = BUCKETS) -> DataFrame:
    """A stream of pairs: stream keys, ``n``, ``sent_ts``, ``acked_ts``, ``latency_ms`` (append mode).

    ``sends`` and ``acks`` are streams; rows of one time are ordered by the
    tie-break columns, which must be whole numbers of at most 18 digits or
    strings.  The watermark is the lower one of both sides.
    """
    by = [stream] if isinstance(stream, str) else list(stream)
    pairs = _pairs(sends, acks, by, sent_ts, acked_ts, order_tiebreak, delay, buckets)
    out = pairs.select(*by, "n", F.timestamp_micros("sent_us").alias(sent_ts), F.timestamp_micros("acked_us").alias(acked_ts))
    return out.withColumn("latency_ms", ms_between(acked_ts, sent_ts))


def _at_rank(values: str, total: str, q: float) -> Column:
    """The value at index round_half_even((total - 1) * q) of sorted (value, n) counts."""
    k = F.bround((F.col(total) - 1) * F.lit(q), 0)
    start = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("double").alias("value"))

    def step(acc, x):
        here = (acc["seen"] <= k) & (k < acc["seen"] + x["n"])
        return F.struct((acc["seen"] + x["n"]).alias("seen"), F.when(here, x["latency_ms"]).otherwise(acc["value"]).alias("value"))

    return F.aggregate(values, start, step)["value"]


def delivery_stream(sends: DataFrame, acks: DataFrame, stream: Sequence[str] | str, errors: DataFrame | None = None, sent_ts: str = "sent_ts",
                    acked_ts: str = "acked_ts", failed_ts: str = "failed_ts", order_tiebreak: Sequence[str] = (), delay: str = "10 seconds", buckets: int = BUCKETS) -> DataFrame:
    """A stream with one row per second in which something happened (append mode).

    Columns: ``second``, ``sent``, ``acked``, ``errors`` (rows of that second), ``matched`` (pairs whose later
    time is in it) and ``p50_ms``, ``p95_ms`` (nearest rank), ``max_ms`` of their latencies.  Where no ack comes
    before its send, these are the numbers of the batch form.  ``operators.latency.with_in_flight`` adds what is
    in flight when the rows are read.  State: per open second its distinct latencies, beside that of the matcher.
    """
    def counted(df: DataFrame, ts: str, name: str) -> DataFrame:
        rows = df.select(F.col(ts).cast("timestamp").alias("at")).where("at is not null").withWatermark("at", delay)
        return rows.select("at", *[F.lit(int(c == name)).alias(c) for c in ("s", "a", "e")], F.lit(None).cast("double").alias("latency_ms"))

    pairs = _pairs(sends, acks, stream, sent_ts, acked_ts, order_tiebreak, delay, buckets)
    latency = ms_between(F.timestamp_micros("acked_us"), F.timestamp_micros("sent_us")).cast("double")
    rows = pairs.select(F.col("matched_ts").alias("at"), *[F.lit(0).alias(c) for c in "sae"], latency.alias("latency_ms"))
    for df, ts, name in ((sends, sent_ts, "s"), (acks, acked_ts, "a"), (errors, failed_ts, "e")):
        if df is not None:
            rows = rows.unionByName(counted(df, ts, name))
    each = rows.groupBy(F.window("at", "1 second"), "latency_ms").agg(*[F.sum(c).alias(c) for c in "sae"], F.count("latency_ms").alias("n"))
    pair = F.when(F.col("latency_ms").isNotNull(), F.struct("latency_ms", "n"))     # a list leaves nulls out
    per = each.groupBy(F.window("window", "1 second")).agg(
        F.sum("s").alias("sent"), F.sum("a").alias("acked"), F.sum("e").alias("errors"), F.sum("n").alias("matched"),
        F.array_sort(F.collect_list(pair)).alias("counts"), F.max("latency_ms").alias("max_ms"))
    return per.select(F.col("window.start").alias("second"), "sent", "acked", "errors", "matched",
                      *[_at_rank("counts", "matched", q).alias(c) for c, q in PERCENTILES.items()], "max_ms")
