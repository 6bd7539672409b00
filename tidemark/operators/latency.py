"""Delivery latency: FIFO matching of sends and acks (J3), nearest-rank percentiles (A12), summary.

Within one stream the n-th acknowledgement belongs to the n-th send.  Both
sides are numbered per stream with ``group_row_number`` (so one stream with a
third of all sends still spreads over many tasks), then full-outer-joined on
(stream, n), nulls included: a send without ack is in flight; an ack without
send counts as acked but gives no latency.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import ms_between
from tidemark.operators.ranking import _null_safe, group_quantiles, group_row_number

PERCENTILES = {"p50_ms": 0.5, "p95_ms": 0.95}


def fifo_match(sends: DataFrame, acks: DataFrame, stream: Sequence[str] | str,
               sent_ts: str = "sent_ts", acked_ts: str = "acked_ts",
               order_tiebreak: Sequence[str] = ()) -> DataFrame:
    """Columns: stream keys, ``n``, ``sent_ts``, ``acked_ts``, ``latency_ms`` (null if unmatched)."""
    by = [stream] if isinstance(stream, str) else list(stream)
    s = group_row_number(sends.select(*by, sent_ts, *order_tiebreak), by, [sent_ts, *order_tiebreak], "n")
    a = group_row_number(acks.select(*by, acked_ts, *order_tiebreak), by, [acked_ts, *order_tiebreak], "n")
    s = s.select(*by, "n", sent_ts, F.lit(True).alias("_s"))
    a = a.select(*[F.col(c).alias(f"_a_{c}") for c in (*by, "n")], acked_ts)
    cond = F.col("n") == F.col("_a_n")
    for c in by:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_a_{c}"))
    keys = [F.when(F.col("_s"), F.col(c)).otherwise(F.col(f"_a_{c}")).alias(c) for c in (*by, "n")]
    return (s.join(a, cond, "full_outer").select(*keys, sent_ts, acked_ts)
             .withColumn("latency_ms", ms_between(acked_ts, sent_ts)))


def nearest_rank(df: DataFrame, by: Sequence[str], value: str,
                 quantiles: Mapping[str, float]) -> DataFrame:
    """Value at index ``min(n-1, round_half_even((n-1)q))`` of the sorted group."""
    return group_quantiles(df, by, value, quantiles, method="nearest")


def _counts() -> list[Column]:
    return [F.count("sent_ts").alias("sent"), F.count("acked_ts").alias("acked"),
            F.count_if(F.col("sent_ts").isNotNull() & F.col("acked_ts").isNull()).alias("in_flight")]


def delivery_report(matched: DataFrame, by: Sequence[str] | str,
                    errors: DataFrame | None = None) -> DataFrame:
    """Per group sent, acked, in flight, errors, p50/p95 (nearest rank) and max latency in ms.

    ``errors`` (optional) holds one row per failed delivery with the group
    columns; errors are counted and consume no send.  A group that has errors
    only is kept, with zero counts.
    """
    by = [by] if isinstance(by, str) else list(by)
    out = matched.groupBy(*by).agg(*_counts(), F.max("latency_ms").alias("max_ms"))
    pct = nearest_rank(matched.where(F.col("latency_ms").isNotNull()), by, "latency_ms", PERCENTILES)
    if not by:   # one row on each side
        both = out.unionByName(pct, allowMissingColumns=True)
        if errors is not None:
            both = both.unionByName(errors.agg(F.count(F.lit(1)).alias("errors")), allowMissingColumns=True)
        return both.agg(*[F.max(c).alias(c) for c in both.columns])
    out = _null_safe(out, pct, by, "left")
    if errors is not None:
        errs = errors.groupBy(*by).agg(F.count(F.lit(1)).alias("errors"))
        both = out.unionByName(errs, allowMissingColumns=True)
        counts = ("sent", "acked", "in_flight", "errors")
        out = both.groupBy(*by).agg(*[
            (F.coalesce(F.max(c), F.lit(0).cast("long")) if c in counts else F.max(c)).alias(c)
            for c in both.columns if c not in by])
    return out


def with_in_flight(per: DataFrame) -> DataFrame:
    """``per`` (one row per ``second`` with ``sent`` and ``matched``) with ``in_flight`` at the end of each second.

    The running sum has two levels, hours and the seconds of an hour, so no
    task orders all seconds of a long run.
    """
    per = per.withColumn("_d", F.col("sent") - F.col("matched")).withColumn("_hour", F.date_trunc("hour", "second"))
    earlier = Window.orderBy("_hour").rowsBetween(Window.unboundedPreceding, -1)
    hours = per.groupBy("_hour").agg(F.sum("_d").alias("_d")).select("_hour", F.coalesce(F.sum("_d").over(earlier), F.lit(0)).alias("_before"))
    so_far = Window.partitionBy("_hour").orderBy("second").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per.withColumn("_inner", F.sum("_d").over(so_far)).join(hours, "_hour") \
              .withColumn("in_flight", F.col("_before") + F.col("_inner")).drop("_hour", "_d", "_before", "_inner")


def delivery_per_second(matched: DataFrame, errors: DataFrame | None = None, failed_ts: str = "failed_ts") -> DataFrame:
    """A13 over time: per second sent and acked in it, errors, and the latency of what was acked in it.

    ``in_flight`` is what was sent up to the end of the second and not acked
    by then.
    """
    def second(ts: str, df: DataFrame) -> Column:
        return F.date_trunc("second", ts).cast(df.schema[ts].dataType).alias("second")

    sends = matched.where("sent_ts is not null").select(second("sent_ts", matched), F.lit(1).alias("s"))
    acks = matched.where("acked_ts is not null").select(second("acked_ts", matched), F.lit(1).alias("a"),
                                                        F.col("sent_ts").isNotNull().cast("int").alias("m"), "latency_ms")
    rows = sends.unionByName(acks, allowMissingColumns=True)
    if errors is not None:
        rows = rows.unionByName(errors.select(second(failed_ts, errors), F.lit(1).alias("e")), allowMissingColumns=True)
    else:
        rows = rows.withColumn("e", F.lit(None).cast("int"))
    per = rows.groupBy("second").agg(F.count("s").alias("sent"), F.count("a").alias("acked"), F.count("e").alias("errors"),
                                     F.coalesce(F.sum("m"), F.lit(0).cast("long")).alias("matched"), F.max("latency_ms").alias("max_ms"))
    per = with_in_flight(per).drop("matched")
    pct = nearest_rank(acks.where("latency_ms is not null"), ["second"], "latency_ms", PERCENTILES)
    return _null_safe(per, pct, ["second"], "left").select("second", "sent", "acked", "in_flight", "errors", "p50_ms", "p95_ms", "max_ms")


def delivery_overall(matched: DataFrame, errors: DataFrame | None = None) -> DataFrame:
    """A13 in one row: counts, errors, acks per second of the run, p50, p95 and max latency in ms.

    The run lasts from the first send to the last ack; the rate is null for a
    run without length.
    """
    report = delivery_report(matched, [], errors)
    if errors is None:
        report = report.withColumn("errors", F.lit(0).cast("long"))
    span = matched.agg(ms_between(F.max("acked_ts"), F.min("sent_ts")).alias("run_ms"))
    both = report.unionByName(span, allowMissingColumns=True)
    both = both.agg(*[F.max(c).alias(c) for c in both.columns])
    rate = F.when(F.col("run_ms") > 0, F.col("acked") * F.lit(1000.0) / F.col("run_ms"))
    return both.select("sent", "acked", "in_flight", "errors", rate.alias("acked_per_s"), "p50_ms", "p95_ms", "max_ms")
