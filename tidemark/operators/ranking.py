"""Row numbers and exact order statistics per group, without one task per group.

A plain ``row_number() over (partition by g order by o)`` sends every row of a
group to one task.  Here the rows are first counted per (group, value) with
map-side combine, which collapses ties, and a descent over the digits of the
values (``functions.order``) gives the rank at which each value starts: counts
per highest digit are summed up along the group, counts per next digit along
each digit before it, and so on down to the values.  So what meets in one task
is the digits that follow one prefix, at most 2**24 numbers, never the rows of
a group.  That holds for numbers, times and strings of any distribution, but
for strings that share nine bytes more than all strings of their group share.

Row numbers are then ``rank of the value + row_number()`` within (group,
value), and a quantile is the value whose ranks hold the wanted one.  Rows
that tie on the first order column meet in one task; make it a fine one.
It is the same plan at every size: no size check, no job while the plan is
built.  Groups and values may be null (null values sort first); joins are
null-safe.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.order import order_digits, shared_bytes


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, nulls included; the keys come once, from the left."""
    renamed = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return left.join(renamed, cond, how).drop(*[f"_r_{k}" for k in keys])


def _with_digits(counts: DataFrame, by: list[str], value: str) -> tuple[DataFrame, list[str]]:
    """``counts`` with the digits of the value, from the highest on."""
    kind = counts.schema[value].dataType
    shared = None
    if isinstance(kind, T.StringType):
        # All strings of a group begin like its least and its greatest one.
        ends = counts.groupBy(*by).agg(F.min(value).alias("_least"), F.max(value).alias("_most"))
        ends = ends.select(*by, shared_bytes(F.col("_least"), F.col("_most")).alias("_shared"))
        counts, shared = _null_safe(counts, ends, by), F.col("_shared")
    digits = order_digits(F.col(value), kind, shared)
    names = [f"_d{i}" for i in range(len(digits))]
    return counts.select(*by, value, "_c", *[d.alias(n) for n, d in zip(names, digits)]), names


def _starts(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Per (group, value): ``_c`` rows, ``_start`` rows with smaller values in the group, ``_n`` in all."""
    counts, digits = _with_digits(df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_c")), by, value)

    def before(upper: Sequence[str], order: str):
        return Window.partitionBy(*by, *upper).orderBy(F.col(order).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)

    known = None
    for k, digit in enumerate(digits):
        upper = digits[:k]
        here = counts.groupBy(*by, *upper, digit).agg(F.sum("_c").alias("_bc"))
        here = here.withColumn("_in", F.coalesce(F.sum("_bc").over(before(upper, digit)), F.lit(0)))
        if known is None:
            here = here.withColumn("_n", F.sum("_bc").over(Window.partitionBy(*by))).withColumn("_off", F.lit(0).cast("long"))
        else:
            here = _null_safe(here, known, [*by, *upper])
        known = here.select(*by, *upper, digit, (F.col("_off") + F.col("_in")).alias("_off"), "_n")
    inner = counts.withColumn("_in", F.coalesce(F.sum("_c").over(before(digits, value)), F.lit(0)))
    return (_null_safe(inner, known, [*by, *digits])
            .withColumn("_start", F.col("_off") + F.col("_in")).drop("_off", "_in", *digits))


def group_row_number(df: DataFrame, by: Sequence[str], order: Sequence[str], name: str = "rn") -> DataFrame:
    """``row_number() over (partition by by order by order)`` for skewed groups, nulls first.

    Ties on the whole ``order`` list get distinct but unspecified numbers, as
    with ``row_number``.
    """
    by, order = list(by), list(order)
    lead, rest = order[0], order[1:]
    starts = _starts(df, by, lead).select(*by, lead, "_start")
    w = Window.partitionBy(*by, lead).orderBy(*[F.col(c).asc_nulls_first() for c in rest or [lead]])
    return (_null_safe(df, starts, [*by, lead])
            .withColumn(name, (F.row_number().over(w) + F.col("_start")).cast("long")).drop("_start"))


def group_quantiles(df: DataFrame, by: Sequence[str], value: str,
                    quantiles: Mapping[str, float], method: str = "cont") -> DataFrame:
    """Exact quantiles of ``value`` per group; one row per group with a column per quantile.

    ``method="cont"``: linear interpolation between the values at ranks
    floor and ceil of ``(n-1)q`` (as ``percentile_cont``); numbers only.
    ``method="nearest"``: the value at rank ``min(n-1, round_half_even((n-1)q))``.
    Null values are ignored; groups with no non-null value are absent.
    """
    if method not in ("cont", "nearest"):
        raise ValueError(f"unknown quantile method {method!r}")
    for q in quantiles.values():
        if not 0.0 <= q <= 1.0:
            raise ValueError(f"quantile {q} outside [0, 1]")
    by = list(by)
    vals = df.select(*by, F.col(value).alias("_v")).where(F.col("_v").isNotNull())
    if method == "cont" and not isinstance(vals.schema["_v"].dataType, T.NumericType):
        raise TypeError(f"continuous quantiles need a number, not {vals.schema['_v'].dataType.simpleString()}")
    last = (F.col("_n") - 1).cast("double")

    def at(rank: Column) -> Column:
        """The value whose ranks (from 0) hold ``rank``."""
        return F.max(F.when((rank >= F.col("_start")) & (rank < F.col("_start") + F.col("_c")), F.col("_v")))

    aggs, cols = [F.max("_n").alias("_n")], [F.col(c) for c in by]
    for name, q in quantiles.items():
        pos = last * F.lit(float(q))
        if method == "nearest":
            aggs.append(at(F.least(F.col("_n") - 1, F.bround(pos, 0).cast("long"))).alias(f"{name}__lo"))
            cols.append(F.col(f"{name}__lo").alias(name))
        else:
            aggs += [at(F.floor(pos)).alias(f"{name}__lo"), at(F.ceil(pos)).alias(f"{name}__hi")]
            frac = pos - F.floor(pos)
            lo, hi = F.col(f"{name}__lo"), F.col(f"{name}__hi")
            cols.append(F.when(frac == 0, lo).otherwise(lo + frac * (hi - lo)).alias(name))
    return _starts(vals, by, "_v").groupBy(*by).agg(*aggs).select(*cols)
