"""Space-filling clustering: rows close in every column lie close in the files.

A table sorted by (site, time) serves filters on the site; one on the time
alone finds its rows in every file.  Here each column is first reduced to its
rank among sampled quantiles (``2 ** bits`` of them, one aggregate over the
columns), so skewed values and any ordered type fill the square evenly.  The
ranks are folded to one number, the place on a Hilbert curve for two columns
or on a Z curve for another number, and the rows are range-partitioned by it.
A file then holds a small range of every column, and the minima and maxima in
the Parquet footers let a filter on any of them skip files.

All steps are DataFrame expressions.  The driver holds the quantiles only
(``2 ** bits`` numbers per column).  A place that holds many rows, as when a
site has a third of all readings, is split further by the columns themselves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.order import order_number

#: Accuracy of the sampled quantiles; more than four per rank.
ACCURACY = 2000


def quantile_bounds(df: DataFrame, columns: Sequence[str], bits: int) -> dict[str, list[int]]:
    """For each column the bounds of its ``2 ** bits`` quantile ranks, as order numbers.

    A frequent value is several bounds at once, so its rank is its quantile and the ranks fill the whole side.
    """
    cuts = [i / (1 << bits) for i in range(1, 1 << bits)]
    keys = [order_number(F.col(c), df.schema[c].dataType).alias(f"k{i}") for i, c in enumerate(columns)]
    row = df.select(*keys).agg(*[F.percentile_approx(f"k{i}", cuts, ACCURACY).alias(c) for i, c in enumerate(columns)]).first()
    return {c: sorted(row[c] or []) for c in columns}


def rank_in(key: Column, bounds: Sequence[int], bits: int) -> Column:
    """How many of the sorted ``bounds`` the key reaches (null: 0), by binary search."""
    if not bounds:
        return F.lit(0)
    known = F.array(*[F.lit(b).cast("long") for b in bounds])
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(bits))])
    found = F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        (at + step <= len(bounds)) & (F.get(known, at + step - 1) <= key), at + step).otherwise(at))
    return F.when(key.isNull(), F.lit(0)).otherwise(found)


def hilbert(x: Column, y: Column, bits: int) -> Column:
    """The place of a cell of a ``2 ** bits`` square on the Hilbert curve."""
    start = F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"), F.lit(0).cast("long").alias("d"))
    sides = F.array(*[F.lit(1 << i).cast("long") for i in reversed(range(bits))])

    def step(at: Column, side: Column) -> Column:
        right, up = (at["x"] >= side).cast("long"), (at["y"] >= side).cast("long")
        inner_x, inner_y = at["x"] - right * side, at["y"] - up * side
        quarter = F.when(right == 0, up).otherwise(3 - up)
        # The curve enters the lower quarters turned: the first along the diagonal, the last along the other one.
        turned, other = up == 0, right == 1
        return F.struct(
            F.when(turned & other, side - 1 - inner_y).when(turned, inner_y).otherwise(inner_x).alias("x"),
            F.when(turned & other, side - 1 - inner_x).when(turned, inner_x).otherwise(inner_y).alias("y"),
            (at["d"] + quarter * side * side).alias("d"))

    return F.aggregate(sides, start, step, lambda at: at["d"])


def z_order(ranks: Sequence[Column], bits: int) -> Column:
    """The ranks' bits interleaved, the first column's highest."""
    out, n = F.lit(0).cast("long"), len(ranks)
    for i, r in enumerate(ranks):
        for b in range(bits):
            out = out.bitwiseOR(F.shiftleft(F.shiftright(r.cast("long"), b).bitwiseAND(F.lit(1)), b * n + n - 1 - i))
    return out


def curve_place(df: DataFrame, columns: Sequence[str], bits: int = 8) -> Column:
    """The place of a row on the curve through the ranks of ``columns``; runs one aggregate."""
    if len(columns) * bits > 62:
        raise ValueError(f"{len(columns)} columns of {bits} bits do not fit a long")
    bounds = quantile_bounds(df, columns, bits)
    ranks = [rank_in(order_number(F.col(c), df.schema[c].dataType), bounds[c], bits) for c in columns]
    if len(ranks) == 1:
        return ranks[0].cast("long")
    return hilbert(*ranks, bits) if len(ranks) == 2 else z_order(ranks, bits)


def clustered(df: DataFrame, columns: Sequence[str], files: int | None = None, bits: int = 8) -> DataFrame:
    """``df`` range-partitioned and sorted along the curve through ``columns``, ready to be written.

    Nulls count as the lowest values.  ``files``: how many partitions, by default the session's number.
    """
    place = "_place"
    while place in df.columns:
        place += "_"
    out = df.withColumn(place, curve_place(df, columns, bits))
    by = [place, *columns]
    out = out.repartitionByRange(files, *by) if files else out.repartitionByRange(*by)
    return out.sortWithinPartitions(*by).drop(place)
