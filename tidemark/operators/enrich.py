"""Left equi-join of readings to a dimension.

The join strategy is left to Spark: a dimension is broadcast when its size is
below ``spark.sql.autoBroadcastJoinThreshold``, by the bytes of its files or,
under adaptive execution, by the bytes measured when it was shuffled; above
that it is joined by a shuffle, and adaptive execution splits hot keys.
Nothing runs while the plan is built.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def enrich_left(readings: DataFrame, dim: DataFrame, keys: Sequence[str] | str) -> DataFrame:
    """Every reading is kept; readings without a dimension row get nulls."""
    return readings.join(dim, [keys] if isinstance(keys, str) else list(keys), "left")


def enrich_from_keyed(readings: DataFrame, dim_table, keys: Sequence[str] | str,
                      columns: Sequence[str] | None = None) -> DataFrame:
    """Left join to a dimension stored as a ``KeyedTable``, reading only the buckets the keys fall in.

    For a micro-batch against a large dimension this replaces reading the
    whole dimension every batch: the touched buckets are found first (at most
    ``B`` ids).
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    dim = dim_table.read_buckets(dim_table.buckets_of(readings.select(*keys)))
    if columns is not None:
        dim = dim.select(*keys, *[c for c in columns if c not in keys])
    return enrich_left(readings, dim, keys)
