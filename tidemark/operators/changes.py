"""M2: change history between two versions of a keyed table.

A full outer join on the key of the two versions: a key only in the new one is
an insert, only in the old one a delete, in both with any non-key column
different (null-safe) an update.  Unchanged keys produce no row.  Both sides
are shuffled by key once; keys are unique per version, so no key is hot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def change_history(before: DataFrame, after: DataFrame, keys: Sequence[str] | str,
                   version: int, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows: keys, ``change_type`` (insert/update/delete), ``version``, ``old_<c>``/``new_<c>`` per column."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    cols = list(columns) if columns is not None else [c for c in after.columns if c not in keys]
    b = before.select(*keys, *[F.col(c).alias(f"old_{c}") for c in cols], F.lit(True).alias("_in_old"))
    a = after.select(*keys, *[F.col(c).alias(f"new_{c}") for c in cols], F.lit(True).alias("_in_new"))
    j = b.join(a, keys, "full_outer")
    differs = F.lit(False)
    for c in cols:
        differs = differs | ~F.col(f"old_{c}").eqNullSafe(F.col(f"new_{c}"))
    kind = (F.when(F.col("_in_old").isNull(), F.lit("insert"))
             .when(F.col("_in_new").isNull(), F.lit("delete"))
             .when(differs, F.lit("update")))
    out = j.withColumn("change_type", kind).where(F.col("change_type").isNotNull())
    pairs = [x for c in cols for x in (f"old_{c}", f"new_{c}")]
    return out.select(*keys, "change_type", F.lit(version).alias("version"), *pairs)
