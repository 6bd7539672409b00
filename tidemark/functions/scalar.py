"""Scalar column functions of the data model."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def classify_status(value: ColumnOrName, low: ColumnOrName, high: ColumnOrName) -> Column:
    """HIGH above the high band, else LOW below the low band, else OK.

    Comparisons are strict; a missing band or value never alarms.  NaN sorts
    above every number in Spark, so a NaN reading with a high band is HIGH.
    """
    v, lo, hi = _c(value), _c(low), _c(high)
    return (F.when(hi.isNotNull() & (v > hi), F.lit("HIGH"))
            .when(lo.isNotNull() & (v < lo), F.lit("LOW"))
            .otherwise(F.lit("OK")))


def clip_to_range(value: ColumnOrName, lo: ColumnOrName | float, hi: ColumnOrName | float,
                  digits: int = 3) -> Column:
    """Clamp into [lo, hi] and round; a null value stays null.

    ``least``/``greatest`` skip nulls, so the guard is needed.
    """
    v = _c(value)
    lo_c = lo if isinstance(lo, Column) else F.lit(lo)
    hi_c = hi if isinstance(hi, Column) else F.lit(hi)
    return F.when(v.isNotNull(), F.round(F.least(hi_c, F.greatest(lo_c, v)), digits))


def compose_id(site: ColumnOrName, prefix: ColumnOrName, unit: ColumnOrName,
               key: ColumnOrName) -> Column:
    """``{site}-{prefix}{unit:02d}-{key}``."""
    return F.format_string("%s-%s%02d-%s", _c(site), _c(prefix), _c(unit), _c(key))


def compose_tag(site: ColumnOrName, prefix: ColumnOrName, unit: ColumnOrName,
                key: ColumnOrName, signal: ColumnOrName | None = None) -> Column:
    """``{site}_{prefix}{unit:02d}_{key}_{signal}``; the signal defaults to PV."""
    sig = F.lit("PV") if signal is None else _c(signal)
    return F.format_string("%s_%s%02d_%s_%s", _c(site), _c(prefix), _c(unit), _c(key), sig)


def micros_to_ts(micros: ColumnOrName) -> Column:
    """Epoch microseconds to TIMESTAMP."""
    return F.timestamp_micros(_c(micros))


def micros_to_ntz(micros: ColumnOrName) -> Column:
    """Epoch microseconds to TIMESTAMP_NTZ holding the UTC wall clock (independent of the session zone)."""
    secs = (_c(micros).cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=secs)


def utc_wall_clock(ts: ColumnOrName) -> Column:
    """An instant (TIMESTAMP) as the TIMESTAMP_NTZ of its UTC wall clock, whatever the session zone."""
    return F.to_utc_timestamp(_c(ts), F.current_timezone()).cast("timestamp_ntz")


def micros_between(later: ColumnOrName, earlier: ColumnOrName) -> Column:
    """Whole microseconds from ``earlier`` to ``later`` (zone-free for TIMESTAMP_NTZ)."""
    return F.timestamp_diff("MICROSECOND", _c(earlier), _c(later))


def ms_between(later: ColumnOrName, earlier: ColumnOrName) -> Column:
    """Fractional milliseconds from ``earlier`` to ``later``."""
    return micros_between(later, earlier) / F.lit(1000.0)
