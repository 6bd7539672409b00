"""Numbers that keep the order of a value of any atomic type.

``order_number`` is a 64-bit number; ``order_digits`` cuts a value into digits
of bounded size, from the highest on, for counting by digits.  Both never fall
when the value grows; equal numbers do not mean equal values (only the first
bytes of a string count, and a wide decimal counts as a double).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits of the lower digits of a 64-bit number.
DIGIT_BITS = 22
#: Bytes of a string in a digit, and its digits.
STRING_BYTES, STRING_DIGITS = 3, 3
#: So many leading bytes at most are looked at for what the strings of a group share.
PREFIX_BYTES = 1024


def _double_bits(v: Column) -> Column:
    """The bit pattern, turned so that its order is the order of the doubles (NaN last).

    Zeros of either sign are one value to Spark, so they are one number here.
    """
    bits = F.reflect(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), v.cast("double") + F.lit(0.0)).cast("long")
    return F.when(bits < 0, bits.bitwiseXOR(F.lit(2**63 - 1))).otherwise(bits)


def _bytes_number(v: Column, first: Column | int, count: int) -> Column:
    """``count`` bytes of a string from byte ``first`` (from 1) on as a number; bytes beyond its end count as 0."""
    at = F.lit(first) if isinstance(first, int) else first
    part = F.hex(F.substring(F.encode(v, "UTF-8"), at, F.lit(count)))
    return F.conv(F.rpad(part, 2 * count, "0"), 16, 10).cast("long")


def order_number(v: Column, kind: T.DataType) -> Column:
    """A long that never falls when the value grows; null for null."""
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(v)
    if isinstance(kind, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), v)
    if isinstance(kind, T.DateType):
        return F.unix_date(v).cast("long")
    if isinstance(kind, (T.IntegralType, T.BooleanType)):
        return v.cast("long")
    if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
        return F.when(v.isNotNull(), _double_bits(v))
    if isinstance(kind, T.StringType):
        return _bytes_number(v, 1, 7)
    raise TypeError(f"{kind.simpleString()} has no order number")


def shared_bytes(a: Column, b: Column) -> Column:
    """How many leading bytes two strings share, ``PREFIX_BYTES`` at most."""
    x, y = (F.hex(F.substring(F.encode(c, "UTF-8"), 1, PREFIX_BYTES)) for c in (a, b))
    places = F.sequence(F.lit(1), F.greatest(F.least(F.length(x), F.length(y)), F.lit(1)))
    same = F.aggregate(places, F.lit(0), lambda n, i: F.when((n == i - 1) & (F.substring(x, i, F.lit(1)) == F.substring(y, i, F.lit(1))), i).otherwise(n))
    return F.coalesce(F.floor(same / 2).cast("int"), F.lit(0))


def order_digits(v: Column, kind: T.DataType, shared: Column | None = None) -> list[Column]:
    """Digits of the value from the highest on; null for null.

    Times have one digit of about a minute, dates one of a day, narrow whole
    numbers one of 65,536.  Wide whole numbers, doubles and decimals have two
    digits, of 20 and 22 bits, and what shares both is 2**22 values at most (of
    a decimal, those that are close as doubles).  Strings have three digits of
    three bytes, after the first ``shared`` bytes, which all strings of a group
    have in common.
    """
    if isinstance(kind, T.StringType):
        skip = F.coalesce(shared, F.lit(0)) if shared is not None else F.lit(0)
        return [_bytes_number(v, skip + 1 + i * STRING_BYTES, STRING_BYTES) for i in range(STRING_DIGITS)]
    n = order_number(v, kind)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return [F.shiftright(n, 26)]
    if isinstance(kind, (T.DateType, T.BooleanType)):
        return [n]
    if isinstance(kind, T.IntegralType) and not isinstance(kind, T.LongType):
        return [F.shiftright(n, 16)]
    top = (63 // DIGIT_BITS) * DIGIT_BITS
    lower = [F.shiftright(n, at).bitwiseAND(F.lit((1 << DIGIT_BITS) - 1)) for at in range(top - DIGIT_BITS, 0, -DIGIT_BITS)]
    return [F.shiftright(n, top), *lower]
