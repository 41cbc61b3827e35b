"""Small column expressions, all evaluated inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MASK32 = 0xFFFFFFFF


def mix32(key: Column, seed: int = 0) -> Column:
    """Deterministic 32-bit hash of a long key, 0 .. 2**32-1, plain long arithmetic.

    Both halves of the key enter, so ids that differ only in their upper bits still spread. The value
    of each step is used at most twice: filters evaluate the whole expression without sharing parts.
    """
    low = key.bitwiseAND(F.lit(MASK32))
    high = F.shiftrightunsigned(key, 32)
    start = low * F.lit(0x3C6EF35F) + high * F.lit(0x1B873593) + F.lit((seed & MASK32) * 0x10DCD)
    x = F.pmod(start, F.lit(4294967291))
    x = x.bitwiseXOR(F.shiftrightunsigned(x, 15)) * F.lit(0x2C1B3C6D)
    x = x.bitwiseAND(F.lit(MASK32))
    x = x.bitwiseXOR(F.shiftrightunsigned(x, 13)) * F.lit(0x297A2D39)
    return x.bitwiseAND(F.lit(MASK32))


def micros(ts: Column) -> Column:
    """Microseconds since the epoch (session zone UTC for timestamps without zone)."""
    return F.unix_micros(ts.cast("timestamp"))


def cents(amount: Column) -> Column:
    """Money as whole cents: sums of longs are exact in any order, sums of doubles are not.

    An amount that is no number or beyond 64 bits has no cents.
    """
    return F.round(amount * 100).try_cast("long")


def flag(condition: Column) -> Column:
    """0/1 integer of a condition; unknown counts as 0."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as double, 0 where the denominator is 0."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(part.cast("double") / whole)


def whole_part(value: Column, divisor: int | Column) -> Column:
    """Integer quotient of non-negative longs."""
    by = divisor if isinstance(divisor, Column) else F.lit(divisor)
    return ((value - F.pmod(value, by)) / by).cast("long")
