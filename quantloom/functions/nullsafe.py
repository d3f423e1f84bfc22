"""Null rules that every metric shares. A NULL is an answer: nothing here guesses.

Columns in, columns out; all of it stays inside whole-stage code generation.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def num(c: Column | str) -> Column:
    return col(c).cast("double")


def safe_div(a: Column | str, b: Column | str) -> Column:
    """O8.1: NULL if either is NULL or the divisor is 0."""
    return F.try_divide(num(a), num(b))


def over_positive(a: Column | str, b: Column | str) -> Column:
    """NULL unless the divisor is above 0."""
    return F.when(num(b) > 0, num(a) / F.nullif(num(b), F.lit(0.0)))


def mean_of(*values: Column | str) -> Column:
    """O8.1: mean of those that are not NULL."""
    held = F.array_compact(F.array(*map(num, values)))
    return F.when(F.size(held) > 0, F.aggregate(held, F.lit(0.0), lambda a, x: a + x) / F.nullif(F.size(held), F.lit(0)))


def filled(c: Column | str, value: float = 0) -> Column:
    """``c`` with NULL as ``value``."""
    return F.coalesce(col(c), F.lit(value))


def first_nonzero(*values: Column | str) -> Column:
    """The first value that is neither NULL nor 0; the last one if there is none. 0 counts as missing."""
    *heads, last = map(col, values)
    return reduce(lambda rest, v: F.when(v.isNotNull() & (v != 0), v).otherwise(rest), reversed(heads), last)


def growth(now: Column | str, before: Column | str) -> Column:
    """O8.2: change over the size of what was before; NULL if that is NULL or 0."""
    return F.try_divide(num(now) - num(before), F.abs(num(before)))


def cagr(start: Column | str, end: Column | str, years: Column | float) -> Column:
    """O8.3: NULL unless both ends and the years are above 0."""
    n = years if isinstance(years, Column) else F.lit(float(years))
    ok = (num(start) > 0) & (num(end) > 0) & (n > 0)
    return F.when(ok, F.pow(num(end) / F.nullif(num(start), F.lit(0.0)), F.lit(1.0) / F.nullif(n, F.lit(0.0))) - 1)


def truncated(c: Column) -> Column:
    """Towards zero, as a long."""
    return c.cast("long")


def clamp(c: Column, low: float, high: float) -> Column:
    """NULL stays NULL."""
    return F.when(c.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), c)))


def turn(now: Column | str, before: Column | str) -> Column:
    """O8.6: 'turnaround' from below 0 to 0 or above, 'downturn' the other way, else NULL."""
    a, b = num(now), num(before)
    return F.when((b < 0) & (a >= 0), "turnaround").when((a < 0) & (b >= 0), "downturn")
