"""Column helpers that give the reference's (Postgres) scalar semantics.

Ratios are returned as doubles made by ONE division of exact integers, so the
value does not depend on the order of floating-point steps. Rounded ratios are
rounded half away from zero in integer arithmetic first (``numeric`` rounding),
then scaled by one division. Everything stays a built-in expression, inside
whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def idiv(a: Column, b: Column) -> Column:
    """Integer division truncating toward zero (Postgres ``int / int``)."""
    return F.call_function("div", a.cast("long"), b.cast("long"))


def ratio(num: Column, den: Column) -> Column:
    """num / den as a double from one IEEE division (NULL stays NULL)."""
    return num.cast("double") / den.cast("double")


def rounded_ratio(num: Column, den: Column, scale: int) -> Column:
    """round(num / den, scale) half away from zero, as a double.

    ``den`` must be positive (or NULL, giving NULL); ``num`` any integer.
    """
    q = 10 ** scale
    n = num.cast("long")
    d = den.cast("long")
    mag = idiv(F.abs(n) * F.lit(2 * q) + d, d * F.lit(2))
    signed = F.when(n < 0, -mag).otherwise(mag)
    return signed.cast("double") / F.lit(float(q))


def rounded_ratio_key(num: Column, den: Column, scale: int) -> Column:
    """The integer (scaled) rounded ratio, an exact sort key."""
    q = 10 ** scale
    n = num.cast("long")
    d = den.cast("long")
    mag = idiv(F.abs(n) * F.lit(2 * q) + d, d * F.lit(2))
    return F.when(n < 0, -mag).otherwise(mag)


def days_between(later: Column, earlier: Column) -> Column:
    """``later::date - earlier::date`` as an int number of days."""
    return F.datediff(F.to_date(later), F.to_date(earlier))


def weekday_sunday0(ts: Column) -> Column:
    """Postgres ``EXTRACT(DOW ...)``: Sunday = 0 ... Saturday = 6."""
    return F.dayofweek(ts) - F.lit(1)


def weekday_name(ts: Column) -> Column:
    """Postgres ``to_char(ts, 'FMDay')``: the English day name."""
    return F.date_format(ts, "EEEE")


def fail_if(cond: Column, value: Column, message: str) -> Column:
    """``value``, but raise ``message`` on rows where ``cond`` holds."""
    return F.when(cond, F.raise_error(F.lit(message))).otherwise(value)
