"""Small column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

NTZ_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def ratio(num: Column, den: Column) -> Column:
    """Floating division that gives null where the denominator is zero."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def half_even(col: Column, digits: int) -> Column:
    """Rounding with ties to the even digit, by scaling, as array libraries do it."""
    scale = float(10**digits)
    return F.rint(col * scale) / scale


def significant_digits(col: Column, digits: int) -> Column:
    """Rounding to so many significant digits, which suits numbers of very different sizes."""
    return F.when(col.isNotNull(), F.format_string(f"%.{digits - 1}e", col).cast("double"))


def polynomial(coefficients: Sequence[float], x: Column) -> Column:
    """Value of a polynomial whose coefficients are given from the constant term up."""
    value = F.lit(float(coefficients[-1]))
    for c in reversed(coefficients[:-1]):
        value = value * x + F.lit(float(c))
    return value


def seconds_of_day(ts: Column) -> Column:
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.extract(F.lit("SECOND"), ts).cast("double")


def time_of_day(ts: Column) -> Column:
    return ts - F.to_date(ts).cast("timestamp_ntz")


def whole_days_between(later: Column, earlier: Column) -> Column:
    """Floor of the elapsed days, also for negative spans, whatever the session zone."""
    short = time_of_day(later) < time_of_day(earlier)
    return F.datediff(F.to_date(later), F.to_date(earlier)) - short.cast("int")


def epoch_days(ts: Column) -> Column:
    """Days since 1970-01-01 as a double, with the time of day as the fraction."""
    return F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")) + seconds_of_day(ts) / 86400.0


def from_epoch_days(days: Column) -> Column:
    whole = F.floor(days)
    seconds = F.round((days - whole) * 86400.0).cast("int")
    start = F.expr(NTZ_EPOCH)
    return start + F.make_dt_interval(whole.cast("int"), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))
