"""Date and time functions with enterprise-SQL meaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..errors import UnsupportedFeatureError

UNITS = ("year", "quarter", "month", "week", "day", "hour", "minute", "second")


def _unit(unit: str) -> str:
    if unit.lower() not in UNITS:
        raise UnsupportedFeatureError(f"date part {unit}")
    return unit.lower()


def datetrunc(unit: str, value: Column) -> Column:
    return F.date_trunc(_unit(unit), value).cast("timestamp_ntz")


def datediff_big(unit: str, start: Column, end: Column) -> Column:
    """Boundaries of the unit crossed from start to end; a week begins on Sunday, whatever the session says."""
    if _unit(unit) == "week":  # Spark's begins on Monday
        start, end = (F.timestamp_add("day", F.lit(1), v.cast("timestamp_ntz")) for v in (start, end))
    return F.timestamp_diff(_unit(unit), F.date_trunc(_unit(unit), start), F.date_trunc(_unit(unit), end)).cast("long")


def datediff(unit: str, start: Column, end: Column) -> Column:
    return datediff_big(unit, start, end).cast("int")


def dateadd(unit: str, amount: Column | int, value: Column) -> Column:
    """Adds (or takes away) units; a month's end clamps."""
    amount = amount if isinstance(amount, Column) else F.lit(amount)
    return F.timestamp_add(_unit(unit), amount, value.cast("timestamp_ntz"))


def eomonth(value: Column, months: int = 0) -> Column:
    return F.last_day(F.add_months(value.cast("date"), months))


def datefromparts(year: Column, month: Column, day: Column) -> Column:
    return F.make_date(year, month, day)


def datetime2fromparts(year: Column, month: Column, day: Column, hour: Column, minute: Column, second: Column, fraction: Column, precision: int = 7) -> Column:
    """The fraction counts units of 10^-precision seconds."""
    return F.make_timestamp_ntz(year, month, day, hour, minute, _seconds(second, fraction, precision))


def _seconds(second: Column, fraction: Column | None, precision: int) -> Column:
    """Seconds with a fraction in units of 10^-precision; microseconds are the finest that Spark keeps."""
    if fraction is None:
        return second.cast("decimal(16,6)")
    return (second.cast("decimal(16,6)") + fraction.cast("decimal(16,6)") / (10**precision)).cast("decimal(16,6)")


def datetimeoffsetfromparts(year: Column, month: Column, day: Column, hour: Column, minute: Column, second: Column, offset: str, fraction: Column | None = None, precision: int = 7) -> Column:
    """An instant, from a local time and its offset (``+02:00``)."""
    return F.make_timestamp(year, month, day, hour, minute, _seconds(second, fraction, precision), F.lit(offset))


def timefromparts(hour: Column, minute: Column, second: Column, fraction: Column | None = None, precision: int = 7) -> Column:
    """A TIME; needs spark.sql.timeType.enabled."""
    return F.make_time(hour, minute, _seconds(second, fraction, precision))


def now() -> Column:
    return F.localtimestamp()


def current_time() -> Column:
    """Time of day; a TIME needs spark.sql.timeType.enabled, so this is its text."""
    return F.date_format(F.localtimestamp(), "HH:mm:ss.SSSSSS")


def interval(*_: object) -> Column:
    raise UnsupportedFeatureError("a standalone interval")
