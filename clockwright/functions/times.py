"""Arithmetic on zone-free timestamps.

Only interval arithmetic is used: helpers that go through epoch seconds or
zoned timestamps shift by an hour around daylight-saving changes.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def seconds_between(start: Column, end: Column) -> Column:
    """Elapsed seconds as a double, fractions kept."""
    return (end - start).cast("interval second").cast("decimal(20,6)").cast("double")


def micros_since_epoch(moment: Column) -> Column:
    """Whole microseconds, as a decimal."""
    elapsed = (moment - F.expr(_EPOCH)).cast("interval second").cast("decimal(24,6)")
    return (elapsed * F.lit(1_000_000)).cast("decimal(24,0)")


def hours_between(start: Column, end: Column) -> Column:
    return seconds_between(start, end) / F.lit(3600.0)


def minutes_between(start: Column, end: Column) -> Column:
    return seconds_between(start, end) / F.lit(60.0)


def shift_by(moment: Column, *, hours: Column | int = 0, minutes: Column | int = 0) -> Column:
    def whole(value: Column | int) -> Column:
        return (F.lit(value) if isinstance(value, int) else value).cast("int")
    return moment + F.make_dt_interval(F.lit(0), whole(hours), whole(minutes))


def days_before(moment: Column, days: int) -> Column:
    return moment - F.make_dt_interval(F.lit(days))


def work_date(moment: Column) -> Column:
    return moment.cast("date")


def week_start(moment: Column) -> Column:
    """Monday of the week that holds the moment."""
    day = moment.cast("date")
    return F.date_sub(day, F.weekday(day))


def midnight(day: Column) -> Column:
    return day.cast("timestamp_ntz")


def shift_interval(day: Column, start_hour: Column, hours: int) -> tuple[Column, Column]:
    """Start and end of a shift; the end may fall on the next day."""
    start = shift_by(midnight(day), hours=start_hour)
    return start, shift_by(start, hours=hours)


def nearest_minute(moment: Column, moved_hours: Column) -> Column:
    """``moment`` moved by fractional hours and rounded to the minute, ties to even."""
    seconds = seconds_between(F.expr(_EPOCH), moment) + moved_hours * F.lit(3600.0)
    minutes = F.bround(seconds / F.lit(60.0)).cast("bigint")
    days = F.floor(minutes / F.lit(1440)).cast("int")
    rest = F.pmod(minutes, F.lit(1440)).cast("int")
    return F.expr(_EPOCH) + F.make_dt_interval(days, F.lit(0), rest)


def iso_text(moment: Column) -> Column:
    return F.replace(moment.cast("string"), F.lit(" "), F.lit("T"))
