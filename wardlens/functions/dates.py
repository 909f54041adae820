"""Date and time expressions on timestamps without zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

DAY_MICROS = 86_400_000_000

# Names of the days from Sunday, and the seasons' months.
WEEKDAYS = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")
SEASONS = {"Winter": (12, 1, 2), "Spring": (3, 4, 5), "Summer": (6, 7, 8), "Fall": (9, 10, 11)}


def micros(ts: Column) -> Column:
    """Wall-clock microseconds since 1970, whatever the session's time zone."""
    return F.unix_date(F.to_date(ts)).cast("bigint") * F.lit(DAY_MICROS) + micros_of_day(ts)


def micros_of_day(ts: Column) -> Column:
    """Microseconds since midnight."""
    minutes = F.hour(ts) * 60 + F.minute(ts)
    seconds = F.extract(F.lit("SECOND"), ts) * F.lit(1_000_000)
    return minutes.cast("bigint") * F.lit(60_000_000) + seconds.cast("bigint")


def epoch_seconds(ts: Column) -> Column:
    return micros(ts) / F.lit(1000000.0)


def hours_between(start: Column, stop: Column) -> Column:
    return (micros(stop) - micros(start)) / F.lit(3600e6)


def days_between(start: Column, stop: Column) -> Column:
    """Days with their fraction."""
    return (micros(stop) - micros(start)) / F.lit(86400e6)


def whole_days_between(start: Column, stop: Column) -> Column:
    """Full 24-hour days, cut towards zero."""
    return F.call_function("div", micros(stop) - micros(start), F.lit(DAY_MICROS))


def calendar_days_between(start: Column, stop: Column) -> Column:
    return F.datediff(stop, start)


def day_of_week(ts: Column) -> Column:
    """0 for Sunday to 6 for Saturday."""
    return F.dayofweek(ts) - 1


def weekday_name(ts: Column) -> Column:
    return F.element_at(F.array(*[F.lit(d) for d in WEEKDAYS]), F.dayofweek(ts))


def month_start(ts: Column) -> Column:
    """First instant of the month, without zone."""
    return F.date_trunc("month", ts).cast("timestamp_ntz")


def seconds_of_day(ts: Column) -> Column:
    """Seconds since midnight with their fraction."""
    return micros_of_day(ts) / F.lit(1000000.0)


def within_time_of_day(ts: Column, start: str, stop: str) -> Column:
    """Is the clock time between two ``HH:MM:SS`` texts, both included?"""

    def seconds(clock: str) -> int:
        hours, minutes, secs = (int(p) for p in clock.split(":"))
        return hours * 3600 + minutes * 60 + secs

    return seconds_of_day(ts).between(seconds(start), seconds(stop))


def hour_slot(hour: Column) -> Column:
    """``9AM - 10AM`` for hour 9 of a 24-hour clock."""

    def clock(h: Column) -> Column:
        twelve = F.pmod(h + 11, F.lit(12)) + 1
        half = F.when(F.pmod(h, F.lit(24)) < 12, F.lit("AM")).otherwise(F.lit("PM"))
        return F.concat(twelve.cast("string"), half)

    return F.concat(clock(hour), F.lit(" - "), clock(hour + 1))


def season(ts: Column) -> Column:
    month = F.month(ts)
    out = F.lit(None).cast("string")
    for name, months in SEASONS.items():
        out = F.when(month.isin(*months), F.lit(name)).otherwise(out)
    return out


def years_since(birth_year: Column, as_of_year: int) -> Column:
    """Age in years at a given year; the year is a parameter so that runs repeat."""
    return F.lit(as_of_year) - birth_year


def birth_year(at: Column, age: Column) -> Column:
    return F.year(at) - age
