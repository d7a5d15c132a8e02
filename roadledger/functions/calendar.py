"""Calendar and time-of-day expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Names in calendar order and the day periods.
MONTH_NAMES = ["January", "February", "March", "April", "May", "June", "July", "August",
               "September", "October", "November", "December"]
DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
DAY_PERIODS = [("Morning Rush", 6, 10), ("Midday", 10, 16), ("Evening Rush", 16, 20)]
OTHER_PERIOD = "Night"
UNPARSED_TIME = "2024-06-01 12:00:00"


def _name_at(names: list[str], position: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), position)


def parse_when(date_text: Column, time_text: Column, day_first: bool = True) -> Column:
    """Zone-free timestamp from a date text and the first five characters of a time text.

    Accepts year-first dates and dates ending in the year; null when a part is missing, does not
    match or is no real date. The fields are taken apart and put together again without a zone, so
    no session time zone can shift the hour.
    """
    text = F.concat(F.trim(date_text), F.lit(" "), F.substring(F.trim(time_text), 1, 5))
    shape = r"^(\d{4}[-/]\d{1,2}[-/]\d{1,2}|\d{1,2}[-/]\d{1,2}[-/]\d{4}) \d{1,2}:\d{2}$"
    parts = F.split(text, "[-/ :]")

    def part(iso_place: int, tail_place: int) -> Column:
        year_first = F.length(F.get(parts, F.lit(0))) == 4
        return F.get(parts, F.when(year_first, F.lit(iso_place)).otherwise(F.lit(tail_place))).try_cast("int")

    day, month = (0, 1) if day_first else (1, 0)
    # An hour or minute out of range makes the whole stamp null, like an impossible date.
    stamp = F.try_make_timestamp_ntz(part(0, 2), part(1, month), part(2, day), part(3, 3), part(4, 4),
                                     F.lit(0).cast("decimal(8,6)"))
    return F.when(text.rlike(shape), stamp)


def incident_time(date_text: Column, time_text: Column, day_first: bool = True,
                  fallback: str | None = UNPARSED_TIME) -> Column:
    """``parse_when`` with a constant in place of unreadable values (none if ``fallback`` is None)."""
    parsed = parse_when(date_text, time_text, day_first)
    if fallback is None:
        return parsed
    return F.coalesce(parsed, F.lit(fallback).cast("timestamp_ntz"))


def month_name(ts: Column) -> Column:
    return _name_at(MONTH_NAMES, F.month(ts))


def day_name(ts: Column) -> Column:
    return _name_at(DAY_NAMES, F.weekday(ts) + 1)


def is_weekend(ts: Column) -> Column:
    return F.weekday(ts) >= 5


def date_key(ts: Column) -> Column:
    """YYYYMMDDHH as an integer, by arithmetic on the calendar fields."""
    return (F.year(ts) * 1000000 + F.month(ts) * 10000 + F.dayofmonth(ts) * 100 + F.hour(ts)).cast("int")


def time_of_day(hour: Column) -> Column:
    bucket = None
    for label, start, end in DAY_PERIODS:
        inside = (hour >= start) & (hour < end)
        bucket = F.when(inside, label) if bucket is None else bucket.when(inside, label)
    return bucket.otherwise(OTHER_PERIOD)


def calendar_columns(ts: Column) -> dict[str, Column]:
    """Every attribute of the date dimension, by name."""
    hour = F.hour(ts)
    return {
        "date_key": date_key(ts),
        "full_date": F.to_date(ts),
        "year": F.year(ts),
        "quarter": F.quarter(ts),
        "month": F.month(ts),
        "month_name": month_name(ts),
        "day_of_month": F.dayofmonth(ts),
        "day_of_week": F.weekday(ts),
        "day_name": day_name(ts),
        "is_weekend": is_weekend(ts),
        "hour": hour,
        "time_of_day": time_of_day(hour),
    }


def hour_sin(hour: Column) -> Column:
    return F.sin(F.lit(2.0) * F.pi() * hour / F.lit(24.0))


def hour_cos(hour: Column) -> Column:
    return F.cos(F.lit(2.0) * F.pi() * hour / F.lit(24.0))


def hour_label(hour: Column) -> Column:
    return F.format_string("%02d:00", hour)


def weekend_label(flag: Column) -> Column:
    """Reads a flag kept as boolean, number or text."""
    yes = F.lower(flag.cast("string")).isin("true", "1")
    return F.when(yes, "Weekend (Sat-Sun)").otherwise("Weekday (Mon-Fri)")


def sort_time(full_date: Column, hour: Column) -> Column:
    """Date plus whole hours, the chronological sort key."""
    return full_date.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), hour.cast("int"))


def rank_in(names: list[str], value: Column) -> Column:
    """Position of ``value`` in a fixed display order, 0 when it is not listed."""
    return F.array_position(F.array(*[F.lit(n) for n in names]), value).cast("int")
