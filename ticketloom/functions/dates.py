"""Date and window arithmetic. Every function takes its reference time as an argument, so that runs repeat."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted timestamp formats, in order, and schedule constants.
TIMESTAMP_FORMATS = (
    "yyyy-M-d'T'H:m:s.SSSSSS",
    "yyyy-M-d'T'H:m:s",
    "yyyy-M-d H:m:s.SSSSSS",
    "yyyy-M-d H:m:s",
)
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"
ISO_FRACTIONS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
DAYS_PER_MONTH = 30
TRAINING_WINDOW_MONTHS = 24
TRAINING_MONTHS = (6, 12)
REGISTRY_RETENTION_DAYS = 730
ARTEFACT_RETENTION_DAYS = 365
CACHE_TTL_HOURS = 24


def parse_timestamp(text: Column) -> Column:
    """First accepted format wins; anything else is null."""
    bare = F.regexp_replace(text, r" UTC$", "")
    return F.coalesce(*[F.try_to_timestamp(bare, F.lit(f)) for f in TIMESTAMP_FORMATS])


def to_iso(text: Column) -> Column:
    """``YYYY-MM-DD HH:MM:SS[ UTC]`` rewritten with a ``T``; other strings stay as they are."""
    bare = F.trim(F.replace(text, F.lit(" UTC"), F.lit("")))
    spaced = F.contains(text, F.lit(" UTC")) | ((F.length(text) >= 19) & (F.substring(text, 11, 1) == " "))
    parsed = F.try_to_timestamp(bare, F.lit("yyyy-M-d H:m:s"))
    return F.when(spaced & parsed.isNotNull(), F.date_format(parsed, ISO_SECONDS)).otherwise(text)


def window_start(end: Column, months: int = TRAINING_WINDOW_MONTHS, mode: str = "approx_days") -> Column:
    """Start of a training window: 30-day months by default, calendar months on request."""
    if mode == "calendar":
        return F.add_months(end, -months).cast("timestamp")
    if mode != "approx_days":
        raise ValueError(f"unknown mode {mode!r}")
    return end.cast("timestamp") - F.make_dt_interval(F.lit(DAYS_PER_MONTH * months))


def quarter_name(when: Column) -> Column:
    return F.concat(F.lit("q"), F.quarter(when))


def version_of(when: Column) -> Column:
    return F.concat(F.year(when), F.lit("_"), quarter_name(when))


def quarter_end(year: Column, quarter: Column) -> Column:
    return F.last_day(F.make_date(year, quarter * 3, F.lit(1)))


def training_due(when: Column, months: tuple[int, ...] = TRAINING_MONTHS) -> Column:
    return F.month(when).isin(*months)


def next_training_month(when: Column, months: tuple[int, ...] = TRAINING_MONTHS) -> Column:
    later = F.filter(F.array(*[F.lit(m) for m in months]), lambda m: m > F.month(when))
    return F.coalesce(F.array_min(later), F.lit(min(months)))


def end_of_day(day: Column) -> Column:
    return F.date_trunc("day", day) + F.expr("interval 23 hours 59 minutes 59 seconds")


def days_before(as_of: Column, days: int) -> Column:
    return as_of - F.make_dt_interval(F.lit(days))


def cache_expired(loaded_at: Column, as_of: Column, ttl_hours: int = CACHE_TTL_HOURS) -> Column:
    return (as_of - loaded_at) > F.make_dt_interval(F.lit(0), F.lit(ttl_hours))


def next_start(last_end: Column, parity: bool = False) -> Column:
    """Where the next window begins: at the last end, so that half-open windows join without a gap.

    With ``parity`` a second later, as for windows that include both ends; rows within that second are then lost.
    """
    return last_end + F.expr("interval 1 second") if parity else last_end


def hourly_window(last_end: Column, now: Column, parity: bool = False) -> Column:
    """Next hourly window, half-open: from the last end, at most one hour long, never past ``now``."""
    hour = F.expr("interval 1 hour")
    start = F.coalesce(next_start(last_end, parity), now - hour)
    end = F.when(last_end.isNull(), now).otherwise(F.least(start + hour, now))
    return F.struct(start.alias("start_time"), end.alias("end_time"))


def back_fill_window(
    start_date: str | None, end_date: str | None, last_end: Column, now: Column, parity: bool = False
) -> Column:
    """Half-open window for a manual run: given dates win, the watermark fills a missing start, an hour is the last resort.

    The end date is included: the window ends at the next midnight (with ``parity`` at the last second of the day).
    """
    if start_date is None and end_date is None:
        return hourly_window(last_end, now, parity)
    day = F.to_timestamp(F.lit(end_date), "yyyy-MM-dd")
    end = (end_of_day(day) if parity else day + F.expr("interval 1 day")) if end_date else now
    if start_date:
        start = F.to_timestamp(F.lit(start_date), "yyyy-MM-dd")
    else:
        start = F.coalesce(next_start(last_end, parity), now - F.expr("interval 1 hour"))
    return F.struct(start.alias("start_time"), end.alias("end_time"))
