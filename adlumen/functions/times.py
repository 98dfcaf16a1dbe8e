"""Ages, lookback windows and run modes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

_DAY_MICROS = 86_400 * 1_000_000
_HOUR_MICROS = 3_600 * 1_000_000


def as_timestamp(value: dt.datetime | str | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp")


def micros_between(end: Column, start: Column) -> Column:
    return F.unix_micros(end) - F.unix_micros(start)


def age_hours(ts: Column, reference: Column) -> Column:
    return micros_between(reference, ts) / F.lit(float(_HOUR_MICROS))


def age_days(ts: Column, reference: Column) -> Column:
    """Whole days elapsed, floored (``datediff`` would count midnights instead)."""
    return F.floor(micros_between(reference, ts) / F.lit(float(_DAY_MICROS)))


def exact_days(ts: Column, reference: Column) -> Column:
    return micros_between(reference, ts) / F.lit(float(_DAY_MICROS))


def period_days(start: Column, end: Column) -> Column:
    """Days in a range with both ends included."""
    return F.datediff(end, start) + 1


def is_full_rebuild(run_date: Column, forced: Column | bool = False) -> Column:
    """Mondays, or on demand."""
    return (F.weekday(run_date) == 0) | (forced if isinstance(forced, Column) else F.lit(forced))


def lookback_start(run_date: Column, full: Column, full_days: int = 90, short_days: int = 7) -> Column:
    return F.date_sub(run_date, F.when(full, F.lit(full_days)).otherwise(F.lit(short_days)))


def expires_at(computed_at: Column, ttl_seconds: int = 86_400) -> Column:
    return computed_at + F.make_dt_interval(secs=F.lit(ttl_seconds))
