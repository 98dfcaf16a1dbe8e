"""Partitioned event tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from adlumen.schemas import AD_EVENT


def date_predicate(start: dt.date, end: dt.date) -> Column:
    """start ≤ day ≤ end, on partition columns only, so whole directories are skipped.

    Partition values are written zero-padded and read back as integers.
    """
    day = F.make_date("year", "month", "day")
    bounds = F.col("year").between(start.year, end.year)
    return bounds & day.between(F.lit(start), F.lit(end))


def read_events(
    spark: SparkSession,
    root: str,
    start: dt.date,
    end: dt.date,
    event_types: list[str] | None = None,
    schema: StructType = AD_EVENT,
) -> DataFrame:
    """Processed events of a date range (both ends included)."""
    events = spark.read.schema(schema).parquet(root).where(date_predicate(start, end))
    return events.where(F.col("event_type").isin(*event_types)) if event_types else events


def read_window(
    spark: SparkSession, root: str, before: dt.datetime, hours: int, **options
) -> DataFrame:
    """Events of the half-open window [before − hours, before)."""
    since = before - dt.timedelta(hours=hours)
    ts = F.col("timestamp")
    return read_events(spark, root, since.date(), before.date(), **options).where(
        (ts >= F.lit(since)) & (ts < F.lit(before))
    )


def read_landing_day(
    spark: SparkSession, root: str, day: dt.date, schema: StructType = AD_EVENT
) -> DataFrame:
    """All hours and event types landed for one day, in a single scan."""
    folder = f"{root.rstrip('/')}/{day:%Y%m%d}"
    return spark.read.schema(schema).option("basePath", folder).parquet(folder)


def campaign_events(spark: SparkSession, events: DataFrame, campaign_id) -> DataFrame:
    """Point query with a bound parameter."""
    return spark.sql(
        "SELECT * FROM {events} WHERE campaign_id = :id", args={"id": campaign_id}, events=events
    )
