"""Event counts, roll-ups and re-aggregations.

All aggregates are sums, counts, minima and maxima, so Spark combines them before
the shuffle and a key holding a large share of the rows costs one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from adlumen.functions.rates import kpi_columns
from adlumen.schemas import HIERARCHY, METRICS

_TYPE_OF_COUNT = {
    "impressions": "impression", "clicks": "click", "conversions": "conversion", "views": "view",
}
_GRAIN_UNIT = {"hourly": "hour", "daily": "day", "weekly": "week", "monthly": "month"}


def metric_aggregates() -> list[Column]:
    """Raw events → the six metrics, by event type."""
    counts = [
        F.expr(f"count_if(event_type = '{kind}') AS {name}") for name, kind in _TYPE_OF_COUNT.items()
    ]
    return counts + [F.sum("cost").alias("spend"), F.sum("revenue").alias("revenue")]


def metric_sums(metrics: tuple[str, ...] = METRICS) -> list[Column]:
    """Already aggregated rows → the same metrics at a coarser level."""
    return [F.sum(m).alias(m) for m in metrics]


def count_events(events: DataFrame, *keys: str | Column) -> DataFrame:
    return events.groupBy(*keys).agg(*metric_aggregates())


def ad_facts(events: DataFrame) -> DataFrame:
    """One row per ad over all given events."""
    return count_events(events, *HIERARCHY)


def daily_facts(events: DataFrame) -> DataFrame:
    """One row per ad and day: the leaf every report is built from."""
    return count_events(
        events, *HIERARCHY, F.to_date("timestamp").alias("report_date")
    )


def hourly_counts(events: DataFrame, *keys: str) -> DataFrame:
    """One row per key and clock hour; every ranking window is a re-sum of these."""
    return count_events(events, *keys, F.date_trunc("hour", F.col("timestamp")).alias("hour_start"))


def campaign_totals(facts: DataFrame) -> DataFrame:
    """Facts → campaigns. Name and advertiser come from the earliest fact row."""
    first = F.struct("report_date", "adset_id", "ad_id")
    return facts.groupBy("campaign_id").agg(
        F.min_by("campaign_name", first).alias("campaign_name"),
        F.min_by("advertiser_id", first).alias("advertiser_id"),
        *metric_sums(),
    )


def hierarchy_rollup(facts: DataFrame, *extra_keys: str) -> DataFrame:
    """Advertiser → campaign → ad set → ad sub-totals with a ``level`` label.

    ROLLUP copies its input once per level, so the input is reduced to one row per
    ad (and extra key) first; raw events never pass through the expansion.
    """
    leaf = facts.groupBy(*extra_keys, *HIERARCHY).agg(*metric_sums())
    level = (
        F.when(F.col("gid") == 0, "ad")
        .when(F.col("gid") == 1, "adset")
        .when(F.col("gid") == 3, "campaign")
        .when(F.col("gid") == 7, "advertiser")
        .otherwise("total")
    )
    if extra_keys:
        sets = [[*extra_keys, *HIERARCHY[:n]] for n in range(len(HIERARCHY), -1, -1)]
        rolled = leaf.groupingSets(sets, *extra_keys, *HIERARCHY)
    else:
        rolled = leaf.rollup(*HIERARCHY)
    return (
        rolled.agg(F.grouping_id().alias("gid"), *metric_sums())
        .select(*extra_keys, *HIERARCHY, level.alias("level"), *METRICS)
    )


def with_kpis(df: DataFrame) -> DataFrame:
    return df.withColumns(kpi_columns())


def report_by_grain(
    events: DataFrame, grains: tuple[str, ...], *keys: str, timezone: str = "UTC"
) -> DataFrame:
    """Metrics per calendar period (hourly, daily, weekly, monthly) in the report's timezone.

    Events are reduced to local hours once; every grain is a re-sum of those.
    """
    local = F.from_utc_timestamp("timestamp", timezone)
    hours = count_events(events, *keys, F.date_trunc("hour", local).alias("hour_start"))
    periods = F.explode(F.array(*[
        F.struct(F.lit(g).alias("grain"),
                 F.date_trunc(_GRAIN_UNIT[g], F.col("hour_start")).alias("period_start"))
        for g in grains
    ]))
    return (
        hours.withColumn("p", periods)
        .groupBy("p.grain", "p.period_start", *keys).agg(*metric_sums())
    )
