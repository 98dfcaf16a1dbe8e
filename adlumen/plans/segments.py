"""User features, RFM tiers and segment memberships.

The kept state is one row per user and day. A run replaces the most recent days and sums
the last 90 again, so old days leave the window by themselves.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from adlumen.functions import rfm
from adlumen.functions.rates import ratio
from adlumen.functions.sums import exact_sum
from adlumen.functions.times import exact_days
from adlumen.operators.quality import segment_checks, share_of_total
from adlumen.operators.ranks import approximate_cuts, quantile_cuts
from adlumen.schemas import RFM_TIERS
from adlumen.sinks import tables

QUINTILES = [0.2, 0.4, 0.6, 0.8]
LOOKBACK_DAYS, PATCH_DAYS, SHORT_DAYS = 90, 7, 30
MIN_IMPRESSIONS = 5
_KINDS = {"impression": "impression", "click": "click", "conversion": "conversion"}


def user_days(events: DataFrame) -> DataFrame:
    """Counts, revenue and last event times per user and day."""
    kind = F.col("event_type")
    return (
        events.where(F.col("user_id").isNotNull() & kind.isin(*_KINDS))
        .groupBy("user_id", F.to_date("timestamp").alias("day"))
        .agg(
            *[F.count_if(kind == k).alias(f"{k}_count") for k in _KINDS],
            *[F.max(F.when(kind == k, F.col("timestamp"))).alias(f"last_{k}") for k in _KINDS],
            exact_sum(F.col("revenue")).alias("spend"),
        )
    )


def replace_days(state: DataFrame, patch: DataFrame, since: dt.date | Column) -> DataFrame:
    """State before ``since`` plus freshly computed days from then on."""
    since = since if isinstance(since, Column) else F.lit(since)
    return state.where(F.col("day") < since).unionByName(patch.where(F.col("day") >= since))


def user_features(days: DataFrame, reference: dt.date) -> DataFrame:
    """Per-user features of the 90 days before ``reference`` (exclusive)."""
    start = reference - dt.timedelta(days=LOOKBACK_DAYS)
    short = F.col("day") >= F.lit(reference - dt.timedelta(days=SHORT_DAYS))
    now = F.lit(reference).cast("timestamp")

    def recent(column: str) -> Column:
        return F.when(short, F.col(column)).otherwise(F.lit(0))

    totals = (
        days.where((F.col("day") >= F.lit(start)) & (F.col("day") < F.lit(reference)))
        .groupBy("user_id")
        .agg(
            *[F.max(f"last_{k}").alias(f"last_{k}") for k in _KINDS],
            *[F.sum(recent(f"{k}_count")).alias(f"{k}_count_30d") for k in _KINDS],
            *[F.sum(f"{k}_count").alias(f"{k}_count_90d") for k in _KINDS],
            # users of equal spending must lie on the same side of a limit between them
            exact_sum(recent("spend")).alias("total_spend_30d"),
            exact_sum(F.col("spend")).alias("total_spend_90d"),
        )
    )
    # users who never converted keep a NULL recency instead of an artificial zero
    return totals.withColumns(
        {f"days_since_last_{k}": exact_days(F.col(f"last_{k}"), now) for k in _KINDS}
        | {
            "avg_order_value": ratio("total_spend_30d", "conversion_count_30d"),
            "ctr_30d": ratio("click_count_30d", "impression_count_30d"),
            "cvr_30d": ratio("conversion_count_30d", "click_count_30d"),
        }
    ).drop(*[f"last_{k}" for k in _KINDS])


def with_engagement(features: DataFrame) -> DataFrame:
    return features.withColumn(
        "engagement_score",
        rfm.engagement_score(F.col("ctr_30d"), F.col("cvr_30d"), F.col("impression_count_30d"),
                             F.col("days_since_last_impression")),
    )


def qualified(features: DataFrame, min_impressions: int = MIN_IMPRESSIONS) -> DataFrame:
    return features.where(F.col("impression_count_90d") >= min_impressions)


def rfm_metrics() -> dict[str, Column]:
    return {
        "recency": F.col("days_since_last_conversion"),
        "frequency": F.col("impression_count_90d") + F.col("click_count_90d")
        + F.col("conversion_count_90d"),
        "monetary": F.col("total_spend_90d"),
    }


def rfm_cuts(features: DataFrame, exact: bool = True) -> DataFrame:
    """(metric, probability, value): quintile limits of each RFM metric."""
    return (quantile_cuts if exact else approximate_cuts)(features, rfm_metrics(), QUINTILES)


def with_rfm(features: DataFrame, cuts: DataFrame, separate_cant_lose: bool = False) -> DataFrame:
    """Scores, combined code and tier. The cut points stay in the plan as a scalar subquery."""
    # twelve rows: four limits for each of three metrics
    limits = F.map_from_entries(F.collect_list(F.struct(
        F.concat("metric", F.lit("@"), F.col("probability").cast("string")).alias("k"), "value"
    )))
    bounded = features.withColumn("_limits", cuts.agg(limits.alias("limits")).scalar())
    metrics = rfm_metrics()

    def limit(metric: str) -> list[Column]:
        return [F.try_element_at("_limits", F.lit(f"{metric}@{p}")) for p in QUINTILES]

    scored = bounded.withColumns({
        "recency_score": rfm.descending_score(metrics["recency"], limit("recency")),
        "frequency_score": rfm.ascending_score(metrics["frequency"], limit("frequency")),
        "monetary_score": rfm.ascending_score(metrics["monetary"], limit("monetary")),
    })
    r, f, m = (F.col(f"{n}_score") for n in ("recency", "frequency", "monetary"))
    return scored.withColumns({
        "rfm_score": rfm.rfm_code(r, f, m),
        "rfm_total": r + f + m,
        "tier": rfm.rfm_tier(r, f, m, separate_cant_lose),
    }).drop("_limits")


def segment_sizes(tiers: DataFrame) -> DataFrame:
    sizes = tiers.groupBy("tier").agg(F.count("*").alias("users"))
    return sizes.withColumn("share", share_of_total(sizes, "users"))


def segment_vectors(tiers: DataFrame, features: tuple[str, ...]) -> DataFrame:
    """Mean feature values of each tier, as a map."""
    means = tiers.groupBy("tier").agg(
        F.count("*").alias("user_count"), *[F.avg(c).alias(c) for c in features]
    )
    return means.select(
        "tier", "user_count",
        F.map_from_arrays(F.array(*[F.lit(c) for c in features]), F.array(*features))
        .alias("feature_vector"),
    )


def memberships(tiers: DataFrame, computed_at: Column) -> DataFrame:
    """Users with their tier as segment; the score is the RFM total on a 0..1 scale."""
    return tiers.select(
        "user_id", F.col("tier").alias("segment_id"),
        ((F.col("rfm_total") - 3) / 12).alias("score"),
        computed_at.alias("computed_at"),
    )


def run_daily_segmentation(
    spark: SparkSession, events: DataFrame, day: dt.date, root: str, staging_root: str,
    force_full: bool = False, min_total: int = 1000, separate_cant_lose: bool = False,
    required: tuple[str, ...] | None = None,
) -> DataFrame:
    """Update the per-day state, recompute tiers, validate them and export memberships.

    The first run, Mondays and ``force_full`` rebuild all 90 days, other days the last 7.
    Every tier that the tier order can give is required unless the caller names others.
    Invalid segments are not exported; the ledger tells. Returns the one-row validation.
    """
    if required is None:
        required = tuple(t for t in RFM_TIERS if separate_cant_lose or t != "cant_lose")
    full = force_full or day.weekday() == 0 or not tables.exists(spark, f"{root}/user-days")
    since = day - dt.timedelta(days=LOOKBACK_DAYS if full else PATCH_DAYS)
    ts = F.col("timestamp")
    recent = events.where((ts >= F.lit(since).cast("timestamp")) & (ts < F.lit(day).cast("timestamp")))

    # day partitions are replaced as wholes, and days without events any more go: that is
    # `replace_days` on disk
    state_root = f"{root}/user-days"
    patch = user_days(recent).withColumn("date", F.col("day"))
    patched = [str(since + dt.timedelta(days=i)) for i in range((day - since).days)]
    tables.replace_partitions(patch, state_root, ["date"], {"date": patched})
    start = day - dt.timedelta(days=LOOKBACK_DAYS)
    state = spark.read.schema(patch.schema).parquet(state_root).where(
        (F.col("date") >= F.lit(start)) & (F.col("date") < F.lit(day))
    )

    # written once: cut points, scores and sizes read the table, not the events
    features_root, tiers_root = f"{root}/user-features", f"{root}/segments"
    features = with_engagement(user_features(state, day)).withColumn("date", F.lit(day))
    today = {"date": [str(day)]}
    tables.replace_partitions(features, features_root, ["date"], today)
    users = qualified(spark.read.schema(features.schema).parquet(features_root).where(F.col("date") == F.lit(day)))
    scored = with_rfm(users, rfm_cuts(users), separate_cant_lose)
    tables.replace_partitions(scored, tiers_root, ["date"], today)
    tiers = spark.read.schema(scored.schema).parquet(tiers_root).where(F.col("date") == F.lit(day))

    sizes = segment_sizes(tiers)
    checks = segment_checks(sizes, required, min_total)
    valid = checks.head().is_valid
    if valid:
        computed_at = F.lit(day).cast("timestamp")
        tables.write_memberships(
            tables.membership_entries(memberships(tiers, computed_at), computed_at),
            f"{root}/memberships", day,
        )
    measures = sizes.agg(F.sum("users").alias("users"), F.count("*").alias("segments"))
    tables.append_ledger(
        tables.ledger_entry(measures, "segmentation", day, dt.datetime.combine(day, dt.time()),
                            status="complete" if valid else "invalid"),
        f"{root}/ledger",
    )
    return checks
