"""Ranking features of ads.

Events are scanned once into hourly counts per ad. Windows, decayed means and rolling
series are all re-sums of that small table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from adlumen.functions.decay import decayed_mean
from adlumen.functions.rates import per_mille, ratio, smoothed_ctr, smoothed_cvr
from adlumen.functions.times import age_hours
from adlumen.operators.aggregate import hourly_counts
from adlumen.operators.decay_state import RATES
from adlumen.operators.joins import latest_by_key
from adlumen.operators.validation import feature_rules, with_errors
from adlumen.schemas import FEATURE_NAMES, FEATURE_VERSION
from adlumen.sinks.tables import write_features

WINDOWS = (1, 6, 24)


def window_counts(
    hourly: DataFrame, keys: list[str], anchor: Column, half_life_hours: float = 6.0
) -> DataFrame:
    """Counts, revenue and decayed rates of the 24 hours before ``anchor``.

    ``anchor`` is on the hour: a literal for one run, or derived from ``hour_start`` to
    compute many runs in one pass (each hour must then belong to one anchor). Windows
    are half-open: [anchor − w, anchor). The age of an hour's rate is counted from the
    end of that hour, and hours without a denominator carry no rate.
    """
    rows = hourly.withColumn("anchor", anchor).withColumn(
        "hours_ago", age_hours(F.col("hour_start"), F.col("anchor"))
    ).where((F.col("hours_ago") > 0) & (F.col("hours_ago") <= max(WINDOWS)))

    def total(metric: str, hours: int) -> Column:
        return F.expr(f"sum(if(hours_ago <= {hours}, {metric}, 0)) AS {metric}_{hours}h")

    age = F.expr("hours_ago - 1")
    return rows.groupBy(*keys, "anchor").agg(
        *[total(m, h) for m in ("impressions", "clicks", "conversions") for h in WINDOWS],
        *[total(m, h) for m in ("revenue", "spend") for h in (1, 24)],
        *[decayed_mean(F.expr(rate), age, half_life_hours).alias(n) for n, rate in RATES.items()],
    )


def with_rates(counts: DataFrame, smoothed: bool = True, **smoothing) -> DataFrame:
    ctr = {h: (f"clicks_{h}h", f"impressions_{h}h") for h in WINDOWS}
    cvr = {h: (f"conversions_{h}h", f"clicks_{h}h") for h in WINDOWS}
    if smoothed:
        rates = {f"ctr_{h}h": smoothed_ctr(*v, **smoothing) for h, v in ctr.items()} | {
            f"cvr_{h}h": smoothed_cvr(*v, **smoothing) for h, v in cvr.items()}
    else:
        rates = {f"ctr_{h}h": ratio(*v) for h, v in ctr.items()} | {
            f"cvr_{h}h": ratio(*v) for h, v in cvr.items()}
    ecpm = {f"ecpm_{h}h": per_mille(f"revenue_{h}h", f"impressions_{h}h") for h in (1, 24)}
    return counts.withColumns(rates | ecpm)


def with_budget(counts: DataFrame, bids: DataFrame, order: Column) -> DataFrame:
    """Budget and pacing from the latest bid row of each ad.

    Utilisation is the day's spend over spend plus what is left; without a bid row it is
    0 and pacing is neutral.
    """
    latest = latest_by_key(bids, "ad_id", order, ["budget_remaining", "pacing_factor"])
    joined = counts.join(latest, "ad_id", "left")
    spent, left = F.col("spend_24h"), F.col("budget_remaining")
    return joined.withColumns({
        "budget_utilization": F.coalesce(ratio(spent, spent + left), F.lit(0.0)),
        "pacing_factor": F.coalesce("pacing_factor", F.lit(1.0)),
    })


def feature_vector(features: DataFrame, *ids: str) -> DataFrame:
    """The 16 model inputs in fixed order, as an array and as a map."""
    logs = {f"{m}_24h_log": F.log1p(f"{m}_24h") for m in ("impressions", "clicks", "conversions")}
    values = F.expr(f"array({', '.join(f'double({n})' for n in FEATURE_NAMES)})")
    names = F.lit(list(FEATURE_NAMES))
    return features.withColumns(logs).select(
        *ids, names.alias("feature_names"), values.alias("feature_values"),
        F.map_from_arrays(names, values).alias("features"),
        F.lit(FEATURE_VERSION).alias("version"),
    )


def feature_anomalies(features: DataFrame) -> DataFrame:
    return with_errors(features, feature_rules()).withColumnRenamed("errors", "anomalies")


def vector_anomalies(vectors: DataFrame) -> DataFrame:
    """Anomalies of stored vectors; counts are recovered from their logarithms."""
    value = {n: f"features['{n}']" for n in ("ctr_24h", "cvr_24h", "ecpm_24h")} | {
        f"{m}_24h": f"round(expm1(features['{m}_24h_log']))" for m in ("impressions", "clicks")}
    return feature_anomalies(vectors.selectExpr("ad_id", *[f"{e} AS {n}" for n, e in value.items()]))


def run_hourly_features(
    events: DataFrame, bids: DataFrame, bid_order: Column, hour: dt.datetime, root: str,
    exported_at: dt.datetime,
) -> DataFrame:
    """Features of all ads for the run at ``hour``; returns those with anomalies."""
    since = hour - dt.timedelta(hours=max(WINDOWS))
    ts = F.col("timestamp")
    recent = events.where((ts >= F.lit(since)) & (ts < F.lit(hour)))
    counts = window_counts(hourly_counts(recent, "ad_id"), ["ad_id"], F.lit(hour))
    known = bids.where(ts < F.lit(hour))
    features = with_rates(with_budget(counts, known, bid_order))
    stored = write_features(feature_vector(features, "ad_id"), root, hour, exported_at)
    return vector_anomalies(stored).where(F.size("anomalies") > 0)
