"""Time-decayed means as a kept state that is moved forward, not summed anew.

For each key and rate the state holds the weighted sum, the sum of weights and the number of
hours in the window. To move it, both sums shrink by the decay of the time that passed, the
new hours are added and the hours that left the window are taken out with the weight they
have by now. A run thus reads the state and two short spans of hours instead of the window.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from adlumen.functions.decay import HALF_LIFE_HOURS, decay_weight
from adlumen.functions.times import age_hours

#: Hourly rates of ads; an hour without a denominator has none.
RATES = {
    "ctr_decayed": "if(impressions > 0, double(clicks) / impressions, NULL)",
    "cvr_decayed": "if(clicks > 0, double(conversions) / clicks, NULL)",
    "ecpm_decayed": "if(impressions > 0, double(revenue) / impressions * 1000, NULL)",
}


def _parts(hourly: DataFrame, keys: list[str], at: dt.datetime, sign: int, half_life: float) -> DataFrame:
    """What hours add to (or take from) the state at ``at``."""
    age = age_hours(F.col("hour_start"), F.lit(at)) - 1
    weight = decay_weight(age, half_life) * sign
    columns = [F.lit(sign).cast("long").alias("hours")]
    for name, rate in RATES.items():
        known = F.expr(rate).isNotNull()
        columns += [F.when(known, F.expr(rate) * weight).alias(f"{name}_sum"), F.when(known, weight).alias(f"{name}_weight"),
                    F.when(known, F.lit(sign).cast("long")).alias(f"{name}_hours")]
    return hourly.select(*keys, *columns)


def _totals(parts: DataFrame, keys: list[str], at: dt.datetime) -> DataFrame:
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in parts.columns if c not in keys]
    # keys whose last hour left the window are out of the state
    return parts.groupBy(*keys).agg(*sums).where(F.col("hours") > 0).withColumn("as_of", F.lit(at))


def _between(hourly: DataFrame, low: dt.datetime, high: dt.datetime) -> DataFrame:
    return hourly.where((F.col("hour_start") >= F.lit(low)) & (F.col("hour_start") < F.lit(high)))


def start(hourly: DataFrame, keys: list[str], at: dt.datetime, window_hours: int = 24, half_life: float = HALF_LIFE_HOURS) -> DataFrame:
    """The state at ``at``, on the hour, from the hours of the window before it."""
    return _totals(_parts(_between(hourly, at - dt.timedelta(hours=window_hours), at), keys, at, 1, half_life), keys, at)


def advance(state: DataFrame, hourly: DataFrame, keys: list[str], since: dt.datetime, at: dt.datetime,
            window_hours: int = 24, half_life: float = HALF_LIFE_HOURS) -> DataFrame:
    """The state of ``since`` moved to ``at``; equal to :func:`start` there up to rounding.

    ``hourly`` must hold the hours from one window before ``since`` on as they were when the
    state was made; late changes to them call for a new start. Unknown (null) keys are kept
    like any other.
    """
    if at < since:
        raise ValueError("a state moves forward only")
    span = dt.timedelta(hours=window_hours)
    passed = decay_weight(F.lit((at - since).total_seconds() / 3600), half_life)
    old = state.select(*keys, "hours", *[
        (F.col(f"{n}_{c}") * passed if c != "hours" else F.col(f"{n}_{c}")).alias(f"{n}_{c}")
        for n in RATES for c in ("sum", "weight", "hours")])
    new = _parts(_between(hourly, max(since, at - span), at), keys, at, 1, half_life)
    gone = _parts(_between(hourly, since - span, min(at - span, since)), keys, at, -1, half_life)
    return _totals(old.unionByName(new).unionByName(gone), keys, at)


def means(state: DataFrame, keys: list[str]) -> DataFrame:
    """Decayed means of every key; 0.0 for a rate that no hour of the window has."""
    def mean(name: str) -> Column:
        return F.when(F.col(f"{name}_hours") > 0, F.col(f"{name}_sum") / F.col(f"{name}_weight")).otherwise(F.lit(0.0)).alias(name)

    return state.select(*keys, "as_of", *[mean(n) for n in RATES])
