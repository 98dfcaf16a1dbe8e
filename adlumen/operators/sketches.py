"""Quantiles from kept sketches: one small state a day, merged for any span of days.

The cut points of a long window need no second look at its rows: a day's rows are sketched
once, and a run merges the states of the days it covers. Ranks are off by a bounded share
of all values, with a probability that the sketch states for its size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Size of a sketch (2 ** 8 is a few kilobytes), and the share of values by which a rank
#: may be off at that size: 99 of 100 times at most for a single quantile.
SIZE, RANK_ERROR = 256, 0.0133


def quantile_states(df: DataFrame, metrics: dict[str, Column], *keys: str, size: int = SIZE) -> DataFrame:
    """Rows (*keys, metric, sketch, n): the mergeable state of each key, such as a day.

    NULLs are left out; a metric without values in a key has no row. Sketches are built in
    the map tasks and merged after the shuffle, so a key with most rows stays small.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), v.cast("double").alias("value")) for m, v in metrics.items()]))
    rows = df.select(*keys, pairs.alias("p")).select(*keys, "p.metric", "p.value").where(F.col("value").isNotNull())
    return rows.groupBy(*keys, "metric").agg(
        F.kll_sketch_agg_double("value", size).alias("sketch"), F.count(F.lit(1)).alias("n"))


def merged_cuts(states: DataFrame, probabilities: list[float], *keys: str, size: int = SIZE) -> DataFrame:
    """Rows (*keys, metric, probability, value, n) from all states of a key; no key: of all."""
    merged = states.groupBy(*keys, "metric").agg(F.kll_merge_agg_double("sketch", size).alias("sketch"), F.sum("n").alias("n"))
    cuts = F.explode(F.array(*[
        F.struct(F.lit(float(p)).alias("probability"), F.expr(f"kll_sketch_get_quantile_double(sketch, {float(p)}D)").alias("value"))
        for p in probabilities]))
    return merged.select(*keys, "metric", cuts.alias("c"), "n").select(*keys, "metric", "c.probability", "c.value", "n")


def rank_errors(cuts: DataFrame, df: DataFrame, metrics: dict[str, Column], *keys: str) -> DataFrame:
    """``cuts`` with ``rank_error``: how far the share of values up to each cut is from its probability.

    With repeated values the share is a span, from those below to those up to the cut; the
    error is the distance to that span. A few cuts are met with counts, not with each other.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), v.cast("double").alias("v")) for m, v in metrics.items()]))
    rows = df.select(*keys, pairs.alias("p")).select(*keys, "p.metric", "p.v").where(F.col("v").isNotNull())
    limits = cuts.groupBy(*keys, "metric").agg(F.collect_list(F.struct("probability", "value")).alias("cuts"))
    met = rows.join(limits, [*keys, "metric"]).select(*keys, "metric", "v", F.explode("cuts").alias("c"))
    shares = met.groupBy(*keys, "metric", F.col("c.probability").alias("probability")).agg(
        F.avg((F.col("v") < F.col("c.value")).cast("double")).alias("below"),
        F.avg((F.col("v") <= F.col("c.value")).cast("double")).alias("upto"))
    p = F.col("probability")
    return cuts.join(shares, [*keys, "metric", "probability"]).withColumn(
        "rank_error", F.greatest(F.lit(0.0), F.col("below") - p, p - F.col("upto"))).drop("below", "upto")
