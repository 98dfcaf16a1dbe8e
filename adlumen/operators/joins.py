"""Joins the jobs need.

No side is broadcast by hint here: dimension and state tables grow with the number of
ads or users, so the choice is left to Spark's size check. Facts are aggregated to the
join key first, which leaves both sides with unique keys and nothing to skew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from adlumen.functions.rates import ratio

_PARTITION_KEYS = ["year", "month", "day", "hour", "event_type"]


def expected_partitions(days: DataFrame, event_types: tuple[str, ...]) -> DataFrame:
    """Every (hour, event type) of the given days: columns year, month, day, hour, event_type."""
    return (
        days.select(
            F.year("day").alias("year"), F.month("day").alias("month"),
            F.dayofmonth("day").alias("day"),
            F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour"),
        )
        .withColumn("event_type", F.explode(F.array(*[F.lit(t) for t in event_types])))
    )


def pending_partitions(expected: DataFrame, existing: DataFrame) -> DataFrame:
    return expected.join(existing, _PARTITION_KEYS, "left_anti")


def finished_partitions(expected: DataFrame, existing: DataFrame) -> DataFrame:
    return expected.join(existing, _PARTITION_KEYS, "left_semi")


def attach_names(facts: DataFrame, names: DataFrame, key: str) -> DataFrame:
    """Left join a dimension with one row per key."""
    return facts.join(names, key, "left")


def latest_by_key(df: DataFrame, key: str, order: Column, columns: list[str]) -> DataFrame:
    """Values of the most recent row per key, combined map-side."""
    picked = F.max_by(F.struct(*columns), order).alias("_latest")
    return df.groupBy(key).agg(picked).select(key, *[F.col(f"_latest.{c}").alias(c) for c in columns])


def lookup_sizes(plan: DataFrame, inventory: DataFrame) -> DataFrame:
    """Planned files with their listed size; files no longer listed count as 0 bytes."""
    sizes = inventory.select("path", F.col("size").alias("_size"))
    return (
        plan.join(sizes, "path", "left")
        .withColumn("size", F.coalesce("_size", F.lit(0)))
        .drop("_size")
    )


def fold_state(previous: DataFrame, update: DataFrame, key: str) -> DataFrame:
    """New values over old ones; keys present on either side survive."""
    columns = [c for c in previous.columns if c != key]
    old, new = previous.alias("o"), update.alias("n")
    merged = [F.coalesce(f"n.{c}", f"o.{c}").alias(c) for c in columns]
    return old.join(new, key, "full_outer").select(key, *merged)


def compare_counts(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Row counts per partition on both sides of a rewrite."""
    b = before.groupBy(*keys).agg(F.count("*").alias("input_rows"))
    a = after.groupBy(*keys).agg(F.count("*").alias("output_rows"))
    return (
        b.join(a, keys, "full_outer")
        .na.fill(0, ["input_rows", "output_rows"])
        .withColumns({
            "processing_ratio": ratio("output_rows", "input_rows"),
            "verified": F.col("input_rows") == F.col("output_rows"),
        })
    )
