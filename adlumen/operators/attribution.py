"""Last-touch attribution: an as-of join in time buckets.

Carrying the last touch forward with one window per user would sort a busy user's whole
history in one task. Instead time is cut into short buckets. Inside a bucket a window
finds earlier touches; across buckets only one summary row per (key, bucket) is carried.
A key with a third of all rows is thus spread over as many tasks as it has buckets.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

_DAY_MICROS = 86_400_000_000
_ANONYMOUS_SPLIT = 4096
_OWN_WINDOW = "attribution_window_days"


def _touch(kind: str) -> Column:
    return F.when(
        (F.col("event_type") == kind) & F.col("known"), F.struct("timestamp", "event_id", "ad_id")
    )


def attribute_conversions(
    events: DataFrame,
    keys: list[str],
    window_days: int = 7,
    bucket_seconds: int = 900,
) -> DataFrame:
    """Latest click and impression at or before each conversion, within the window.

    The window is that of the conversion's ``attribution_window_days``; where this is null
    or no such column exists, it is ``window_days``.
    Credit goes to the click; without one, to the impression (view-through). A conversion
    with an unknown key is returned without credit; such rows are spread by a salt, so
    anonymous traffic forms no large group.
    """
    known = reduce(and_, [F.col(k).isNotNull() for k in keys])
    salt = F.when(known, F.lit(0)).otherwise(F.pmod(F.xxhash64("event_id"), F.lit(_ANONYMOUS_SPLIT)))
    # a column for it only where rows differ
    own = {"window_days": F.coalesce(F.col(_OWN_WINDOW), F.lit(window_days))} if _OWN_WINDOW in events.columns else {}
    micros = F.col("window_days") * F.lit(_DAY_MICROS) if own else F.lit(window_days * _DAY_MICROS)
    rows = events.where(F.col("event_type").isin("impression", "click", "conversion")).select(
        "event_id", "event_type", "timestamp", "ad_id", "revenue",
        *[k for k in keys if k != "ad_id"],
        F.floor(F.unix_seconds("timestamp") / bucket_seconds).alias("bucket"),
        salt.alias("salt"), known.alias("known"), *[c.alias(name) for name, c in own.items()],
    )

    def latest(carried: str, here: str) -> Column:
        # touches of this bucket are later than anything carried in
        found = F.coalesce(here, carried)
        age = F.unix_micros("timestamp") - F.unix_micros(found["timestamp"])
        return F.when(age <= micros, found)

    earlier = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        rows.where("known").groupBy(*keys, "bucket")
        .agg(F.max(_touch("click")).alias("c"), F.max(_touch("impression")).alias("i"),
             F.count_if(F.col("event_type") == "conversion").alias("conversions"))
        .withColumns({"carried_click": F.max("c").over(earlier),
                      "carried_view": F.max("i").over(earlier)})
        .where(F.col("conversions") > 0)
        .select(*keys, "bucket", "carried_click", "carried_view")
    )
    # a RANGE frame, so touches at the very moment of the conversion count
    inside = (
        Window.partitionBy(*keys, "bucket", "salt").orderBy("timestamp")
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    conversions = (
        rows.withColumns({"click_here": F.max(_touch("click")).over(inside),
                          "view_here": F.max(_touch("impression")).over(inside)})
        .where(F.col("event_type") == "conversion")
    )
    joined = conversions.join(carried, [*keys, "bucket"], "left").withColumns({
        "click": latest("carried_click", "click_here"),
        "view": latest("carried_view", "view_here"),
    })
    credited = F.coalesce("click", "view")
    return joined.select(
        F.col("event_id").alias("conversion_id"),
        *keys,
        F.col("timestamp").alias("conversion_ts"),
        F.col("click.timestamp").alias("click_ts"),
        F.col("view.timestamp").alias("impression_ts"),
        credited["ad_id"].alias("credited_ad_id"),
        (F.col("click").isNull() & F.col("view").isNotNull()).alias("is_view_through"),
        "revenue",
    )
