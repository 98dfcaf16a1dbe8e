"""Last-touch attribution between two streams: an interval join with a window for each conversion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

OWN_WINDOW = "attribution_window_days"


def attribute(touches: DataFrame, conversions: DataFrame, keys: list[str], delay: str,
              max_window_days: int, window_days: int = 7) -> DataFrame:
    """Latest click and impression at or before each conversion, within its own window.

    The stream twin of :func:`adlumen.operators.attribution.attribute_conversions`: the
    same rows, each once the watermark has passed its conversion. ``touches`` and
    ``conversions`` are streams of (event_id, event_type, timestamp, ad_id, *keys), the
    conversions also with revenue and, if they have one, their ``attribution_window_days``
    (null: ``window_days``). ``delay`` is how late rows of either may be.

    State is bounded by time: a touch is kept for ``max_window_days``, a conversion until
    no touch of its past can come any more. A conversion's window beyond that maximum
    would need touches that are gone, so it is cut to it. Conversions without a known key
    meet nothing and come without credit.
    """
    own = F.coalesce(F.col(OWN_WINDOW), F.lit(window_days)) if OWN_WINDOW in conversions.columns else F.lit(window_days)
    c = conversions.select(
        F.col("event_id").alias("conversion_id"), F.col("timestamp").alias("conversion_ts"),
        F.col("ad_id").alias("_ad_id"), "revenue", F.least(own, F.lit(max_window_days)).alias("_days"),
        *[F.col(k).alias(f"_{k}") for k in keys if k != "ad_id"]).withWatermark("conversion_ts", delay)
    t = touches.where(F.col("event_type").isin("impression", "click")).select(
        F.col("event_id").alias("touch_id"), F.col("event_type").alias("touch_type"), F.col("timestamp").alias("touch_ts"),
        "ad_id", *[k for k in keys if k != "ad_id"]).withWatermark("touch_ts", delay)
    same = [F.col(k) == F.col(f"_{k}") for k in keys]
    # the constant interval lets state go; the conversion's own window is judged beside it
    interval = F.expr(f"touch_ts <= conversion_ts AND touch_ts >= conversion_ts - INTERVAL {int(max_window_days)} DAYS "
                      "AND unix_micros(conversion_ts) - unix_micros(touch_ts) <= _days * 86400000000L")
    met = c.join(t, [*same, interval], "left_outer")

    def latest(kind: str) -> Column:
        return F.max(F.when(F.col("touch_type") == kind, F.struct("touch_ts", "touch_id", "ad_id"))).alias(kind)

    carried = ["conversion_id", "conversion_ts", "_ad_id", "revenue", *[f"_{k}" for k in keys if k != "ad_id"]]
    found = met.groupBy(*carried).agg(latest("click"), latest("impression"))
    credited = F.coalesce("click", "impression")
    return found.select(
        "conversion_id", *[F.col(f"_{k}").alias(k) for k in keys], "conversion_ts",
        F.col("click.touch_ts").alias("click_ts"), F.col("impression.touch_ts").alias("impression_ts"),
        credited["ad_id"].alias("credited_ad_id"),
        (F.col("click").isNull() & F.col("impression").isNotNull()).alias("is_view_through"), "revenue")
