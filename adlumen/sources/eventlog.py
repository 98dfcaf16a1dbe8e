"""Adapters that read general tables as ad-system tables.

The event log (event_id, ts, user_id, event_type, value, props) carries the ad id in
``props.k``; the hierarchy above an ad follows from the id. Order lines stand in for
bid-side rows and orders for stored files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from adlumen.functions import storage as st
from adlumen.schemas import HIERARCHY

UNKNOWN_ID = -1

# Names of the log's event types in the ad vocabulary.
LOG_EVENT_TYPES = {
    "view": "impression", "click": "click", "purchase": "conversion", "signup": "engagement",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


_TYPE_SQL = (
    "CASE event_type "
    + " ".join(f"WHEN '{source}' THEN '{target}'" for source, target in LOG_EVENT_TYPES.items())
    + " ELSE event_type END"
)


def ad_columns(log: DataFrame) -> DataFrame:
    """Log rows (batch or stream) as ad events; unknown types pass through unchanged.

    Event times are stored without a zone and are UTC by convention.
    """
    return log.withColumn("_k", F.expr("cast(get_json_object(props, '$.k') AS bigint)")).selectExpr(
        "event_id",
        f"{_TYPE_SQL} AS event_type",
        "cast(ts AS timestamp) AS timestamp",
        "user_id",
        "_k AS ad_id",
        "_k div 2 AS adset_id",
        "_k div 10 AS campaign_id",
        "_k div 20 AS advertiser_id",
        "_k % 7 AS publisher_id",
        "_k % 13 AS placement_id",
        "element_at(array('mobile', 'desktop', 'tablet', 'ctv', 'smartwatch'),"
        " cast(user_id % 5 AS int) + 1) AS device_type",
        "element_at(array('us', 'De', 'FR', NULL), cast(user_id % 4 AS int) + 1) AS country_code",
        "if(event_type = 'purchase', value, 0.0D) AS revenue",
        "if(event_type IN ('view', 'click'), value * 0.01D, 0.0D) AS cost",
        "props AS metadata",
    )


def all_events(spark: SparkSession, folder: str) -> DataFrame:
    """Every row of the log, with the hierarchy filled in."""
    return _with_hierarchy(ad_columns(table(spark, folder, "events")))


def _with_hierarchy(events: DataFrame) -> DataFrame:
    return events.withColumns({c: F.coalesce(c, F.lit(UNKNOWN_ID)) for c in HIERARCHY})


def ad_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events of a known type, for reports, with the hierarchy filled in.

    An event without an ad belongs to ad -1. With ids that cannot be NULL a join adds no
    null filter of its own, so branches of a plan stay alike and can share a shuffle, and
    the payload is parsed once per row.
    """
    log = table(spark, folder, "events")
    return _with_hierarchy(ad_columns(log.where(F.col("event_type").isin(*LOG_EVENT_TYPES))))


def ad_names(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("ad_id"), F.col("p_name").alias("ad_name")
    )


def bid_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as demand-side rows: budget left and pacing per ad over time."""
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_shipdate").cast("timestamp").alias("timestamp"),
        F.expr("l_partkey % 100").alias("ad_id"),
        (F.col("l_extendedprice") / 1000).alias("bid_price"),
        (F.col("l_extendedprice") / 1000 * (1 - F.col("l_discount"))).alias("clearing_price"),
        F.col("l_extendedprice").alias("budget_remaining"),
        (F.col("l_tax") * 30).alias("pacing_factor"),
    )


def stored_files(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as stored files: one file per order in the partition of its day."""
    orders = table(spark, folder, "orders").withColumn("day", F.to_date("o_orderdate"))
    prefix = F.concat(
        F.lit("events/"), st.partition_prefix(F.year("day"), F.month("day"), F.dayofmonth("day")),
        F.lit("/"),
    )
    return orders.select(
        F.col("o_orderkey").alias("file_id"),
        prefix.alias("prefix"),
        F.concat(prefix, F.lit("part-"), F.col("o_orderkey").cast("string"), F.lit(".parquet"))
        .alias("path"),
        F.concat(F.lit("part-"), F.col("o_orderkey").cast("string"), F.lit(".parquet")).alias("name"),
        (F.col("o_totalprice") * 1000).cast("long").alias("size"),
        F.col("o_orderdate").cast("timestamp").alias("modified"),
        "day",
        F.col("o_orderstatus").alias("status"),
    )


def file_accesses(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as reads of the order's file."""
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("file_id"), F.col("l_shipdate").cast("timestamp").alias("accessed")
    )
