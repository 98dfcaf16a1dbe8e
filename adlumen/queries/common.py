"""Shared pieces of the registered queries."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from adlumen.session import pin_utc

DIGITS, EXTRA = 6, 3
#: Day after which no event of the log lies within the last 7 days, so that the 7-, 30-
#: and 90-day windows all differ.
USER_REFERENCE = dt.date(2024, 2, 10)
FILE_REFERENCE = dt.datetime(2001, 8, 10)


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Half-up to a fixed number of digits.

    The last bits of a sum depend on row order. A first, finer rounding removes them, so
    that a value halfway between two results goes the same way in any engine.
    """
    return df.selectExpr(*[
        f"round(round(`{f.name}`, {digits + EXTRA}), {digits}) + 0.0D AS `{f.name}`"
        if f.dataType.typeName() in ("double", "float") else f"`{f.name}`"
        for f in df.schema.fields
    ])


def decimal_round(sql: str) -> str:
    """Read ``round(x, n)`` in a query as decimal half-up rounding, like :func:`rounded`."""
    out, at = [], 0
    for found in re.finditer(r"\bround\(", sql):
        if found.start() < at:
            raise ValueError("nested round")
        depth, end = 1, found.end()
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        value, digits = sql[found.end():end - 1].rsplit(",", 1)
        out += [sql[at:found.start()],
                f"CAST(round(CAST({value} AS DECIMAL(38, {int(digits) + EXTRA})),{digits}) AS DOUBLE)"]
        at = end
    return "".join([*out, sql[at:]])


def joined(array: str | Column) -> Column:
    return F.array_join(F.array_sort(array), ",")


def _dates_as_text(df: DataFrame) -> DataFrame:
    return df.selectExpr(*[
        f"cast(`{f.name}` AS string) AS `{f.name}`" if f.dataType.typeName() == "date" else f"`{f.name}`"
        for f in df.schema.fields
    ])


def query(registry: dict) -> Callable:
    """Register a function under its own name, with UTC pinned for the session."""

    def register(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            pin_utc(spark)
            return _dates_as_text(fn(spark, folder.rstrip("/")))

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        registry[fn.__name__] = run
        return fn

    return register


# ---- SQL pieces --------------------------------------------------------------

#: All rows of the log; reports take those of a known type.
ALL_AD = """ad AS (
  SELECT event_id,
         CASE event_type WHEN 'view' THEN 'impression' WHEN 'purchase' THEN 'conversion'
                         WHEN 'signup' THEN 'engagement' ELSE event_type END AS event_type,
         ts, user_id,
         coalesce(k, -1) AS ad_id, coalesce(k // 2, -1) AS adset_id,
         coalesce(k // 10, -1) AS campaign_id, coalesce(k // 20, -1) AS advertiser_id,
         CASE WHEN event_type = 'purchase' THEN value ELSE 0 END AS revenue,
         CASE WHEN event_type IN ('view', 'click') THEN value * 0.01 ELSE 0 END AS cost
  FROM (SELECT *, CAST(props ->> '$.k' AS BIGINT) AS k FROM events))"""""

AD = ALL_AD.removesuffix(")") + "\n  WHERE event_type IN ('view', 'click', 'purchase', 'signup'))"

COUNTS = """count(*) FILTER (event_type = 'impression') AS impressions,
       count(*) FILTER (event_type = 'click') AS clicks,
       count(*) FILTER (event_type = 'conversion') AS conversions,
       count(*) FILTER (event_type = 'view') AS views,
       sum(cost) AS spend, sum(revenue) AS revenue"""

SUMS = """CAST(sum(impressions) AS BIGINT) AS impressions, CAST(sum(clicks) AS BIGINT) AS clicks,
       CAST(sum(conversions) AS BIGINT) AS conversions, CAST(sum(views) AS BIGINT) AS views,
       sum(spend) AS spend, sum(revenue) AS revenue"""

FACTS = f"""{AD},
facts AS (SELECT advertiser_id, campaign_id, adset_id, ad_id, CAST(ts AS DATE) AS report_date,
       {COUNTS} FROM ad GROUP BY ALL)"""

METRICS_OUT = "impressions, clicks, conversions, views, round(spend, 6) AS spend, round(revenue, 6) AS revenue"


def sql_ratio(num: str, den: str, scale: str = "") -> str:
    return f"CASE WHEN {den} > 0 THEN CAST({num} AS DOUBLE) / {den}{scale} ELSE 0.0 END"


KPIS_OUT = ",\n       ".join(
    f"round({sql_ratio(n, d, s)}, 6) AS {name}"
    for name, n, d, s in [
        ("ctr", "clicks", "impressions", ""), ("cvr", "conversions", "clicks", ""),
        ("cpa", "spend", "conversions", ""), ("cpc", "spend", "clicks", ""),
        ("cpm", "spend", "impressions", " * 1000"), ("roas", "revenue", "spend", ""),
        ("ecpm", "revenue", "impressions", " * 1000"),
    ]
)
