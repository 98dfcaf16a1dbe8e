"""Validation and data-quality queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from adlumen import schemas as S
from adlumen.functions.text import EMAIL_LOCAL_LENGTH, EMAIL_PATTERN, is_email
from adlumen.operators import quality as ops, validation as val
from adlumen.queries.common import AD, joined, query, rounded
from adlumen.sinks.tables import ledger_entry, ledger_gauges
from adlumen.sources import eventlog as log, events as sources

QUERIES: dict = {}
SQL: dict[str, str] = {}


def _all_log_rows(spark, folder):
    """Every row of the log, including the types the ad vocabulary does not know."""
    rows = log.ad_columns(log.table(spark, folder, "events"))
    return rows.withColumns({
        "session_id": F.lit(None).cast("string"), "platform": F.lit(None).cast("string")})


def _raw_sql():
    return """raw AS (SELECT event_id, CASE event_type WHEN 'view' THEN 'impression'
    WHEN 'purchase' THEN 'conversion' WHEN 'signup' THEN 'engagement' ELSE event_type END AS event_type,
  ts, user_id, CAST(props ->> '$.k' AS BIGINT) AS ad_id,
  ['mobile', 'desktop', 'tablet', 'ctv', 'smartwatch'][CAST(user_id % 5 AS INTEGER) + 1] AS device_type,
  ['us', 'De', 'FR', NULL][CAST(user_id % 4 AS INTEGER) + 1] AS country_code,
  CASE WHEN event_type = 'purchase' THEN value ELSE 0 END AS revenue,
  CASE WHEN event_type IN ('view', 'click') THEN value * 0.01 ELSE 0 END AS cost FROM events)"""


_KNOWN = "('impression', 'click', 'conversion', 'engagement')"


@query(QUERIES)
def event_validation(spark, folder):
    """Broken rules with their row counts."""
    return val.error_counts(_all_log_rows(spark, folder), val.ad_event_rules(), "event_type")


SQL["event_validation"] = f"""WITH {_raw_sql()}
SELECT event_type, 'unknown_event_type' AS error, count(*) AS rows FROM raw
 WHERE event_type NOT IN {_KNOWN} GROUP BY ALL
UNION ALL SELECT event_type, 'unknown_device_type', count(*) FROM raw
 WHERE device_type = 'smartwatch' GROUP BY ALL"""


@query(QUERIES)
def quarantine(spark, folder):
    """Valid and rejected rows per event type."""
    checked = val.with_errors(_all_log_rows(spark, folder), val.ad_event_rules())
    return checked.groupBy("event_type", (F.size("errors") == 0).alias("valid")).agg(
        F.count("*").alias("rows"))


SQL["quarantine"] = f"""WITH {_raw_sql()}
SELECT event_type, event_type IN {_KNOWN} AND device_type <> 'smartwatch' AS valid, count(*) AS rows
FROM raw GROUP BY ALL"""


@query(QUERIES)
def normalise_events(spark, folder):
    rows = val.normalise(_all_log_rows(spark, folder), S.AD_EVENT_DEFAULTS)
    return rounded(rows.select("event_id", "event_type", "device_type", "country_code", "revenue", "cost"))


SQL["normalise_events"] = f"""WITH {_raw_sql()}
SELECT event_id, event_type, device_type, upper(coalesce(country_code, 'US')) AS country_code,
       round(revenue, 6) AS revenue, round(cost, 6) AS cost FROM raw"""


def _base_fields(event_type):
    """Constant base fields of rows whose checks concern the extra columns."""
    text = {c: F.lit("x") for c in ("campaign_id", "adset_id", "advertiser_id", "publisher_id", "placement_id")}
    return text | {
        "event_type": F.lit(event_type), "device_type": F.lit("desktop"),
        "revenue": F.lit(0.0), "cost": F.lit(0.0)}


@query(QUERIES)
def ssp_validation(spark, folder):
    """Orders as supply-side rows; broken rules per order status."""
    orders = log.table(spark, folder, "orders")
    rows = orders.withColumns(_base_fields("bid_request") | {
        "event_id": F.col("o_orderkey"), "timestamp": F.col("o_orderdate"),
        "ad_id": F.col("o_custkey"), "auction_id": F.col("o_orderkey"),
        "floor_price": F.col("o_totalprice") - 2000,
        "winning_bid": F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice") - 5000),
        "viewability_score": F.col("o_totalprice") / 450_000})
    return val.error_counts(rows, val.ssp_event_rules(), "o_orderstatus")


SQL["ssp_validation"] = """
SELECT o_orderstatus, 'negative_floor_price' AS error, count(*) AS rows FROM orders
 WHERE o_totalprice < 2000 GROUP BY ALL
UNION ALL SELECT o_orderstatus, 'negative_winning_bid', count(*) FROM orders
 WHERE o_orderstatus = 'F' AND o_totalprice < 5000 GROUP BY ALL
UNION ALL SELECT o_orderstatus, 'viewability_score_out_of_range', count(*) FROM orders
 WHERE o_totalprice > 450000 GROUP BY ALL"""


@query(QUERIES)
def dsp_validation(spark, folder):
    """Order lines as demand-side rows; pacing above 2 is rejected."""
    rows = log.bid_rows(spark, folder).withColumns(_base_fields("bid_response") | {
        "event_id": F.col("order_id")})
    return val.error_counts(rows, val.dsp_event_rules(), "ad_id")


SQL["dsp_validation"] = """SELECT l_partkey % 100 AS ad_id, 'pacing_factor_out_of_range' AS error,
  count(*) AS rows FROM lineitem WHERE l_tax * 30 > 2 GROUP BY ALL"""


@query(QUERIES)
def action_validation(spark, folder):
    """Customers' balances as action values; negative ones are rejected."""
    customers = log.table(spark, folder, "customer")
    rows = customers.withColumns(
        {c: F.lit("x") for c in ("campaign_id", "advertiser_id", "action_type", "ad_id")}
        | {"action_id": F.col("c_custkey"), "user_id": F.col("c_name"),
           "action_timestamp": F.lit(dt.datetime(2024, 1, 1)), "revenue_value": F.col("c_acctbal")})
    return val.error_counts(rows, val.user_action_rules(), "c_mktsegment")


SQL["action_validation"] = """SELECT c_mktsegment, 'negative_revenue_value' AS error, count(*) AS rows
FROM customer WHERE c_acctbal < 0 GROUP BY ALL"""


def _with_nulls(spark, folder):
    """Events with identifiers masked for some devices, so that grades differ."""
    rows = _all_log_rows(spark, folder)
    device = F.col("device_type")
    return rows.withColumns({
        "user_id": F.when(device != "mobile", F.col("user_id")),
        "campaign_id": F.when(device.isin("tablet", "ctv"), F.col("campaign_id")),
        "ad_id": F.when(~((device == "ctv") & (F.col("event_type") == "click")), F.col("ad_id")),
    })


_MASKED = f"""{_raw_sql()},
masked AS (SELECT event_type, CASE WHEN device_type <> 'mobile' THEN user_id END AS user_id,
  CASE WHEN device_type IN ('tablet', 'ctv') THEN ad_id // 10 END AS campaign_id,
  CASE WHEN NOT (device_type = 'ctv' AND event_type = 'click') THEN ad_id END AS ad_id,
  revenue, cost FROM raw)"""


@query(QUERIES)
def null_grades(spark, folder):
    return rounded(ops.null_grades(_with_nulls(spark, folder)))


_GRADED = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", 100.0 * count(*) FILTER ({c} IS NULL) / count(*) AS null_pct FROM masked"
    for c in ("user_id", "campaign_id", "ad_id", "event_type"))
SQL["null_grades"] = f"""WITH {_MASKED}, g AS ({_GRADED})
SELECT "column", round(null_pct, 6) AS null_pct, CASE WHEN null_pct > 50 THEN 'critical'
  WHEN null_pct > 20 THEN 'warning' WHEN null_pct > 5 THEN 'minor' ELSE 'ok' END AS grade FROM g"""


def _checks():
    return [
        ops.Check("enough_rows", "row_count", threshold=500),
        ops.Check("users_known", "null_ratio", column="user_id", threshold=0.1, warning_only=True),
        ops.Check("ads_known", "null_ratio", column="ad_id", threshold=0.25),
        ops.Check("columns", "schema", columns=("event_id", "ad_id", "placement_id")),
        ops.Check("bid_columns", "schema", columns=("event_id", "bid_price"), warning_only=True),
        ops.Check("revenue_bounds", "range", column="revenue", low=0.0, high=400.0),
        ops.Check("cost_or_revenue", "condition",
                  condition=(F.col("cost") == 0) | (F.col("revenue") == 0)),
    ]


@query(QUERIES)
def dq_checks(spark, folder):
    out = ops.run_checks(_with_nulls(spark, folder), _checks())
    return rounded(out.select("check", "kind", "passed", "actual", "is_warning"))


_MEASURES = f"""{_MASKED},
m AS (SELECT CAST(count(*) AS DOUBLE) AS n, avg(CASE WHEN user_id IS NULL THEN 1.0 ELSE 0 END) AS u,
  avg(CASE WHEN ad_id IS NULL THEN 1.0 ELSE 0 END) AS a,
  CAST(count(*) FILTER (revenue < 0 OR revenue > 400) AS DOUBLE) AS r,
  CAST(count(*) FILTER (cost <> 0 AND revenue <> 0) AS DOUBLE) AS c FROM masked),
checks AS (
  SELECT 0 AS position, 'enough_rows' AS "check", 'row_count' AS kind, n >= 500 AS passed, n AS actual, false AS is_warning FROM m
  UNION ALL SELECT 1, 'users_known', 'null_ratio', u < 0.1, u, true FROM m
  UNION ALL SELECT 2, 'ads_known', 'null_ratio', a < 0.25, a, false FROM m
  UNION ALL SELECT 3, 'columns', 'schema', true, 0.0, false FROM m
  UNION ALL SELECT 4, 'bid_columns', 'schema', false, 1.0, true FROM m
  UNION ALL SELECT 5, 'revenue_bounds', 'range', r = 0, r, false FROM m
  UNION ALL SELECT 6, 'cost_or_revenue', 'condition', c = 0, c, false FROM m)"""

SQL["dq_checks"] = f"""WITH {_MEASURES}
SELECT "check", kind, passed, round(CAST(actual AS DOUBLE), 6) AS actual, is_warning FROM checks"""


@query(QUERIES)
def dq_first_failure(spark, folder):
    """The same checks, reported up to the first failure."""
    out = ops.run_checks(_with_nulls(spark, folder), _checks(), stop_at_first_failure=True)
    return out.select("position", "check", "passed")


SQL["dq_first_failure"] = f"""WITH {_MEASURES}
SELECT CAST(position AS INTEGER) AS position, "check", passed FROM checks
WHERE position <= coalesce((SELECT min(position) FROM checks WHERE NOT passed AND NOT is_warning), 99)"""


@query(QUERIES)
def dq_summary(spark, folder):
    out = ops.summarise(ops.run_checks(_with_nulls(spark, folder), _checks()))
    return out.withColumn("failures", joined("failures"))


SQL["dq_summary"] = f"""WITH {_MEASURES}
SELECT count(*) AS total_checks, count(*) FILTER (passed) AS passed,
  count(*) FILTER (NOT passed AND NOT is_warning) AS failed,
  count(*) FILTER (NOT passed AND is_warning) AS warnings,
  coalesce(string_agg("check", ',' ORDER BY "check") FILTER (NOT passed AND NOT is_warning), '') AS failures,
  CASE WHEN count(*) FILTER (NOT passed AND NOT is_warning) = 0 THEN 'passed' ELSE 'failed' END AS overall_status
FROM checks"""


@query(QUERIES)
def missing_columns(spark, folder):
    """Expected fields that never occur in a type's semi-structured payload."""
    rows = log.table(spark, folder, "events")
    expected = F.explode(F.array(*[F.lit(c) for c in ("k", "placement", "creative")])).alias("column")
    wanted = rows.select("event_type").distinct().select("event_type", expected)
    seen = rows.select("event_type", F.explode(F.json_object_keys("props")).alias("column")).distinct()
    return wanted.join(seen, ["event_type", "column"], "left_anti")


SQL["missing_columns"] = """WITH seen AS (SELECT DISTINCT event_type, unnest(json_keys(props)) AS c FROM events),
wanted AS (SELECT event_type, unnest(['k', 'placement', 'creative']) AS c FROM (SELECT DISTINCT event_type FROM events))
SELECT event_type, c AS "column" FROM wanted ANTI JOIN seen USING (event_type, c)"""


@query(QUERIES)
def email_check(spark, folder):
    """Words of whole documents that look like addresses, and whether they are valid."""
    documents = log.table(spark, folder, "documents").where(F.col("text").contains("@"))
    words = documents.select(
        "doc_id", F.explode(F.split("text", r"[ \t\n\r]+")).alias("word"))
    return words.where(F.col("word").contains("@")).select(
        "doc_id", "word", is_email(F.col("word")).alias("is_valid"))


SQL["email_check"] = rf"""WITH w AS (SELECT doc_id, unnest(regexp_split_to_array(text, '[ \t\n\r]+')) AS word FROM documents)
SELECT doc_id, word, regexp_matches(word, '{EMAIL_PATTERN}')
  AND length(split_part(word, '@', 1)) <= {EMAIL_LOCAL_LENGTH} AS is_valid FROM w WHERE contains(word, '@')"""


@query(QUERIES)
def campaign_lookup(spark, folder):
    rows = log.ad_events(spark, folder)
    return rounded(sources.campaign_events(spark, rows, 3).select(
        "event_id", "event_type", "ad_id", "revenue", "cost"))


SQL["campaign_lookup"] = f"""WITH {AD}
SELECT event_id, event_type, ad_id, round(revenue, 6) AS revenue, round(cost, 6) AS cost
FROM ad WHERE campaign_id = 3"""


@query(QUERIES)
def run_ledger(spark, folder):
    """A ledger row with the run's measures, unfolded."""
    measures = log.ad_events(spark, folder).agg(
        F.count("*").alias("rows"), F.count_if(F.col("event_type") == "click").alias("clicks"))
    entry = ledger_entry(measures, "partitioning", dt.date(2024, 1, 30), dt.datetime(2024, 1, 31),
                         {"source": "log", "job": "daily"})
    return entry.select("run_type", "run_date", "status", F.explode("metrics").alias("metric", "value"))


SQL["run_ledger"] = f"""WITH {AD}
SELECT 'partitioning' AS run_type, '2024-01-30' AS run_date, 'complete' AS status,
  unnest(['rows', 'clicks']) AS metric,
  unnest([CAST(count(*) AS DOUBLE), CAST(count(*) FILTER (event_type = 'click') AS DOUBLE)]) AS value FROM ad"""


@query(QUERIES)
def ledger_gauge_names(spark, folder):
    """Flat metric names with sorted tags, one ledger row per event type."""
    measures = log.ad_events(spark, folder).groupBy("event_type").agg(F.count("*").alias("rows"))
    ledger = measures.select(
        F.lit("partitioning").alias("run_type"), F.lit(dt.date(2024, 1, 30)).alias("run_date"),
        F.create_map(F.lit("rows"), F.col("rows").cast("double")).alias("metrics"),
        F.create_map(F.lit("type"), "event_type", F.lit("job"), F.lit("daily")).alias("tags"))
    return ledger_gauges(ledger)


SQL["ledger_gauge_names"] = f"""WITH {AD}
SELECT 'partitioning' AS run_type, '2024-01-30' AS run_date,
  'rows.job_daily.type_' || event_type AS gauge, CAST(count(*) AS DOUBLE) AS value
FROM ad GROUP BY event_type"""


@query(QUERIES)
def outlier_events(spark, folder):
    """Events whose value lies outside the quartile or the median fence of the whole log."""
    events, value = log.table(spark, folder, "events"), {"value": F.col("value")}
    by_quartiles = ops.flag_outliers(events, ops.quartile_fences(events, value), value)
    both = ops.flag_outliers(by_quartiles.withColumnRenamed("outliers", "q"), ops.median_fences(events, value), value)
    flags = both.select("event_id", "value", (F.size("q") > 0).alias("by_quartiles"), (F.size("outliers") > 0).alias("by_median"))
    return rounded(flags.where("by_quartiles OR by_median"))


SQL["outlier_events"] = """
WITH q AS (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b, quantile_cont(value, 0.5) AS m FROM events),
d AS (SELECT quantile_cont(abs(value - m), 0.5) AS d FROM events, q),
f AS (SELECT event_id, value, value < a - 1.5 * (b - a) OR value > b + 1.5 * (b - a) AS by_quartiles,
  value < m - d * 1.4826 * 3 OR value > m + d * 1.4826 * 3 AS by_median FROM events, q, d)
SELECT event_id, round(value, 6) AS value, by_quartiles, by_median FROM f WHERE by_quartiles OR by_median"""


@query(QUERIES)
def fence_checks(spark, folder):
    """Shares of event values outside either fence, as declared checks."""
    events = log.table(spark, folder, "events")
    out = ops.run_checks(events, [
        ops.Check("few beyond quartiles", "quartile_fence", "value", threshold=0.01),
        ops.Check("some beyond median", "median_fence", "value", threshold=0.2, warning_only=True)])
    return rounded(out)


SQL["fence_checks"] = """
WITH q AS (SELECT quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b, quantile_cont(value, 0.5) AS m FROM events),
d AS (SELECT quantile_cont(abs(value - m), 0.5) AS d FROM events, q),
s AS (SELECT avg(CAST(value < a - 1.5 * (b - a) OR value > b + 1.5 * (b - a) AS INTEGER)) AS x,
  avg(CAST(value < m - d * 1.4826 * 3 OR value > m + d * 1.4826 * 3 AS INTEGER)) AS y FROM events, q, d)
SELECT CAST(0 AS INTEGER) AS position, 'few beyond quartiles' AS "check", 'quartile_fence' AS kind, x <= 0.01 AS passed, round(x, 6) AS actual, false AS is_warning FROM s
UNION ALL SELECT 1, 'some beyond median', 'median_fence', y <= 0.2, round(y, 6), true FROM s"""
