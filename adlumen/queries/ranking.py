"""Ranking-feature queries: one run per day over the whole log, in a single pass."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from adlumen.operators import decay_state as state_ops
from adlumen.operators.aggregate import hourly_counts
from adlumen.operators.windows import rolling_hours
from adlumen.plans import ranking as plan
from adlumen.queries.common import AD, COUNTS, joined, query, rounded, sql_ratio
from adlumen.schemas import FEATURE_NAMES, FEATURE_VERSION
from adlumen.session import shared_dir
from adlumen.sources import eventlog as log

QUERIES: dict = {}
SQL: dict[str, str] = {}


def _midnight():
    """Each hour belongs to the run at the end of its day."""
    return F.date_trunc("day", F.col("hour_start")) + F.expr("INTERVAL 1 DAY")


def _daily_counts(spark, folder, key):
    hourly = hourly_counts(log.ad_events(spark, folder), key)
    return plan.window_counts(hourly, [key], _midnight())


def _dated(df):
    return rounded(df.withColumn("anchor", F.to_date("anchor")))


_ANCHOR = "date_trunc('day', {t}) + INTERVAL 1 DAY"


def _windows_sql(key: str) -> str:
    """Counts straight from the events; decayed rates from hourly counts."""
    sums = []
    for h in (1, 6, 24):
        for name, kind in (("impressions", "impression"), ("clicks", "click"), ("conversions", "conversion")):
            sums.append(f"count(*) FILTER (event_type = '{kind}' AND age <= {h}) AS {name}_{h}h")
    for h in (1, 24):
        for name, col in (("revenue", "revenue"), ("spend", "cost")):
            sums.append(f"sum(CASE WHEN age <= {h} THEN {col} ELSE 0 END) AS {name}_{h}h")

    def decayed(name, num, den, scale=""):
        w = f"CASE WHEN {den} > 0 THEN exp(-ln(2) / 6 * age) END"
        return (f"coalesce(sum({num} / CAST(nullif({den}, 0) AS DOUBLE){scale} * ({w})) / sum({w}), 0.0)"
                f" AS {name}_decayed")

    return f"""{AD},
aged AS (SELECT *, CAST({_ANCHOR.format(t='ts')} AS TIMESTAMP) AS anchor,
   (epoch_us(CAST({_ANCHOR.format(t='ts')} AS TIMESTAMP)) - epoch_us(ts)) / 3600e6 AS age FROM ad),
cnt AS (SELECT {key}, anchor, {', '.join(sums)} FROM aged GROUP BY ALL),
hr AS (SELECT {key}, anchor, age, {COUNTS} FROM
   (SELECT {key}, anchor, event_type, cost, revenue,
      date_diff('hour', date_trunc('hour', ts), anchor) - 1 AS age FROM aged) GROUP BY ALL),
dec AS (SELECT {key}, anchor, {decayed('ctr', 'clicks', 'impressions')},
   {decayed('cvr', 'conversions', 'clicks')}, {decayed('ecpm', 'revenue', 'impressions', ' * 1000')}
   FROM hr GROUP BY ALL),
win AS (SELECT * FROM cnt JOIN dec USING ({key}, anchor))"""


_COUNT_COLUMNS = [f"{m}_{h}h" for h in (1, 6, 24) for m in ("impressions", "clicks", "conversions")]
_MONEY_COLUMNS = [f"{m}_{h}h" for h in (1, 24) for m in ("revenue", "spend")]


def _smooth(num, den, prior):
    return f"CASE WHEN {den} < 10 THEN {prior} ELSE ({num} + {prior}) / ({den} + 1.0) END"


_RATES = {f"ctr_{h}h": _smooth(f"clicks_{h}h", f"impressions_{h}h", 0.001) for h in (1, 6, 24)} | {
    f"cvr_{h}h": _smooth(f"conversions_{h}h", f"clicks_{h}h", 0.0001) for h in (1, 6, 24)} | {
    f"ecpm_{h}h": sql_ratio(f"revenue_{h}h", f"impressions_{h}h", " * 1000") for h in (1, 24)}
_RAW_RATES = {f"ctr_{h}h": sql_ratio(f"clicks_{h}h", f"impressions_{h}h") for h in (1, 6, 24)} | {
    f"cvr_{h}h": sql_ratio(f"conversions_{h}h", f"clicks_{h}h") for h in (1, 6, 24)}


def _select(exprs: dict[str, str]) -> str:
    return ", ".join(f"round({e}, 6) AS {n}" for n, e in exprs.items())


@query(QUERIES)
def window_counts(spark, folder):
    counts = _daily_counts(spark, folder, "ad_id")
    return _dated(counts.select("ad_id", "anchor", *_COUNT_COLUMNS, *_MONEY_COLUMNS))


SQL["window_counts"] = f"""WITH {_windows_sql('ad_id')}
SELECT ad_id, CAST(CAST(anchor AS DATE) AS VARCHAR) AS anchor, {', '.join(_COUNT_COLUMNS)},
       {_select({m: m for m in _MONEY_COLUMNS})} FROM cnt"""


@query(QUERIES)
def decayed_metrics(spark, folder):
    names = ("ctr_decayed", "cvr_decayed", "ecpm_decayed")
    return _dated(_daily_counts(spark, folder, "advertiser_id").select("advertiser_id", "anchor", *names))


SQL["decayed_metrics"] = f"""WITH {_windows_sql('advertiser_id')}
SELECT advertiser_id, CAST(CAST(anchor AS DATE) AS VARCHAR) AS anchor,
       {_select({n: n for n in ('ctr_decayed', 'cvr_decayed', 'ecpm_decayed')})} FROM dec"""


@query(QUERIES)
def smoothed_rates(spark, folder):
    rates = plan.with_rates(_daily_counts(spark, folder, "advertiser_id"))
    return _dated(rates.select("advertiser_id", "anchor", *_RATES))


SQL["smoothed_rates"] = f"""WITH {_windows_sql('advertiser_id')}
SELECT advertiser_id, CAST(CAST(anchor AS DATE) AS VARCHAR) AS anchor, {_select(_RATES)} FROM cnt"""


@query(QUERIES)
def raw_rates(spark, folder):
    rates = plan.with_rates(_daily_counts(spark, folder, "advertiser_id"), smoothed=False)
    return _dated(rates.select("advertiser_id", "anchor", *_RAW_RATES))


SQL["raw_rates"] = f"""WITH {_windows_sql('advertiser_id')}
SELECT advertiser_id, CAST(CAST(anchor AS DATE) AS VARCHAR) AS anchor, {_select(_RAW_RATES)} FROM cnt"""


@query(QUERIES)
def hourly_rolling_counts(spark, folder):
    hourly = hourly_counts(log.ad_events(spark, folder), "campaign_id").select(
        "campaign_id", "hour_start", "impressions", "clicks", "revenue")
    out = rolling_hours(hourly, ["campaign_id"], ["impressions", "clicks", "revenue"])
    return rounded(out.withColumn("hour_start", F.date_format("hour_start", "yyyy-MM-dd HH:mm")))


_ROLL = ", ".join(
    (f"CAST(sum({m}) OVER w{h} AS BIGINT)" if m != "revenue" else f"round(sum({m}) OVER w{h}, 6)")
    + f" AS {m}_{h}h"
    for m in ("impressions", "clicks", "revenue") for h in (1, 6, 24)
)
SQL["hourly_rolling_counts"] = f"""WITH {AD},
h AS (SELECT campaign_id, date_trunc('hour', ts) AS hour_start, {COUNTS} FROM ad GROUP BY ALL)
SELECT campaign_id, strftime(hour_start, '%Y-%m-%d %H:%M') AS hour_start, impressions, clicks,
       round(revenue, 6) AS revenue, {_ROLL} FROM h
WINDOW w1 AS (PARTITION BY campaign_id ORDER BY hour_start RANGE BETWEEN INTERVAL 0 HOUR PRECEDING AND CURRENT ROW),
  w6 AS (PARTITION BY campaign_id ORDER BY hour_start RANGE BETWEEN INTERVAL 5 HOUR PRECEDING AND CURRENT ROW),
  w24 AS (PARTITION BY campaign_id ORDER BY hour_start RANGE BETWEEN INTERVAL 23 HOUR PRECEDING AND CURRENT ROW)"""


def _bid_order():
    return F.struct("timestamp", "order_id", "line")


def _features(spark, folder):
    counts = _daily_counts(spark, folder, "ad_id")
    return plan.with_rates(plan.with_budget(counts, log.bid_rows(spark, folder), _bid_order()))


_BUDGET_SQL = f"""{_windows_sql('ad_id')},
bid AS (SELECT l_partkey % 100 AS ad_id, l_extendedprice AS budget_remaining, l_tax * 30 AS pacing
   FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_partkey % 100
     ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC) = 1),
feat AS (SELECT win.*, budget_remaining,
   CASE WHEN budget_remaining IS NULL THEN 0.0
     ELSE {sql_ratio('spend_24h', '(spend_24h + budget_remaining)')} END AS budget_utilization,
   coalesce(pacing, 1.0) + 0.0 AS pacing_factor FROM win LEFT JOIN bid USING (ad_id))"""


@query(QUERIES)
def budget_features(spark, folder):
    counts = _daily_counts(spark, folder, "ad_id")
    out = plan.with_budget(counts, log.bid_rows(spark, folder), _bid_order())
    return _dated(out.select("ad_id", "anchor", "spend_24h", "budget_remaining",
                             "budget_utilization", "pacing_factor"))


SQL["budget_features"] = f"""WITH {_BUDGET_SQL}
SELECT ad_id, CAST(CAST(anchor AS DATE) AS VARCHAR) AS anchor, round(spend_24h, 6) AS spend_24h,
       round(budget_remaining, 6) AS budget_remaining,
       round(budget_utilization, 6) AS budget_utilization, round(pacing_factor, 6) AS pacing_factor
FROM feat"""


@query(QUERIES)
def feature_vector(spark, folder):
    """The 16 features of every ad and run, one row per feature."""
    vectors = plan.feature_vector(_features(spark, folder), "ad_id", "anchor")
    return _dated(vectors.select(
        "ad_id", "anchor", F.explode("features").alias("feature", "value"), "version"))


def _all_features_sql():
    exprs = _RATES | {n: n for n in ("ctr_decayed", "cvr_decayed", "ecpm_decayed",
                                     "budget_utilization", "pacing_factor")} | {
        f"{m}_24h_log": f"ln(1 + {m}_24h)" for m in ("impressions", "clicks", "conversions")}
    names = ", ".join(f"'{n}'" for n in FEATURE_NAMES)
    values = ", ".join(f"CAST({exprs[n]} AS DOUBLE)" for n in FEATURE_NAMES)
    return f"unnest([{names}]) AS feature, unnest([{values}]) AS value"


SQL["feature_vector"] = f"""WITH {_BUDGET_SQL},
f AS (SELECT ad_id, anchor, {_all_features_sql()} FROM feat)
SELECT ad_id, CAST(CAST(anchor AS DATE) AS VARCHAR) AS anchor, feature, round(value, 6) AS value, 'v1' AS version FROM f"""


@query(QUERIES)
def feature_anomalies(spark, folder):
    out = plan.feature_anomalies(plan.with_rates(_daily_counts(spark, folder, "ad_id")))
    return _dated(out.where(F.size("anomalies") > 0).select(
        "ad_id", "anchor", "ctr_24h", "cvr_24h", "ecpm_24h", joined("anomalies").alias("anomalies")))


SQL["feature_anomalies"] = f"""WITH {_windows_sql('ad_id')},
r AS (SELECT ad_id, anchor, impressions_24h, clicks_24h,
   {', '.join(f'{_RATES[n]} AS {n}' for n in ('ctr_24h', 'cvr_24h', 'ecpm_24h'))} FROM cnt),
a AS (SELECT *, concat_ws(',',
   CASE WHEN impressions_24h = 0 AND clicks_24h > 0 THEN 'clicks_without_impressions' END,
   CASE WHEN ctr_24h > 0.5 THEN 'ctr_24h_above_half' END,
   CASE WHEN cvr_24h > 1.0 THEN 'cvr_24h_above_one' END,
   CASE WHEN ecpm_24h > 100 THEN 'ecpm_24h_above_100' END) AS anomalies FROM r)
SELECT ad_id, CAST(CAST(anchor AS DATE) AS VARCHAR) AS anchor, round(ctr_24h, 6) AS ctr_24h, round(cvr_24h, 6) AS cvr_24h,
       round(ecpm_24h, 6) AS ecpm_24h, anomalies FROM a WHERE anomalies <> ''"""


@query(QUERIES)
def feature_metadata(spark, folder):
    """The record of each daily run: the ads its vectors describe."""
    runs = _daily_counts(spark, folder, "ad_id").groupBy("anchor").agg(F.count("*").alias("ads_count"))
    hour = F.date_format("anchor", "yyyy-MM-dd'T'HH:mm:ss")
    return runs.select(
        F.lit(FEATURE_VERSION).alias("feature_version"), hour.alias("computation_hour"), "ads_count",
        hour.alias("export_timestamp"), F.lit(",".join(FEATURE_NAMES)).alias("feature_names"))


SQL["feature_metadata"] = f"""WITH {AD},
r AS (SELECT DISTINCT ad_id, CAST(ts AS DATE) + 1 AS anchor FROM ad)
SELECT 'v1' AS feature_version, strftime(anchor, '%Y-%m-%dT00:00:00') AS computation_hour, count(*) AS ads_count,
       strftime(anchor, '%Y-%m-%dT00:00:00') AS export_timestamp, '{",".join(FEATURE_NAMES)}' AS feature_names
FROM r GROUP BY anchor"""


_STEPS = (dt.datetime(2024, 1, 28), dt.datetime(2024, 1, 28, 1), dt.datetime(2024, 1, 28, 8), dt.datetime(2024, 1, 29, 2), dt.datetime(2024, 1, 30, 12))


@query(QUERIES)
def decayed_state(spark, folder):
    """Decayed rates per advertiser from a state moved forward by 1, 7, 18 and 34 hours, at each of its stops."""
    root, keys = shared_dir(spark, "decay-state"), ["advertiser_id"]
    hourly_counts(log.ad_events(spark, folder), *keys).write.parquet(f"{root}/hourly")
    hourly = spark.read.parquet(f"{root}/hourly")
    states = []
    for i, at in enumerate(_STEPS):
        state = state_ops.advance(states[-1], hourly, keys, _STEPS[i - 1], at) if i else state_ops.start(hourly, keys, at)
        state.write.parquet(f"{root}/state-{i}")
        states.append(spark.read.parquet(f"{root}/state-{i}"))
    out = reduce(DataFrame.unionByName, [state_ops.means(s, keys) for s in states])
    return rounded(out.withColumn("as_of", F.date_format("as_of", "yyyy-MM-dd HH:mm")))


def _decay_sql(name, value, known):
    return (f"round(CASE WHEN count(*) FILTER ({known}) > 0 THEN sum({value} * pow(0.5, age / 6.0)) FILTER ({known}) / "
            f"sum(pow(0.5, age / 6.0)) FILTER ({known}) ELSE 0 END, 6) AS {name}")


SQL["decayed_state"] = f"""WITH {AD},
h AS (SELECT advertiser_id, date_trunc('hour', ts) AS hour_start, {COUNTS} FROM ad GROUP BY ALL),
a AS (SELECT unnest([{", ".join(f"TIMESTAMP '{t}'" for t in _STEPS)}]) AS at_),
w AS (SELECT *, date_diff('hour', hour_start, at_) - 1 AS age FROM h, a WHERE hour_start < at_ AND hour_start >= at_ - INTERVAL 24 HOUR)
SELECT advertiser_id, strftime(at_, '%Y-%m-%d %H:%M') AS as_of,
  {_decay_sql('ctr_decayed', 'clicks / CAST(impressions AS DOUBLE)', 'impressions > 0')},
  {_decay_sql('cvr_decayed', 'conversions / CAST(clicks AS DOUBLE)', 'clicks > 0')},
  {_decay_sql('ecpm_decayed', 'revenue / CAST(impressions AS DOUBLE) * 1000', 'impressions > 0')}
FROM w GROUP BY advertiser_id, at_"""
