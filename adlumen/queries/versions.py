"""Queries on committed changes: compaction, merges and reruns as a reader sees them after each step."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from adlumen.operators import aggregate as agg
from adlumen.plans import compaction, ingest, ranking, reports, segments
from adlumen.queries.common import ALL_AD, FACTS, METRICS_OUT, query, rounded
from adlumen.schemas import HIERARCHY, METRICS
from adlumen.session import shared_dir
from adlumen.sinks.snapshots import Table
from adlumen.sources import eventlog as log

QUERIES: dict = {}
SQL: dict[str, str] = {}

_DAY = ["year", "month", "day"]
_RUN_DAY, _GONE_DAY = dt.date(2024, 1, 30), dt.date(2024, 1, 20)
_HOUR = dt.datetime(2024, 1, 20, 6)


@query(QUERIES)
def compaction_commit(spark, folder):
    """The log in small files with copies of every 50th event, read before, during and after a compaction.

    An attempt that is written but not committed, and a compaction under a name that is in
    the history, change nothing; the first version can still be read at the end.
    """
    root = shared_dir(spark, "compaction-commit") + "/events"
    events = ingest.with_levels(log.all_events(spark, folder)).drop("hour")
    events.write.partitionBy(*_DAY).parquet(root)
    events.where("event_id % 50 = 0").write.mode("append").partitionBy(*_DAY).parquet(root)
    schema = events.select(*[c for c in events.columns if c not in _DAY], *_DAY).schema
    table = Table(spark, root, schema, tuple(_DAY))
    states, version = [], table.adopt()

    def seen(state: str, rows: DataFrame) -> None:
        states.append(rows.groupBy(*_DAY).agg(F.count("*").alias("rows"), F.count_distinct("event_id").alias("events"), F.sum("cost").alias("cost"))
                      .withColumns({"state": F.lit(state), "version": F.lit(table.version())}))

    seen("before", table.read())
    table.write(table.read())
    seen("written", table.read())
    compaction.compact(table, "first compaction")
    seen("committed", table.read())
    compaction.compact(table, "first compaction")
    seen("repeated", table.read())
    seen("first version", table.read(version))
    return rounded(reduce(DataFrame.unionByName, states))


SQL["compaction_commit"] = f"""WITH {ALL_AD},
d AS (SELECT CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day, count(*) AS events,
  count(*) FILTER (event_id % 50 = 0) AS copies, sum(cost) AS cost, coalesce(sum(cost) FILTER (event_id % 50 = 0), 0) AS copied FROM ad GROUP BY ALL),
s AS (SELECT unnest([('before', 1, false), ('written', 1, false), ('committed', 2, true), ('repeated', 2, true), ('first version', 2, false)]) AS s),
v AS (SELECT year, month, day, events, copies, cost, copied, s[1] AS state, CAST(s[2] AS INTEGER) AS version,
  -- a day of one file only, or with too many copies, stays as it is
  s[3] AND copies > 0 AND copies / CAST(events + copies AS DOUBLE) <= 0.05 AS compacted FROM d, s)
SELECT state, version, year, month, day, events + CASE WHEN compacted THEN 0 ELSE copies END AS rows, events,
  round(cost + CASE WHEN compacted THEN 0 ELSE copied END, 6) AS cost FROM v"""


def _metrics(spark, folder):
    return agg.daily_facts(log.ad_events(spark, folder)).select("report_date", *HIERARCHY, *METRICS)


@query(QUERIES)
def file_level_merge(spark, folder):
    """Daily metrics merged by file: recounted ads, then one whole day recomputed without advertiser 0.

    The second half of the month is recounted for every tenth ad; each merge is sent twice.
    """
    facts = _metrics(spark, folder).withColumn("version", F.lit(1))
    keys, root = ["report_date", *HIERARCHY], shared_dir(spark, "file-merge") + "/daily_metrics"
    schema = facts.select(*[c for c in facts.columns if c != "report_date"], "report_date").schema
    table = Table(spark, root, schema, ("report_date",))
    table.append(facts, "load")
    recounted = facts.where((F.col("report_date") >= "2024-01-15") & (F.col("ad_id") % 10 == 3)).withColumns(
        {"version": F.lit(2), "revenue": F.col("revenue") * 1.1})
    day = F.col("report_date") == F.lit(_GONE_DAY)
    again = facts.where(day & (F.col("advertiser_id") != 0)).withColumn("version", F.lit(3))
    for _ in range(2):
        table.merge(recounted, keys, "version", "recount")
    for _ in range(2):
        table.merge(again, keys, "version", "recompute", scope=day)
    return rounded(table.read())


SQL["file_level_merge"] = f"""WITH {FACTS},
v AS (SELECT *, CASE WHEN report_date = DATE '{_GONE_DAY}' THEN 3 WHEN report_date >= DATE '2024-01-15' AND ad_id % 10 = 3 THEN 2 ELSE 1 END AS version
  FROM facts WHERE NOT (report_date = DATE '{_GONE_DAY}' AND advertiser_id = 0)),
m AS (SELECT * REPLACE (CASE WHEN version = 2 THEN revenue * 1.1 ELSE revenue END AS revenue) FROM v)
SELECT CAST(report_date AS VARCHAR) AS report_date, advertiser_id, campaign_id, adset_id, ad_id, {METRICS_OUT}, CAST(version AS INTEGER) AS version FROM m"""


@query(QUERIES)
def report_rerun(spark, folder):
    """A day's report run again after every third advertiser left the log; what the tables then hold."""
    root = shared_dir(spark, "report-rerun")
    events, at = log.ad_events(spark, folder), dt.datetime(2024, 1, 21)
    for rows in (events, events.where("advertiser_id % 3 <> 1")):
        reports.run_daily_report(spark, rows, _GONE_DAY, root, f"{root}/staging", at)
    by = ["advertiser_id"]

    def held(table: str, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*[F.col(c).cast("long").alias(c) for c in by]).agg(F.count("*").alias("rows")).withColumn("table", F.lit(table))

    parquet = spark.read.parquet
    return (held("aggregations", parquet(f"{root}/aggregations")).unionByName(held("daily_metrics", parquet(f"{root}/daily_metrics")))
            .unionByName(held("kpis", parquet(f"{root}/kpis").where("level = 'ad'")))
            .unionByName(held("reports", spark.read.json(f"{root}/reports").select("advertiser_id"))))


SQL["report_rerun"] = f"""WITH {FACTS},
f AS (SELECT * FROM facts WHERE report_date = DATE '{_GONE_DAY}' AND advertiser_id % 3 <> 1)
SELECT t AS "table", advertiser_id, CASE WHEN t = 'reports' THEN 1 ELSE count(*) END AS rows
FROM f, (SELECT unnest(['aggregations', 'daily_metrics', 'kpis', 'reports']) AS t) GROUP BY t, advertiser_id"""


@query(QUERIES)
def segmentation_rerun(spark, folder):
    """Segmentation run again after every fourth user and one whole day left the log; users per table and day."""
    root = shared_dir(spark, "segmentation-rerun")
    events = log.ad_events(spark, folder)
    fewer = events.where(((F.col("user_id") % 4 != 1) | F.col("user_id").isNull()) & (F.to_date("timestamp") != F.lit(_GONE_DAY)))
    for rows in (events, fewer):
        segments.run_daily_segmentation(spark, rows, _RUN_DAY, root, root, force_full=True, min_total=1, required=())

    def held(table: str, name: str) -> DataFrame:
        rows = spark.read.parquet(f"{root}/{name}").groupBy("date").agg(F.count("*").alias("users"))
        return rows.select(F.lit(table).alias("table"), F.date_format("date", "yyyy-MM-dd").alias("date"), "users")

    return held("days", "user-days").union(held("features", "user-features")).union(held("segments", "segments")).union(
        held("memberships", "memberships"))


SQL["segmentation_rerun"] = f"""WITH {ALL_AD},
e AS (SELECT *, CAST(ts AS DATE) AS day FROM ad WHERE user_id % 4 <> 1 AND CAST(ts AS DATE) <> DATE '{_GONE_DAY}'
  AND event_type IN ('impression', 'click', 'conversion') AND ts < TIMESTAMP '{_RUN_DAY}'),
u AS (SELECT user_id, count(*) FILTER (event_type = 'impression') AS seen FROM e GROUP BY user_id)
SELECT 'days' AS "table", CAST(day AS VARCHAR) AS date, count(DISTINCT user_id) AS users FROM e GROUP BY day
UNION ALL SELECT 'features', '{_RUN_DAY}', count(*) FROM u
UNION ALL SELECT unnest(['segments', 'memberships']), '{_RUN_DAY}', count(*) FROM u WHERE seen >= {segments.MIN_IMPRESSIONS} HAVING count(*) > 0"""


@query(QUERIES)
def ranking_rerun(spark, folder):
    """Hourly features run again after odd ads left the log; the vectors that the store then holds."""
    root = shared_dir(spark, "ranking-rerun") + "/features"
    events, bids = log.ad_events(spark, folder), log.bid_rows(spark, folder)
    for rows in (events, events.where("ad_id % 2 = 0")):
        ranking.run_hourly_features(rows, bids, F.struct("timestamp", "order_id", "line"), _HOUR, root, _HOUR)
    vectors = spark.read.parquet(root)
    return vectors.select("ad_id", *_DAY, "hour", F.round(F.expm1(F.col("features")["impressions_24h_log"])).cast("long").alias("impressions"))


SQL["ranking_rerun"] = f"""WITH {ALL_AD}
SELECT ad_id, CAST({_HOUR.year} AS INTEGER) AS year, CAST({_HOUR.month} AS INTEGER) AS month, CAST({_HOUR.day} AS INTEGER) AS day,
  CAST({_HOUR.hour} AS INTEGER) AS hour, count(*) FILTER (event_type = 'impression') AS impressions
FROM ad WHERE event_type IN ('impression', 'click', 'conversion', 'engagement') AND ad_id % 2 = 0
  AND ts >= TIMESTAMP '{_HOUR}' - INTERVAL 24 HOUR AND ts < TIMESTAMP '{_HOUR}' GROUP BY ad_id"""
