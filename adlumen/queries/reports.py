"""Report queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from adlumen.functions.times import period_days
from adlumen.operators import aggregate as agg
from adlumen.operators.attribution import attribute_conversions
from adlumen.operators.joins import attach_names
from adlumen.operators.validation import validate_reports
from adlumen.operators.windows import period_over_period as compare_periods
from adlumen.plans import reports as plan
from adlumen.queries.common import (
    AD, COUNTS, FACTS, KPIS_OUT, METRICS_OUT, SUMS, joined, query, rounded, sql_ratio,
)
from adlumen.schemas import HIERARCHY, METRICS
from adlumen.sinks.tables import merge_latest
from adlumen.sources import eventlog as log

QUERIES: dict = {}
SQL: dict[str, str] = {}
_GENERATED = dt.datetime(2024, 2, 1, 6, 0, 0)


@query(QUERIES)
def campaign_kpis(spark, folder):
    return rounded(plan.campaign_report(log.ad_events(spark, folder)))


SQL["campaign_kpis"] = f"""WITH {AD},
c AS (SELECT advertiser_id, campaign_id, {COUNTS} FROM ad GROUP BY ALL)
SELECT advertiser_id, campaign_id, {METRICS_OUT}, {KPIS_OUT} FROM c"""


@query(QUERIES)
def campaign_totals(spark, folder):
    """Fact rows with names, rolled up to campaigns; the first fact names the campaign."""
    facts = agg.daily_facts(log.ad_events(spark, folder))
    named = attach_names(facts, log.ad_names(spark, folder), "ad_id")
    return rounded(agg.campaign_totals(named.withColumnRenamed("ad_name", "campaign_name")))


SQL["campaign_totals"] = f"""WITH {FACTS},
named AS (SELECT f.*, p_name FROM facts f LEFT JOIN part ON ad_id = p_partkey),
c AS (SELECT campaign_id, first(p_name ORDER BY report_date, adset_id, ad_id) AS campaign_name,
       first(advertiser_id ORDER BY report_date, adset_id, ad_id) AS advertiser_id, {SUMS}
      FROM named GROUP BY campaign_id)
SELECT campaign_id, campaign_name, advertiser_id, {METRICS_OUT} FROM c"""


def _marked(rollup):
    """Ids as text, a star where a level is rolled up."""
    return rounded(rollup.withColumns(
        {c: F.coalesce(F.col(c).cast("string"), F.lit("*")) for c in HIERARCHY}))


_IDS = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '*') AS {c}" for c in HIERARCHY)


@query(QUERIES)
def hierarchy_rollup(spark, folder):
    facts = agg.ad_facts(log.ad_events(spark, folder))
    return _marked(agg.with_kpis(agg.hierarchy_rollup(facts)))


_LEVEL = """CASE WHEN grouping(advertiser_id) = 1 THEN 'total' WHEN grouping(campaign_id) = 1 THEN 'advertiser'
  WHEN grouping(adset_id) = 1 THEN 'campaign' WHEN grouping(ad_id) = 1 THEN 'adset' ELSE 'ad' END AS level"""

SQL["hierarchy_rollup"] = f"""WITH {AD},
r AS (SELECT advertiser_id, campaign_id, adset_id, ad_id, {_LEVEL}, {COUNTS}
      FROM ad GROUP BY ROLLUP (advertiser_id, campaign_id, adset_id, ad_id))
SELECT {_IDS}, level, {METRICS_OUT}, {KPIS_OUT} FROM r"""


@query(QUERIES)
def daily_hierarchy_rollup(spark, folder):
    facts = agg.daily_facts(log.ad_events(spark, folder))
    return _marked(agg.hierarchy_rollup(facts, "report_date"))


SQL["daily_hierarchy_rollup"] = f"""WITH {FACTS},
r AS (SELECT report_date, advertiser_id, campaign_id, adset_id, ad_id, {_LEVEL}, {SUMS}
      FROM facts GROUP BY report_date, ROLLUP (advertiser_id, campaign_id, adset_id, ad_id))
SELECT CAST(report_date AS VARCHAR) AS report_date, {_IDS}, level, {METRICS_OUT} FROM r"""


@query(QUERIES)
def advertiser_totals(spark, folder):
    facts = agg.ad_facts(log.ad_events(spark, folder))
    return rounded(agg.with_kpis(plan.advertiser_totals(facts)))


SQL["advertiser_totals"] = f"""WITH {AD},
a AS (SELECT advertiser_id, count(DISTINCT campaign_id) AS campaign_count, {COUNTS} FROM ad GROUP BY ALL)
SELECT advertiser_id, campaign_count, {METRICS_OUT}, {KPIS_OUT} FROM a"""


@query(QUERIES)
def report_validation(spark, folder):
    totals = plan.advertiser_totals(agg.daily_facts(log.ad_events(spark, folder)), "report_date")
    return rounded(validate_reports(totals).select(
        "report_date", "advertiser_id", "campaign_count", "impressions", "clicks", "conversions",
        "spend", joined("errors").alias("errors"), joined("warnings").alias("warnings"), "is_valid",
    ))


_DAILY_TOTALS = f"""{AD},
a AS (SELECT CAST(ts AS DATE) AS report_date, advertiser_id,
       count(DISTINCT campaign_id) AS campaign_count, {COUNTS} FROM ad GROUP BY ALL)"""

SQL["report_validation"] = f"""WITH {_DAILY_TOTALS},
v AS (SELECT *, concat_ws(',',
        CASE WHEN clicks > impressions THEN 'clicks_exceed_impressions' END,
        CASE WHEN clicks > 0 AND conversions > clicks THEN 'cvr_above_limit' END,
        CASE WHEN spend < 0 THEN 'negative_spend' END,
        CASE WHEN campaign_count = 0 THEN 'no_campaigns' END) AS errors,
      CASE WHEN impressions > 0 AND clicks > impressions * 0.5 THEN 'ctr_above_limit' ELSE '' END AS warnings
      FROM a)
SELECT CAST(report_date AS VARCHAR) AS report_date, advertiser_id, campaign_count, impressions, clicks, conversions,
       round(spend, 6) AS spend, errors, warnings, errors = '' AS is_valid FROM v"""


@query(QUERIES)
def report_metadata(spark, folder):
    totals = plan.advertiser_totals(agg.daily_facts(log.ad_events(spark, folder)), "report_date")
    return rounded(plan.report_metadata(totals, F.lit(_GENERATED)))


SQL["report_metadata"] = f"""WITH {_DAILY_TOTALS}
SELECT advertiser_id, strftime(report_date, '%Y-%m-%d') AS report_date,
       '2024-02-01T06:00:00' AS generated_at, campaign_count, impressions AS total_impressions,
       round(spend, 6) AS total_spend, 'USD' AS currency, true AS is_final FROM a"""


@query(QUERIES)
def report_by_grain(spark, folder):
    """All four grains for an advertiser reporting in New York time."""
    out = agg.report_by_grain(
        log.ad_events(spark, folder), ("hourly", "daily", "weekly", "monthly"), "advertiser_id",
        timezone="America/New_York",
    )
    return rounded(out.withColumn("period_start", F.date_format("period_start", "yyyy-MM-dd HH:mm")))


# January: New York is five hours behind UTC throughout
SQL["report_by_grain"] = f"""WITH {AD},
l AS (SELECT *, ts - INTERVAL 5 HOUR AS lt FROM ad),
g AS (SELECT 'hourly' AS grain, date_trunc('hour', lt) AS p, * FROM l
      UNION ALL SELECT 'daily', CAST(date_trunc('day', lt) AS TIMESTAMP), * FROM l
      UNION ALL SELECT 'weekly', CAST(date_trunc('week', lt) AS TIMESTAMP), * FROM l
      UNION ALL SELECT 'monthly', CAST(date_trunc('month', lt) AS TIMESTAMP), * FROM l),
r AS (SELECT grain, strftime(p, '%Y-%m-%d %H:%M') AS period_start, advertiser_id, {COUNTS}
      FROM g GROUP BY ALL)
SELECT grain, period_start, advertiser_id, {METRICS_OUT} FROM r"""


@query(QUERIES)
def report_periods(spark, folder):
    """First and last active day of each campaign, and the inclusive length."""
    days = agg.daily_facts(log.ad_events(spark, folder)).groupBy("campaign_id").agg(
        F.min("report_date").alias("start_date"), F.max("report_date").alias("end_date")
    )
    return days.withColumn("days", period_days(F.col("start_date"), F.col("end_date")).cast("long"))


SQL["report_periods"] = f"""WITH {AD}
SELECT campaign_id, CAST(min(CAST(ts AS DATE)) AS VARCHAR) AS start_date,
       CAST(max(CAST(ts AS DATE)) AS VARCHAR) AS end_date,
       CAST(max(CAST(ts AS DATE)) - min(CAST(ts AS DATE)) + 1 AS BIGINT) AS days
FROM ad GROUP BY campaign_id"""


@query(QUERIES)
def period_comparison(spark, folder):
    daily = agg.count_events(
        log.ad_events(spark, folder), "campaign_id", F.to_date("timestamp").alias("report_date")
    )
    return rounded(compare_periods(
        daily.select("campaign_id", "report_date", F.col("impressions").cast("double").alias("impressions"),
                     "spend", "revenue"),
        ["campaign_id"], "report_date", ["impressions", "spend", "revenue"],
    ))


_POP = ", ".join(
    f"{e.format(m=m)} AS {n.format(m=m)}"
    for m in ("impressions", "spend", "revenue")
    for e, n in [
        ("round(prev_{m}, 6)", "prev_{m}"), ("round({m} - prev_{m}, 6)", "{m}_change"),
        ("CASE WHEN prev_{m} IS NOT NULL THEN round(" + sql_ratio("({m} - prev_{m})", "prev_{m}") + ", 6) END",
         "{m}_change_pct"),
    ]
)
SQL["period_comparison"] = f"""WITH {AD},
d AS (SELECT campaign_id, CAST(ts AS DATE) AS report_date, {COUNTS} FROM ad GROUP BY ALL),
w AS (SELECT d.*, b.impressions AS prev_impressions, b.spend AS prev_spend, b.revenue AS prev_revenue
      FROM d LEFT JOIN d AS b ON d.campaign_id = b.campaign_id AND d.report_date = b.report_date + 1)
SELECT campaign_id, CAST(report_date AS VARCHAR) AS report_date, CAST(impressions AS DOUBLE) AS impressions, round(spend, 6) AS spend, round(revenue, 6) AS revenue,
       {_POP} FROM w"""


@query(QUERIES)
def top_ads(spark, folder):
    return rounded(plan.top_ads(agg.ad_facts(log.ad_events(spark, folder)), k=3))


SQL["top_ads"] = f"""WITH {AD},
a AS (SELECT advertiser_id, ad_id, {COUNTS} FROM ad GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY advertiser_id ORDER BY
        CASE WHEN spend > 0 THEN revenue / spend ELSE 0.0 END DESC, ad_id) AS rank FROM a)
SELECT advertiser_id, ad_id, {METRICS_OUT}, {KPIS_OUT}, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 3"""


@query(QUERIES)
def nested_report(spark, folder):
    """Nested documents, unfolded again: an ad row with the totals of all its ancestors."""
    documents = plan.report_documents(agg.ad_facts(log.ad_events(spark, folder)), ads_per_document=5_000)
    campaigns = documents.select(
        "advertiser_id", "total_metrics", F.explode("campaign_metrics").alias("c"))
    adsets = campaigns.select("*", F.explode("c.adset_metrics").alias("s"))
    return rounded(adsets.select("*", F.explode("s.ad_metrics").alias("a")).select(
        "advertiser_id", "c.campaign_id", "s.adset_id", "a.ad_id",
        F.col("a.impressions").alias("ad_impressions"), F.col("a.ctr").alias("ad_ctr"),
        F.col("s.clicks").alias("adset_clicks"), F.col("s.cpc").alias("adset_cpc"),
        F.col("c.conversions").alias("campaign_conversions"), F.col("c.roas").alias("campaign_roas"),
        F.col("total_metrics.spend").alias("total_spend"),
        F.col("total_metrics.ecpm").alias("total_ecpm"),
    ))


def _lvl(name, keys):
    return f"{name} AS (SELECT {keys}, {COUNTS} FROM ad GROUP BY ALL)"


SQL["nested_report"] = f"""WITH {AD},
{_lvl('a', 'advertiser_id, campaign_id, adset_id, ad_id')}, {_lvl('s', 'adset_id')},
{_lvl('c', 'campaign_id')}, {_lvl('t', 'advertiser_id')}
SELECT a.advertiser_id, a.campaign_id, a.adset_id, a.ad_id, a.impressions AS ad_impressions,
       round({sql_ratio('a.clicks', 'a.impressions')}, 6) AS ad_ctr, s.clicks AS adset_clicks,
       round({sql_ratio('s.spend', 's.clicks')}, 6) AS adset_cpc,
       c.conversions AS campaign_conversions,
       round({sql_ratio('c.revenue', 'c.spend')}, 6) AS campaign_roas,
       round(t.spend, 6) AS total_spend,
       round({sql_ratio('t.revenue', 't.impressions', ' * 1000')}, 6) AS total_ecpm
FROM a JOIN s USING (adset_id) JOIN c USING (campaign_id) JOIN t USING (advertiser_id)"""


@query(QUERIES)
def ad_names_join(spark, folder):
    ads = agg.count_events(log.ad_events(spark, folder), "campaign_id", "ad_id")
    return rounded(attach_names(ads, log.ad_names(spark, folder), "ad_id"))


SQL["ad_names_join"] = f"""WITH {AD},
a AS (SELECT campaign_id, ad_id, {COUNTS} FROM ad GROUP BY ALL)
SELECT ad_id, campaign_id, {METRICS_OUT}, p_name AS ad_name
FROM a LEFT JOIN part ON ad_id = p_partkey"""


@query(QUERIES)
def upsert_latest(spark, folder):
    """Stored daily metrics merged with recomputed ones for the second half of the month."""
    facts = agg.daily_facts(log.ad_events(spark, folder)).select(
        "report_date", *HIERARCHY, *METRICS)
    stored = facts.where(F.col("report_date") <= "2024-01-20").withColumn("version", F.lit(1))
    fresh = facts.where(F.col("report_date") >= "2024-01-15").withColumns(
        {"version": F.lit(2), "revenue": F.col("revenue") * 1.1})
    merged = merge_latest(stored, fresh, ["report_date", *HIERARCHY], "version")
    return rounded(merged)


SQL["upsert_latest"] = f"""WITH {FACTS}
SELECT CAST(report_date AS VARCHAR) AS report_date, advertiser_id, campaign_id, adset_id, ad_id, impressions, clicks, conversions,
       views, round(spend, 6) AS spend,
       round(CASE WHEN report_date >= DATE '2024-01-15' THEN revenue * 1.1 ELSE revenue END, 6) AS revenue,
       CAST(CASE WHEN report_date >= DATE '2024-01-15' THEN 2 ELSE 1 END AS INTEGER) AS version
FROM facts"""


def _customer_totals(spark, folder):
    """Customers as advertisers: order value as spend, open orders as active campaigns."""
    orders = log.table(spark, folder, "orders").groupBy("o_custkey").agg(
        F.sum("o_totalprice").alias("spend"),
        F.count_if(F.col("o_orderstatus") == "O").alias("campaign_count"),
    )
    customers = log.table(spark, folder, "customer")
    return customers.join(orders, customers.c_custkey == orders.o_custkey, "left").select(
        F.col("c_custkey").alias("advertiser_id"),
        F.coalesce("spend", F.lit(0.0)).alias("spend"),
        F.coalesce("campaign_count", F.lit(0)).alias("campaign_count"),
    )


_CUSTOMER_TOTALS = """t AS (SELECT c_custkey AS advertiser_id, coalesce(sum(o_totalprice), 0) AS spend,
  count(*) FILTER (o_orderstatus = 'O') AS campaign_count
  FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey)"""


@query(QUERIES)
def notify_recipients(spark, folder):
    return rounded(plan.to_notify(_customer_totals(spark, folder)), 4)


SQL["notify_recipients"] = f"""WITH {_CUSTOMER_TOTALS}
SELECT advertiser_id, round(spend, 4) AS spend, campaign_count FROM t
WHERE spend > 0 AND campaign_count > 0"""


@query(QUERIES)
def mail_batches(spark, folder):
    recipients = plan.to_notify(_customer_totals(spark, folder)).select("advertiser_id")
    return plan.mail_batches(recipients, "advertiser_id")


SQL["mail_batches"] = f"""WITH {_CUSTOMER_TOTALS}
SELECT advertiser_id, (row_number() OVER (ORDER BY advertiser_id) - 1) // 100 AS batch FROM t
WHERE spend > 0 AND campaign_count > 0"""


def _attribution(spark, folder, keys, own_window=None):
    events = log.ad_events(spark, folder)
    if own_window is not None:
        events = events.withColumn("attribution_window_days", F.expr(own_window))
    out = attribute_conversions(events, keys)
    return rounded(out.select(
        "conversion_id", *keys,
        *[F.coalesce(F.unix_micros(c), F.lit(-1)).alias(c)
          for c in ("conversion_ts", "click_ts", "impression_ts")],
        F.coalesce("credited_ad_id", F.lit(-1)).alias("credited_ad_id"), "is_view_through", "revenue",
    ))


def attribution_sql(keys, days="7"):
    on = " AND ".join(f"v.{k} = t.{k}" for k in keys)

    def touch(name, kind):
        return f"""{name} AS (SELECT v.event_id AS id, t.ts AS {name}_ts, t.ad_id AS {name}_ad
          FROM ad v JOIN ad t ON {on} AND t.event_type = '{kind}' AND t.ts <= v.ts
               AND t.ts >= v.ts - to_days(CAST({days} AS INTEGER))
          WHERE v.event_type = 'conversion'
          QUALIFY row_number() OVER (PARTITION BY v.event_id ORDER BY t.ts DESC, t.event_id DESC) = 1)"""

    cols = ", ".join(f"v.{k}" for k in keys)
    return f"""WITH {AD}, {touch('click', 'click')}, {touch('view', 'impression')}
SELECT v.event_id AS conversion_id, {cols}, epoch_us(v.ts) AS conversion_ts,
       coalesce(epoch_us(click_ts), -1) AS click_ts, coalesce(epoch_us(view_ts), -1) AS impression_ts,
       coalesce(click_ad, view_ad, -1) AS credited_ad_id,
       click_ts IS NULL AND view_ts IS NOT NULL AS is_view_through, round(v.revenue, 6) AS revenue
FROM ad v LEFT JOIN click ON click.id = v.event_id LEFT JOIN view ON view.id = v.event_id
WHERE v.event_type = 'conversion'"""


@query(QUERIES)
def attribution(spark, folder):
    """Credit by user and ad."""
    return _attribution(spark, folder, ["user_id", "ad_id"])


SQL["attribution"] = attribution_sql(["user_id", "ad_id"])


@query(QUERIES)
def attribution_by_user(spark, folder):
    """Credit to the user's last touch on any ad."""
    return _attribution(spark, folder, ["user_id"])


SQL["attribution_by_user"] = attribution_sql(["user_id"])


@query(QUERIES)
def attribution_own_windows(spark, folder):
    """Credit within each conversion's own window: 1 to 30 days, or the default where none is given."""
    return _attribution(spark, folder, ["user_id", "ad_id"], "if(event_id % 31 = 0, NULL, cast(event_id % 31 AS int))")


SQL["attribution_own_windows"] = attribution_sql(
    ["user_id", "ad_id"], "CASE WHEN v.event_id % 31 = 0 THEN 7 ELSE v.event_id % 31 END")
