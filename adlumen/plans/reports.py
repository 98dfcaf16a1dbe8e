"""Advertiser reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from adlumen.operators import aggregate as agg
from adlumen.operators.ranks import batches
from adlumen.operators.validation import validate_reports
from adlumen.operators.windows import ranked_per_key
from adlumen.schemas import HIERARCHY, METRICS
from adlumen.sinks import tables


#: Ads in a document of the daily job, on average, unless the caller says otherwise: a row
#: must not grow with its advertiser.
ADS_PER_DOCUMENT = 5_000


def campaign_report(events: DataFrame) -> DataFrame:
    """Campaign totals with KPIs."""
    return agg.with_kpis(agg.count_events(events, "advertiser_id", "campaign_id"))


def advertiser_totals(facts: DataFrame, *extra_keys: str) -> DataFrame:
    """Totals and number of campaigns; campaigns are reduced first, so no distinct is needed."""
    campaigns = facts.groupBy(*extra_keys, "advertiser_id", "campaign_id").agg(*agg.metric_sums())
    return campaigns.groupBy(*extra_keys, "advertiser_id").agg(
        F.count("*").alias("campaign_count"), *agg.metric_sums()
    )


def report_metadata(totals: DataFrame, generated_at: Column, currency: str = "USD") -> DataFrame:
    return totals.select(
        "advertiser_id",
        F.date_format("report_date", "yyyy-MM-dd").alias("report_date"),
        F.date_format(generated_at, "yyyy-MM-dd'T'HH:mm:ss").alias("generated_at"),
        "campaign_count",
        F.col("impressions").alias("total_impressions"),
        F.col("spend").alias("total_spend"),
        F.lit(currency).alias("currency"),
        F.lit(True).alias("is_final"),
        *[c for c in ("is_valid", "errors") if c in totals.columns],  # of judged totals
    )


def top_ads(facts: DataFrame, k: int = 3, by: str = "roas") -> DataFrame:
    ads = agg.with_kpis(facts.groupBy("advertiser_id", "ad_id").agg(*agg.metric_sums()))
    return ranked_per_key(ads, ["advertiser_id"], [F.col(by).desc(), F.col("ad_id")], k)


def to_notify(totals: DataFrame) -> DataFrame:
    """Advertisers with spend and at least one active campaign."""
    return totals.where((F.col("spend") > 0) & (F.col("campaign_count") > 0))


def mail_batches(recipients: DataFrame, key: str, size: int = 100) -> DataFrame:
    return batches(recipients, key, size)


def _join_known_or_not(left: DataFrame, right: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Inner join on ``keys``, where an unknown (null) value meets an unknown one."""
    other = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return left.join(other, on).drop(*[f"_{k}" for k in keys])


def report_documents(facts: DataFrame, ads_per_document: int | None = None) -> DataFrame:
    """Nested reports: ads inside ad sets inside campaigns, with totals at every level.

    Every advertiser gets one document. With ``ads_per_document`` the ads of each are dealt
    over as many documents (``part`` of ``parts``) as that needs on average, which together
    list every ad; the totals in each are those of the whole entity. Unknown (null) ids
    are entities of their own at their place.
    """
    ads = facts.groupBy(*HIERARCHY).agg(*agg.metric_sums())
    numbers = [*METRICS, *_KPIS]

    def totals(depth: int) -> DataFrame:
        keys = HIERARCHY[:depth]
        sums = ads.groupBy(*keys).agg(F.count("*").alias("_ads"), *agg.metric_sums())
        return agg.with_kpis(sums).select(*keys, "_ads", F.struct(*numbers).alias(f"total_{depth}"))

    # totals are attached while rows are narrow; nesting then needs neither joins nor windows
    rows = agg.with_kpis(ads).select(*HIERARCHY, F.struct("ad_id", *numbers).alias("item"))
    for depth in (3, 2):
        rows = _join_known_or_not(rows, totals(depth).drop("_ads"), HIERARCHY[:depth])
    parts = F.ceil(F.col("_ads") / ads_per_document) if ads_per_document else F.lit(1).cast("long")
    rows = (
        _join_known_or_not(rows, totals(1), HIERARCHY[:1])
        .withColumn("parts", parts)
        .withColumn("part", F.pmod(F.xxhash64("ad_id"), "parts"))
    )
    for depth, children in ((3, "ad_metrics"), (2, "adset_metrics")):
        keys, carried = HIERARCHY[:depth], ["parts", *[f"total_{d}" for d in range(1, depth + 1)]]
        gathered = rows.groupBy(*keys, "part").agg(
            *[F.any_value(c).alias(c) for c in carried],
            F.sort_array(F.collect_list("item")).alias(children),
        )
        own = [F.col(f"total_{depth}.{n}").alias(n) for n in numbers]
        rows = gathered.select(
            *keys, "part", *carried[:-1], F.struct(keys[-1], *own, children).alias("item")
        )
    return rows.groupBy("advertiser_id", "part").agg(
        F.any_value("parts").alias("parts"),
        F.any_value("total_1").alias("total_metrics"),
        F.sort_array(F.collect_list("item")).alias("campaign_metrics"),
    )


_KPIS = ("ctr", "cvr", "cpa", "cpc", "cpm", "roas", "ecpm")


def run_daily_report(
    spark: SparkSession, events: DataFrame, day: dt.date, out_root: str, staging_root: str,
    generated_at: dt.datetime, ads_per_document: int = ADS_PER_DOCUMENT,
) -> DataFrame:
    """One day's facts → roll-up, KPIs, documents, summary upsert, ledger.

    Returns the advertisers to notify. Facts are written once; every later step reads
    the written table instead of scanning the events again. A rerun replaces the day: ads
    and advertisers that it does not have any more vanish from all tables and documents.
    Reports that fail validation carry their errors, and nobody is notified of them.
    """
    facts_root = f"{out_root}/aggregations"
    todays = events.where(F.to_date("timestamp") == F.lit(day))
    dated, scope = agg.daily_facts(todays).withColumn("date", F.col("report_date")), {"date": [str(day)]}
    tables.replace_partitions(dated, facts_root, ["date"], scope)
    facts = spark.read.schema(dated.schema).parquet(facts_root).where(F.col("date") == F.lit(day))

    rollup = agg.with_kpis(agg.hierarchy_rollup(facts)).withColumn("date", F.lit(day))
    tables.replace_partitions(rollup, f"{out_root}/kpis", ["date"], scope)

    totals = validate_reports(advertiser_totals(facts, "report_date"))
    header = report_metadata(totals, F.lit(generated_at)).withColumn("period", F.struct(
        F.lit(day).alias("start_date"), F.lit(day).alias("end_date"),
        F.lit("daily").alias("granularity"), F.lit("UTC").alias("timezone"),
    ))
    documents = _join_known_or_not(report_documents(facts, ads_per_document), header, HIERARCHY[:1]).withColumns({
        "report_id": F.concat_ws("-", F.col("advertiser_id").cast("string"), F.lit(f"{day:%Y%m%d}"),
                                 F.col("part").cast("string")),
        "date": F.lit(day),
    })
    tables.write_reports(documents, f"{out_root}/reports", day)

    summary = facts.select("report_date", *HIERARCHY, *METRICS).withColumn(
        "updated_at", F.lit(generated_at)
    )
    tables.upsert_daily(spark, f"{out_root}/daily_metrics", summary,
                        ["report_date", *HIERARCHY], "updated_at", staging_root, complete=[day])

    measures = totals.agg(
        F.count("*").alias("reports"), F.count_if("is_valid").alias("valid_reports"),
        F.sum("campaign_count").alias("campaigns"),
    )
    tables.append_ledger(
        tables.ledger_entry(measures, "advertiser_reports", day, generated_at), f"{out_root}/ledger"
    )
    return to_notify(totals.where("is_valid"))
