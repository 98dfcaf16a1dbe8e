"""Reruns that have less to say than the run before."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from adlumen.plans import ranking, reports, segments
from adlumen.sinks import tables
from adlumen.sources import eventlog as log

DAY, NOON = dt.date(2024, 1, 15), dt.datetime(2024, 1, 15, 12)


def test_replaced_partitions(spark, tmp_path):
    root = str(tmp_path / "t")

    def rows(*values):
        return spark.createDataFrame(list(values), "id long, date string, kind string")

    def held():
        return sorted(map(tuple, spark.read.schema("id long, date string, kind string").parquet(root).collect()), key=str)

    first = [(1, "2024-01-01", "a"), (2, "2024-01-01", "b"), (3, "2024-01-02", "a"), (4, "2024-01-01", None)]
    tables.replace_partitions(rows(*first), root, ["date", "kind"], {"date": ["2024-01-01", "2024-01-02"]})
    assert held() == sorted(first, key=str)
    untouched = sorted(Path(root, "date=2024-01-02").rglob("*"))
    tables.replace_partitions(rows((9, "2024-01-01", "b")), root, ["date", "kind"], {"date": ["2024-01-01"]})
    assert held() == [(3, "2024-01-02", "a"), (9, "2024-01-01", "b")]
    assert sorted(Path(root, "date=2024-01-02").rglob("*")) == untouched
    with pytest.raises(ValueError):
        tables.replace_partitions(rows((9, "2024-01-02", "b")), root, ["date", "kind"], {"date": ["2024-01-01"]})
    with pytest.raises(ValueError):
        tables.replace_partitions(rows((9, "2024-01-02", "b")), root, ["date", "kind"], {"kind": ["a"]})
    assert held() == [(3, "2024-01-02", "a"), (9, "2024-01-01", "b")]
    tables.replace_partitions(rows().limit(0), root, ["date", "kind"], {"date": ["2024-01-01"]})
    assert held() == [(3, "2024-01-02", "a")]
    assert not list(Path(root).glob(".replacing*"))


def test_complete_upsert(spark, tmp_path):
    root, staging = str(tmp_path / "t"), str(tmp_path / "s")
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)

    def upsert(*values, **more):
        frame = spark.createDataFrame(list(values), "report_date date, ad_id long, clicks long, version int")
        tables.upsert_daily(spark, root, frame, ["report_date", "ad_id"], "version", staging, **more)

    def held():
        return {(r.report_date, r.ad_id, r.clicks) for r in spark.read.parquet(root).collect()}

    upsert((d1, 1, 10, 1), (d2, 1, 20, 1), (d2, 2, 5, 1), (d2, None, 6, 1), (d2, 4, 8, 9))
    upsert((d2, 1, 21, 2), (d2, None, 7, 2), complete=[d2])
    # ad 2 has no update any more; ad 4 is newer than every update
    assert held() == {(d1, 1, 10), (d2, 1, 21), (d2, None, 7), (d2, 4, 8)}
    upsert((d2, 1, 0, 1), complete=[d2])
    assert held() == {(d1, 1, 10), (d2, 1, 21), (d2, None, 7), (d2, 4, 8)}
    frame = spark.createDataFrame([], "report_date date, ad_id long, clicks long, version int")
    tables.upsert_daily(spark, root, frame, ["report_date", "ad_id"], "version", staging, complete=[d2])
    assert held() == {(d1, 1, 10)}


def test_report_of_a_day_without_events_leaves_nothing(spark, small, tmp_path):
    root, events = str(tmp_path), log.ad_events(spark, small)
    assert reports.run_daily_report(spark, events, DAY, root, f"{root}/staging", NOON).count() > 0
    assert reports.run_daily_report(spark, events.limit(0), DAY, root, f"{root}/staging", NOON).count() == 0
    for name in ("aggregations", "daily_metrics", "reports", "kpis"):
        assert not [p for p in Path(root, name).rglob("*") if p.suffix in (".parquet", ".json")]


def test_invalid_reports_are_marked_and_not_sent(spark, small, tmp_path):
    root = str(tmp_path)
    # one advertiser with more clicks than impressions
    events = log.ad_events(spark, small).withColumn(
        "event_type", F.when(F.col("advertiser_id") == 1, "click").otherwise(F.col("event_type")))
    notify = {r.advertiser_id for r in reports.run_daily_report(spark, events, DAY, root, f"{root}/staging", NOON).collect()}
    judged = {r.advertiser_id: (r.is_valid, r.errors) for r in spark.read.json(f"{root}/reports").select("advertiser_id", "is_valid", "errors").collect()}
    assert judged[1][0] is False and judged[1][1] and 1 not in notify
    assert {a for a, (ok, _) in judged.items() if ok} >= notify and notify
    ledger = spark.read.parquet(f"{root}/ledger").head()
    assert ledger.metrics["reports"] - ledger.metrics["valid_reports"] >= 1


def test_segments_and_features_of_a_smaller_log(spark, small, tmp_path):
    root, events = str(tmp_path), log.ad_events(spark, small)
    day = dt.date(2024, 1, 30)
    fewer = events.where((F.col("user_id") % 2 == 0) & (F.to_date("timestamp") != "2024-01-20"))
    for rows in (events, fewer):
        segments.run_daily_segmentation(spark, rows, day, root, root, force_full=True, min_total=1, required=())
    for name in ("user-days", "user-features", "segments"):
        assert spark.read.parquet(f"{root}/{name}").where("user_id % 2 = 1").count() == 0
    assert spark.read.parquet(f"{root}/user-days").where("date = '2024-01-20'").count() == 0
    hour = dt.datetime(2024, 1, 20, 6)
    order = F.struct("timestamp", "order_id", "line")
    for rows in (events, events.limit(0)):
        ranking.run_hourly_features(rows, log.bid_rows(spark, small), order, hour, f"{root}/vectors", hour)
    assert not list(Path(root, "vectors").rglob("*.parquet"))
