"""Jobs end to end on real files."""

import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from adlumen import schemas as S
from adlumen.plans import compaction, ingest, ranking, reports, segments
from adlumen.sinks import tables
from adlumen.sources import eventlog as log, events as sources, inventory
from adlumen.streaming import events as streaming

DAY = dt.date(2024, 1, 15)
NOON = dt.datetime(2024, 1, 15, 12)


@pytest.fixture
def landed(spark):
    """48 events of one day, two an hour, with two invalid rows."""
    rows = spark.range(48).select(
        F.col("id").cast("string").alias("event_id"),
        F.when(F.col("id") % 2 == 0, "impression").otherwise("click").alias("event_type"),
        *[F.lit("x").alias(c) for c in S.required_columns(S.AD_EVENT)
          if c not in ("event_id", "event_type", "timestamp")],
        (F.lit(dt.datetime(2024, 1, 15)).cast("timestamp")
         + F.make_dt_interval(F.lit(0), F.expr("cast(id div 2 AS int)"))).alias("timestamp"),
        F.lit("u").alias("user_id"), F.lit(None).cast("string").alias("session_id"),
        F.lit(None).cast("string").alias("device_type"), F.lit("us").alias("country_code"),
        F.lit(None).cast("string").alias("platform"),
        F.when(F.col("id") == 7, -1.0).otherwise(0.5).alias("revenue"),
        F.lit(0.1).alias("cost"), F.lit("{}").alias("metadata"))
    odd = rows.where("event_id = '9'").withColumn("event_type", F.lit("swipe"))
    return rows.where("event_id <> '9'").unionByName(odd).select(S.columns_of(S.AD_EVENT))


def test_partitioning_is_idempotent(spark, landed, tmp_path):
    root = str(tmp_path)
    verified = ingest.run_partitioning(spark, landed, DAY, root, NOON).collect()
    assert len(verified) == 48 and all(r.verified for r in verified)
    assert sum(r.output_rows for r in verified) == 48  # two of them in quarantine
    rejected = spark.read.parquet(f"{root}/quarantine").orderBy("event_id").collect()
    assert [(r.event_id, r.errors) for r in rejected] == [
        ("7", ["negative_revenue"]), ("9", ["unknown_event_type"])]

    stored = spark.read.schema(S.AD_EVENT).parquet(f"{root}/events")
    assert (Path(root) / "events/year=2024/month=01/day=15/hour=03/event_type=impression").is_dir()
    assert {(r.device_type, r.country_code) for r in stored.collect()} == {("unknown", "US")}

    files = sorted(p for p in Path(root, "events").rglob("*.parquet"))
    done = inventory.listed_partitions(inventory.list_files(spark, f"{root}/events"))
    assert done.exceptAll(ingest.existing_partitions(spark.read.parquet(f"{root}/events"))).count() == 0
    again = ingest.run_partitioning(spark, landed, DAY, root, NOON, done).collect()
    # all rows are found stored or refused, and nothing is written
    assert len(again) == 48 and all(r.verified for r in again)
    assert sorted(p for p in Path(root, "events").rglob("*.parquet")) == files

    ledger = spark.read.parquet(f"{root}/ledger").collect()
    assert [(r.metrics["partitions"], r.metrics["rows"], r.status) for r in ledger] == [(48.0, 48.0, "complete")] * 2


def test_partitioning_loses_no_row(spark, landed, tmp_path):
    root = str(tmp_path)
    changed = landed.withColumns({
        "event_type": F.expr("CASE event_id WHEN '2' THEN 'view' WHEN '4' THEN 'engagement' ELSE event_type END"),
        "timestamp": F.expr("CASE event_id WHEN '6' THEN timestamp - INTERVAL 1 DAY WHEN '8' THEN NULL ELSE timestamp END")})
    verified = ingest.run_partitioning(spark, changed, DAY, root, NOON).collect()
    assert all(r.verified for r in verified) and sum(r.input_rows for r in verified) == 48
    stored = spark.read.parquet(f"{root}/events")
    assert stored.where("event_type IN ('view', 'engagement')").count() == 2 and stored.count() == 44
    refused = {r.event_id: r.errors for r in spark.read.parquet(f"{root}/quarantine").collect()}
    assert refused == {"6": ["outside_day"], "7": ["negative_revenue"], "8": ["missing_timestamp"], "9": ["unknown_event_type"]}


def test_partitioning_of_clean_refused_and_shrinking_days(spark, landed, tmp_path):
    root = str(tmp_path)
    clean = landed.where("event_id NOT IN ('7', '9')")
    assert all(r.verified for r in ingest.run_partitioning(spark, clean, DAY, root, NOON).collect())
    assert spark.read.parquet(f"{root}/events").count() == 46 and spark.read.parquet(f"{root}/quarantine").count() == 0
    # a rerun over fewer rows leaves nothing stale
    assert all(r.verified for r in ingest.run_partitioning(spark, clean.where("hour(timestamp) < 2"), DAY, root, NOON).collect())
    assert spark.read.parquet(f"{root}/events").count() == 4
    bad = landed.where("event_id IN ('7', '9')")
    assert all(r.verified for r in ingest.run_partitioning(spark, bad, DAY, root, NOON).collect())
    assert not list(Path(root, "events").rglob("*.parquet")) and spark.read.parquet(f"{root}/quarantine").count() == 2


def test_partitioning_of_user_actions(spark, tmp_path):
    rows = spark.createDataFrame(
        [("1", "u", "a", "c", "v", "buy", NOON, None, None, None, None, None, None, None),
         ("2", "u", "a", "c", "v", "buy", NOON, None, None, None, -1.0, None, None, None)], S.USER_ACTION)
    root = str(tmp_path)
    verified = ingest.run_partitioning(spark, rows, DAY, root, NOON, kind=ingest.USER_ACTIONS).collect()
    assert [(r.event_type, r.hour, r.input_rows, r.verified) for r in verified] == [("buy", 12, 2, True)]
    stored = spark.read.parquet(f"{root}/events").head()
    assert (stored.attribution_window_days, stored.currency, stored.revenue_value) == (7, "USD", 0.0)


def test_reads_prune_partitions(spark, landed, tmp_path):
    root = str(tmp_path / "events")
    tables.write_events(landed.where("event_type <> 'swipe'"), root)
    window = sources.read_window(spark, root, NOON, 6, event_types=["click"])
    assert sorted({r.timestamp.hour for r in window.collect()}) == list(range(6, 12))
    plan = window._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1]
    assert "year" in filters and "event_type" in filters
    assert "PushedFilters" in plan
    assert sources.read_events(spark, root, DAY, DAY).count() == 47
    assert sources.read_events(spark, root, dt.date(2024, 1, 16), dt.date(2024, 2, 1)).count() == 0
    found = sources.campaign_events(spark, window, "x' OR '1'='1")
    assert found.count() == 0


def test_landing_day_is_one_scan(spark, landed, tmp_path):
    folder = tmp_path / "20240115"
    landed.withColumn("hour", F.date_format("timestamp", "HH")).write.partitionBy(
        "hour", "event_type").parquet(str(folder))
    assert sources.read_landing_day(spark, str(tmp_path), DAY).count() == 48


def test_inventory_of_real_files(spark, landed, tmp_path):
    root = str(tmp_path / "events")
    tables.write_events(landed.where("event_type <> 'swipe'"), root)
    files = inventory.list_files(spark, root)
    on_disk = {f"file:{p}": p.stat().st_size for p in Path(root).rglob("*.parquet")}
    assert {r.path: r.size for r in files.collect()} == on_disk
    assert "content" not in files.columns

    levels = inventory.with_partition_levels(files).select("year", "hour", "event_type").distinct()
    assert levels.count() == 47
    days = inventory.child_prefixes(files, 2024, 1).collect()
    assert len(days) == 1 and days[0].child_prefix.endswith("year=2024/month=01/day=15/")
    assert inventory.child_prefixes(files, 2024, 1, 15).count() == 24
    assert inventory.child_prefixes(files, 2023).count() == 0
    assert inventory.small_files(files, DAY).count() == len(on_disk)
    assert inventory.small_files(files, dt.date(2024, 1, 16)).count() == 0
    assert inventory.readiness(files).where("is_ready").count() == 47
    assert inventory.readiness(files, min_files=5).where("is_ready").count() == 0
    fresh = inventory.freshness(files, F.current_timestamp(), 30).head()
    assert fresh.is_fresh and fresh.staleness_minutes < 30
    late = F.current_timestamp() + F.expr("INTERVAL 2 HOURS")
    assert not inventory.freshness(files, late, 30).head().is_fresh
    assert not inventory.freshness(files.limit(0), late, 30).head().is_fresh
    assert not inventory.marker_exists(spark, f"{root}/year=2024")
    spark.range(1).write.parquet(str(tmp_path / "plain"))
    assert inventory.marker_exists(spark, str(tmp_path / "plain"))


def test_inventory_report(spark):
    report = spark.createDataFrame(
        [("e/day=1/a.parquet", 10 * 1024 * 1024, NOON, "t1", "STANDARD"), ("e/day=1/_SUCCESS", 0, NOON, "t2", "STANDARD")],
        "key string, size long, last_modified_date timestamp, e_tag string, storage_class string")
    rows = inventory.from_inventory_report(report, "lake").orderBy("name").collect()
    assert [r.path for r in rows] == ["s3://lake/e/day=1/_SUCCESS", "s3://lake/e/day=1/a.parquet"]
    assert rows[1].size_mb == 10.0 and rows[1].storage_class == "STANDARD"
    ready = inventory.readiness(inventory.from_inventory_report(report, "lake"), require_marker=True).head()
    assert ready.is_ready and ready.file_count == 1
    only = inventory.from_inventory_report(report, "lake", ".parquet")
    assert not inventory.readiness(only, require_marker=True).head().is_ready


def test_compaction(spark, landed, tmp_path):
    root, staging = str(tmp_path / "events"), str(tmp_path / "staging")
    one_hour = landed.where("event_type = 'impression' AND hour(timestamp) < 2")
    # two copies of two partitions, and one partition that needs nothing
    for _ in range(2):
        one_hour.withColumns({
            "year": F.lit("2024"), "month": F.lit("01"), "day": F.lit("15"),
            "hour": F.date_format("timestamp", "HH"),
        }).write.mode("append").partitionBy(*tables.EVENT_LAYOUT).parquet(root)
    lone = landed.where("event_id = '11'").withColumns(
        {"year": F.lit("2024"), "month": F.lit("01"), "day": F.lit("15"), "hour": F.lit("05")})
    lone.write.mode("append").partitionBy(*tables.EVENT_LAYOUT).parquet(root)

    files = inventory.list_files(spark, root)
    before = {r.path for r in files.collect()}
    judged = compaction.stage_compaction(spark, root, files, staging)
    got = {r.hour: r for r in judged.collect()}
    assert set(got) == {0, 1}
    assert (got[0].input_rows, got[0].output_rows, got[0].duplicates_removed) == (2, 1, 1)
    # half the rows were duplicates, which the default limit refuses
    assert not got[0].is_valid and got[0].errors == ["dedup_ratio_above_limit", "row_loss_above_limit"]
    assert compaction.swap_in(spark, root, files, judged, staging).count() == 0
    assert {r.path for r in inventory.list_files(spark, root).collect()} == before

    totals = compaction.run_totals(judged).head()
    assert (totals.jobs, totals.succeeded, len(totals.first_failures)) == (2, 0, 2)


def test_compaction_of_distinct_rows(spark, landed, tmp_path):
    root, staging = str(tmp_path / "events"), str(tmp_path / "staging")
    base = landed.where("event_type = 'impression'").withColumns(
        {"year": F.lit("2024"), "month": F.lit("01"), "day": F.lit("15"), "hour": F.lit("00")})
    base.repartition(6).write.partitionBy(*tables.EVENT_LAYOUT).parquet(root)
    originals = sorted(str(p) for p in Path(root).rglob("*.parquet"))
    files = inventory.list_files(spark, root)
    judged = compaction.stage_compaction(spark, root, files, staging)
    outcome = judged.head()
    assert outcome.is_valid and outcome.input_file_count == 6 and outcome.output_rows == 24
    assert len(list(Path(staging).rglob("*.parquet"))) == 1
    retire = [r.path.removeprefix("file:") for r in compaction.swap_in(
        spark, root, files, judged, staging).collect()]
    assert sorted(retire) == originals
    for path in retire:
        Path(path).unlink()
    left = spark.read.parquet(root)
    assert left.count() == 24 and left.select("event_id").distinct().count() == 24


def test_nothing_to_compact(spark, landed, tmp_path):
    root = str(tmp_path / "events")
    tables.write_events(landed.where("event_id = '4'"), root)
    assert compaction.stage_compaction(spark, root, inventory.list_files(spark, root), str(tmp_path / "s")) is None


def test_upsert_touches_only_its_dates(spark, tmp_path):
    root, staging = str(tmp_path / "t"), str(tmp_path / "s")

    def rows(*values):
        return spark.createDataFrame(values, "report_date date, ad_id long, clicks long, version int")

    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    keys = ["report_date", "ad_id"]
    tables.upsert_daily(spark, root, rows((d1, 1, 10, 1), (d2, 1, 20, 1), (d2, 2, 5, 1)), keys, "version", staging)
    untouched = sorted(Path(root, "report_date=2024-01-01").iterdir())
    tables.upsert_daily(spark, root, rows((d2, 1, 21, 2), (d2, 3, 7, 2)), keys, "version", staging)
    got = {(r.report_date, r.ad_id, r.clicks) for r in spark.read.parquet(root).collect()}
    assert got == {(d1, 1, 10), (d2, 1, 21), (d2, 2, 5), (d2, 3, 7)}
    assert sorted(Path(root, "report_date=2024-01-01").iterdir()) == untouched
    # a late, older version does not win
    tables.upsert_daily(spark, root, rows((d2, 1, 1, 0)), keys, "version", staging)
    assert spark.read.parquet(root).where("ad_id = 1 AND clicks = 21").count() == 1


def test_daily_report(spark, small, tmp_path):
    root = str(tmp_path)
    events = log.ad_events(spark, small)
    notify = reports.run_daily_report(spark, events, DAY, root, f"{root}/staging", NOON)
    assert notify.where("spend <= 0").count() == 0 and notify.count() > 0
    document = json.loads(next(Path(root, "reports").rglob("*.json")).read_text().splitlines()[0])
    assert document["is_final"] and document["currency"] == "USD"
    assert document["report_id"].endswith("-20240115-0")
    assert document["period"]["start_date"] == document["period"]["end_date"] == "2024-01-15"
    ad = document["campaign_metrics"][0]["adset_metrics"][0]["ad_metrics"][0]
    assert {"ad_id", "impressions", "roas"} <= set(ad)
    total = sum(c["impressions"] for c in document["campaign_metrics"])
    assert document["total_metrics"]["impressions"] == total
    kpis = spark.read.parquet(f"{root}/kpis")
    assert kpis.where("level = 'total'").count() == 1
    rows = spark.read.parquet(f"{root}/daily_metrics").count()
    reports.run_daily_report(spark, events, DAY, root, f"{root}/staging", NOON)
    assert spark.read.parquet(f"{root}/daily_metrics").count() == rows


def test_hourly_features(spark, small, tmp_path):
    root = str(tmp_path / "features")
    hour = dt.datetime(2024, 1, 20, 6)
    order = F.struct("timestamp", "order_id", "line")
    ranking.run_hourly_features(
        log.ad_events(spark, small), log.bid_rows(spark, small), order, hour, root, hour).collect()
    vectors = spark.read.parquet(root)
    row = vectors.head()
    assert len(row.feature_values) == 16 and row.feature_names == list(S.FEATURE_NAMES)
    assert row.features["ctr_24h"] == row.feature_values[2]
    assert (row.year, row.month, row.day, row.hour) == (2024, 1, 20, 6)
    meta = spark.read.json(f"{root}_metadata").head()
    assert meta.feature_version == "v1" and meta.ads_count == vectors.count()
    recent = log.ad_events(spark, small).where(
        (F.col("timestamp") >= "2024-01-19 06:00") & (F.col("timestamp") < "2024-01-20 06:00"))
    assert meta.ads_count == recent.select("ad_id").distinct().count()


def test_daily_segmentation(spark, small, tmp_path):
    root = str(tmp_path)
    events = log.ad_events(spark, small)
    first, second = dt.date(2024, 1, 29), dt.date(2024, 1, 30)  # a Monday, then a Tuesday
    checks = segments.run_daily_segmentation(spark, events, first, root, root, min_total=10**9).head()
    assert checks.total_users > 0 and checks.too_few_users and not checks.is_valid
    assert not Path(root, "memberships").exists()  # invalid segments are not exported
    segments.run_daily_segmentation(spark, events, first, root, root, min_total=5, required=())
    segments.run_daily_segmentation(spark, events, second, root, root, min_total=5, required=())
    incremental = spark.read.parquet(f"{root}/segments").where(F.col("date") == F.lit(second))
    rebuilt_root = str(tmp_path / "full")
    # a first run is a full one on any day
    segments.run_daily_segmentation(spark, events, second, rebuilt_root, root, min_total=5, required=())
    rebuilt = spark.read.parquet(f"{rebuilt_root}/segments")
    columns = ["user_id", "rfm_score", "tier", "click_count_90d"]
    assert sorted(map(tuple, incremental.select(columns).collect())) == sorted(
        map(tuple, rebuilt.select(columns).collect()))
    entries = spark.read.parquet(f"{root}/memberships")
    assert entries.where("key LIKE 'segment:user:%' AND ttl_seconds = 86400").count() == entries.count()
    assert sorted(r.status for r in spark.read.parquet(f"{root}/ledger").collect()) == ["complete", "complete", "invalid"]


def test_gzip_export(spark, tmp_path):
    df = spark.range(5)
    tables.export_text(df, str(tmp_path / "csv"), compressed=True)
    assert list(Path(tmp_path / "csv").glob("*.csv.gz"))
    assert spark.read.option("header", "true").csv(str(tmp_path / "csv")).count() == 5
    tables.export_text(df, str(tmp_path / "json"), fmt="json")
    assert spark.read.json(str(tmp_path / "json")).count() == 5
    with pytest.raises(Exception):
        tables.export_text(df, str(tmp_path / "json"), fmt="json")


def test_stream_resumes_and_drops_late_rows(spark, tmp_path):
    """Two runs of one query: state and progress survive, late rows are left out."""
    source, root, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    schema = "event_id long, event_type string, timestamp timestamp, ad_id long, revenue double, cost double"

    def land(*rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = streaming.read_stream(spark, source, spark.read.schema(schema).parquet(source).schema)
        counts = streaming.sliding_counts(stream, ["ad_id"], "1 hour", "1 hour", "1 hour")
        running = streaming.write_stream(counts, root, checkpoint)
        running.awaitTermination()
        late.append(streaming.late_rows(running))
        return {(r.ad_id, r.window_start.hour): r.impressions for r in spark.read.parquet(root).collect()}

    late = []

    def at(hour, minute=0):
        return dt.datetime(2024, 1, 1, hour, minute)

    land((1, "impression", at(0, 10), 7, 0.0, 0.0), (2, "impression", at(5), 7, 0.0, 0.0))
    assert run() == {(7, 0): 1}
    # hour 0 is closed: the first row is late, the second belongs to an open window
    land((3, "impression", at(0, 20), 7, 0.0, 0.0), (4, "impression", at(5, 30), 7, 0.0, 0.0),
         (5, "click", at(9), 7, 0.0, 0.0))
    assert run() == {(7, 0): 1, (7, 5): 2}
    assert late == [0, 1]


def test_stream_ingest(spark, landed, tmp_path):
    source, root, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    landed.write.parquet(source)
    stream = streaming.read_stream(spark, source, S.AD_EVENT)
    streaming.ingest(stream, root, checkpoint).awaitTermination()
    assert spark.read.parquet(root).count() == 48
    streaming.ingest(stream, root, checkpoint).awaitTermination()
    assert spark.read.parquet(root).count() == 48


def test_shared_folder_is_the_clusters(spark):
    from adlumen.session import shared_dir

    configured = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert first.startswith(configured) and first != second


def test_stream_attribution_equals_the_batch_operator(spark, tmp_path):
    from adlumen.operators.attribution import attribute_conversions
    from adlumen.streaming import attribution

    def at(day, hour):
        return dt.datetime(2024, 1, day, hour)

    schema = "event_id long, event_type string, timestamp timestamp, user_id long, ad_id long, revenue double, attribution_window_days int"
    rows = [(1, "impression", at(1, 1), 1, 7, 0.0, None), (2, "click", at(1, 2), 1, 7, 0.0, None), (3, "click", at(1, 2), 1, 7, 0.0, None),
            (4, "conversion", at(1, 3), 1, 7, 5.0, None), (5, "conversion", at(3, 3), 1, 7, 5.0, 1), (6, "impression", at(1, 3), 2, 7, 0.0, None),
            (7, "conversion", at(1, 3), 2, 7, 1.0, 0), (8, "conversion", at(2, 3), 2, 8, 1.0, 30), (9, "conversion", at(2, 4), None, 7, 1.0, 30),
            (10, "impression", at(2, 5), None, 7, 0.0, None), (11, "click", at(4, 1), 1, 7, 0.0, None), (12, "conversion", at(12, 1), 1, 7, 2.0, 8),
            (13, "conversion", at(12, 1), 1, 7, 2.0, None), (14, "view", at(4, 1), 1, 7, 0.0, None)]
    end = [(-1, kind, dt.datetime(2100, 1, 1), -1, -1, 0.0, 1) for kind in ("impression", "conversion")]
    source, root, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    for part in (rows[:7], rows[7:], end):
        spark.createDataFrame(part, schema).write.mode("append").parquet(source)
        stream = streaming.read_stream(spark, source, spark.read.parquet(source).schema)
        found = attribution.attribute(stream, stream.where("event_type = 'conversion'"), ["user_id", "ad_id"], "1 hour", 30)
        streaming.write_stream(found, root, checkpoint).awaitTermination()
    got = spark.read.parquet(root).where("conversion_id > 0")
    want = attribute_conversions(spark.createDataFrame(rows, schema), ["user_id", "ad_id"])
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
    assert {r.conversion_id: r.click_ts is not None for r in got.collect()} == {4: True, 5: False, 7: False, 8: False, 9: False, 12: True, 13: False}


def test_exports_come_back_as_they_were(spark, tmp_path):
    from adlumen.sources.exports import read_text_export

    rows = spark.createDataFrame(
        [(1, 'a "quoted", text', dt.datetime(2024, 1, 1, 1, 2, 3, 456789), 0.1), (2, "two\nlines \\ back", None, None), (3, "", NOON, -1.5),
         (4, None, NOON, 1e300), (None, "é 中 ;", NOON, 3.0)], "id long, text string, at timestamp, value double")
    want = sorted(map(tuple, rows.collect()), key=str)
    for fmt in ("csv", "json"):
        for compressed in (True, False):
            path = str(tmp_path / f"{fmt}-{compressed}")
            tables.export_text(rows, path, fmt, compressed)
            got = read_text_export(spark, path, rows.schema, fmt, compressed)
            # csv has one form for an empty text and for none
            assert sorted(map(tuple, got.collect()), key=str) == sorted(
                ((i, t or None if fmt == "csv" else t, *more) for i, t, *more in want), key=str)
            assert read_text_export(spark, path, rows.schema, fmt).count() == 5
            assert read_text_export(spark, path, rows.schema, fmt, not compressed).count() == 0
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad/x.csv").write_text("id,text,at,value\nnone,a,b,c\n")
    with pytest.raises(Exception):
        read_text_export(spark, str(tmp_path / "bad"), rows.schema).collect()


def test_listing_by_tasks_equals_sparks_listing(spark, tmp_path):
    from adlumen.sources import listing

    root = tmp_path / "lake"
    spark.range(60).selectExpr("id", "id % 5 AS a", "if(id % 3 = 0, NULL, concat('x y=', id % 2)) AS b").repartition(3).write.partitionBy("a", "b").parquet(str(root))
    spark.range(3).write.parquet(str(root / "_temporary"))
    spark.range(3).write.json(str(root / "a=1" / "other"))
    (root / "empty" / "deep").mkdir(parents=True)
    got, want = listing.list_files_in_tasks(spark, str(root)), inventory.list_files(spark, str(root))
    assert got.columns == want.columns
    rows = sorted(map(tuple, got.select("name", "size", "modified", "size_mb").collect()))
    assert rows == sorted(map(tuple, want.select("name", "size", "modified", "size_mb").collect())) and len(rows) > 10
    assert {r.path for r in got.collect()} == {f"file:{p}" for p in root.rglob("*.parquet") if "_temporary" not in str(p) and p.is_file()}
    both = listing.list_files_in_tasks(spark, [str(root / "a=1"), f"file:{root}/a=2", str(tmp_path / "nothing")])
    assert {r.path for r in both.collect()} == {r.path for r in got.collect() if "/a=1/" in r.path or "/a=2/" in r.path}
    assert listing.list_files_in_tasks(spark, str(root), ".json").count() == len(list(root.rglob("part*.json")))


def test_listing_hands_on_pages(monkeypatch, tmp_path):
    import pyarrow as pa

    from adlumen.sources import listing

    for i in range(25):
        (tmp_path / f"{i}.parquet").touch()
    monkeypatch.setattr(listing, "PAGE", 10)
    out = list(listing._listed(iter([pa.RecordBatch.from_arrays([pa.array([str(tmp_path)])], names=["path"])])))
    assert [b.num_rows for b in out] == [10, 10, 5]
