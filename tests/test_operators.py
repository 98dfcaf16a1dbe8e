"""Operators on small tables and against brute force."""

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from adlumen import schemas as S
from adlumen.operators import aggregate as agg, dedup, joins, quality, ranks, validation, windows
from adlumen.operators.attribution import attribute_conversions
from adlumen.operators.rules import Condition, Criteria, tag_segments
from adlumen.plans import compaction, reports, segments
from adlumen.sources import eventlog as log

FACT = ("advertiser_id string, campaign_id string, campaign_name string, adset_id string, ad_id string, "
        "report_date date, impressions long, clicks long, conversions long, views long, "
        "spend double, revenue double")


@pytest.fixture
def facts(spark):
    d = dt.date(2024, 1, 15)
    return spark.createDataFrame([
        ("adv", "camp_001", "Spring", "s1", "a1", d, 10_000, 150, 5, 0, 50.0, 250.0),
        ("adv", "camp_001", "Later", "s2", "a2", d, 5_000, 75, 3, 0, 25.0, 120.0),
        ("adv", "camp_002", "Other", "s3", "a3", d, 100, 1, 0, 0, 1.0, 0.0),
    ], FACT)


def test_campaign_totals(facts):
    got = {r.campaign_id: r for r in agg.campaign_totals(facts).collect()}
    first = got["camp_001"]
    assert (first.impressions, first.clicks, first.conversions) == (15_000, 225, 8)
    assert first.spend == 75.0 and first.campaign_name == "Spring" and first.advertiser_id == "adv"


def test_rollup_levels_add_up(spark, small):
    leaf = agg.ad_facts(log.ad_events(spark, small))
    rows = agg.hierarchy_rollup(leaf).groupBy("level").agg(
        F.sum("impressions").alias("n"), F.sum("spend").alias("s")).collect()
    assert {r.level for r in rows} == {"ad", "adset", "campaign", "advertiser", "total"}
    assert len({r.n for r in rows}) == 1
    assert max(r.s for r in rows) == pytest.approx(min(r.s for r in rows))


@pytest.mark.parametrize("numbers, errors, warnings", [
    ((2, 100, 10, 1, 5.0), [], []),
    ((0, 100, 10, 1, 5.0), ["no_campaigns"], []),
    ((1, 100, 10, 1, -50.0), ["negative_spend"], []),
    ((1, 100, 200, 1, 5.0), ["clicks_exceed_impressions"], ["ctr_above_limit"]),
    ((1, 100, 60, 1, 5.0), [], ["ctr_above_limit"]),
    ((1, 100, 10, 11, 5.0), ["cvr_above_limit"], [])])
def test_report_validation(spark, numbers, errors, warnings):
    schema = "campaign_count long, impressions long, clicks long, conversions long, spend double"
    got = validation.validate_reports(spark.createDataFrame([numbers], schema)).head()
    assert (got.errors, got.warnings, got.is_valid) == (errors, warnings, not errors)


def test_documents_split_but_stay_whole(spark, facts):
    one = reports.report_documents(facts).collect()
    assert len(one) == 1 and len(one[0].campaign_metrics) == 2
    assert one[0].total_metrics.impressions == 15_100
    many = reports.report_documents(facts, ads_per_document=1).collect()
    seen = [a.ad_id for d in many for c in d.campaign_metrics for s in c.adset_metrics for a in s.ad_metrics]
    assert sorted(seen) == ["a1", "a2", "a3"]
    assert {d.total_metrics.impressions for d in many} == {15_100}
    camp = {(c.campaign_id, c.impressions) for d in many for c in d.campaign_metrics}
    assert camp == {("camp_001", 15_000), ("camp_002", 100)}


def test_documents_keep_ads_of_unknown_parents(spark):
    rows = [("v", "c", "s", "a", 1), ("v", "c", None, "b", 2), ("v", None, None, "d", 4), ("v", None, "s", "a", 8),
            (None, None, None, None, 16)]
    columns = [*reports.HIERARCHY, *reports.METRICS]
    facts = spark.createDataFrame([(*r[:4], *[r[4]] * 4, 1.0, 2.0) for r in rows],
                                  ", ".join(f"{c} {t}" for c, t in zip(columns, ["string"] * 4 + ["long"] * 4 + ["double"] * 2)))
    for split in ({}, {"ads_per_document": 1}):
        got = reports.report_documents(facts, **split).collect()
        seen = {(d.advertiser_id, c.campaign_id, s.adset_id, a.ad_id, a.impressions, s.impressions, c.impressions, d.total_metrics.impressions)
                for d in got for c in d.campaign_metrics for s in c.adset_metrics for a in s.ad_metrics}
        assert seen == {("v", "c", "s", "a", 1, 1, 3, 15), ("v", "c", None, "b", 2, 2, 3, 15), ("v", None, None, "d", 4, 4, 12, 15),
                        ("v", None, "s", "a", 8, 8, 12, 15), (None, None, None, None, 16, 16, 16, 16)}
    assert len(reports.report_documents(facts).collect()) == 2


@pytest.mark.parametrize("n", [1, 2, 7, 1000])
def test_quantiles_match_exact_interpolation(spark, n):
    rng = random.Random(n)
    values = [float(rng.choice([rng.randint(0, 20), rng.random() * 1000])) for _ in range(n)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = {r.probability: r.value for r in ranks.quantile_cuts(
        df, {"m": F.col("v")}, [0.2, 0.4, 0.6, 0.8], buckets=16).collect()}
    for p in (0.2, 0.4, 0.6, 0.8):
        x = sorted(values)
        at = p * (n - 1)
        low = int(at)
        high = min(low + 1, n - 1)
        assert got[p] == pytest.approx(x[low] + (x[high] - x[low]) * (at - low))


def test_quantiles_with_one_dominant_value(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("v"))
    got = ranks.quantile_cuts(df, {"m": F.col("v")}, [0.5]).head().value
    assert got == statistics.median([5 if i % 3 == 0 else i for i in range(3000)])


def test_approximate_cuts_are_close(spark):
    got = {r.probability: r.value for r in ranks.approximate_cuts(
        spark.range(1001), {"m": F.col("id")}, [0.2, 0.8]).collect()}
    assert got[0.2] == pytest.approx(200, abs=2) and got[0.8] == pytest.approx(800, abs=2)


def test_batches_follow_key_order(spark):
    keys = random.Random(1).sample(range(100_000), 1234)
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    got = {r.k: r.batch for r in ranks.batches(df, "k", 100).collect()}
    assert got == {k: i // 100 for i, k in enumerate(sorted(keys))}


def brute_force_attribution(rows, keys, days):
    out = {}
    for c in rows:
        if c["event_type"] != "conversion":
            continue
        found = {}
        for kind in ("click", "impression"):
            touches = [
                (t["timestamp"], t["event_id"]) for t in rows
                if t["event_type"] == kind and None not in [c[k] for k in keys]
                and all(t[k] == c[k] for k in keys)
                and dt.timedelta(0) <= c["timestamp"] - t["timestamp"] <= dt.timedelta(days=days)]
            found[kind] = max(touches)[0] if touches else None
        out[c["event_id"]] = (found["click"], found["impression"])
    return out


@pytest.mark.parametrize("bucket", [600, 3600, 86_400 * 3])
def test_attribution_against_brute_force(spark, bucket):
    rng = random.Random(7)
    start = dt.datetime(2024, 1, 1)
    rows = [dict(
        event_id=i, event_type=rng.choice(["impression", "click", "conversion", "view"]),
        timestamp=start + dt.timedelta(minutes=rng.randint(0, 60 * 24 * 20)),
        # one user holds most of the rows, some are anonymous
        user_id=rng.choice([1, 1, 1, 2, 3, None]), ad_id=rng.randint(0, 3), revenue=1.0)
        for i in range(600)]
    df = spark.createDataFrame(
        [tuple(r.values()) for r in rows],
        "event_id long, event_type string, timestamp timestamp, user_id long, ad_id long, revenue double")
    for keys in (["user_id"], ["user_id", "ad_id"]):
        got = {r.conversion_id: (r.click_ts, r.impression_ts)
               for r in attribute_conversions(df, keys, 7, bucket).collect()}
        assert got == brute_force_attribution(rows, keys, 7)


def test_attribution_window_of_each_conversion(spark):
    start, days = dt.datetime(2024, 1, 1), dt.timedelta(days=1)
    rows = [(1, "click", start, 1, 5), (2, "impression", start + 19 * days, 1, 6)] + [
        (10 + i, "conversion", start + 20 * days, 1, window) for i, window in enumerate([30, 20, 19, 7, 1, 0, None])]
    df = spark.createDataFrame([(*r[:4], 0, 1.0, r[4]) for r in rows], "event_id long, event_type string, timestamp timestamp, "
                               "user_id long, ad_id long, revenue double, attribution_window_days int")
    got = {r.conversion_id: (r.click_ts is not None, r.impression_ts is not None)
           for r in attribute_conversions(df, ["user_id"]).collect()}
    # a window of 20 days reaches the click of that very moment, one of 1 day the impression
    assert [got[10 + i] for i in range(7)] == [(True, True), (True, True), (False, True), (False, True), (False, True), (False, False), (False, True)]
    default = {r.conversion_id: r.click_ts is not None for r in attribute_conversions(df, ["user_id"], window_days=25).collect()}
    assert [default[10 + i] for i in range(7)] == [True, True, False, False, False, False, True]


def test_dedup_is_idempotent(spark):
    df = spark.range(500).select((F.col("id") % 50).alias("event_id"), F.col("id").alias("ts"))
    once = dedup.drop_duplicates(df, ["event_id"], [F.col("ts")])
    assert sorted(r.ts for r in once.collect()) == list(range(50))
    assert dedup.drop_duplicates(once, ["event_id"], [F.col("ts")]).count() == 50


def test_first_per_key_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = windows.first_per_key(df, ["k"], [F.col("id")])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_duplicate_accounting(spark):
    df = spark.createDataFrame([("p", 1), ("p", 1), ("p", 2), ("q", 9)], "part string, id long")
    got = {r.part: r for r in dedup.duplicate_accounting(df, ["id"], ["part"]).collect()}
    assert (got["p"].input_rows, got["p"].output_rows, got["p"].duplicates_removed) == (3, 2, 1)
    assert got["p"].dedup_ratio == pytest.approx(1 / 3) and got["q"].dedup_ratio == 0.0


@pytest.mark.parametrize("outcome, errors", [
    ((True, 1000, 990, 10, 100, 70), []),
    ((True, 1000, 0, 1000, 100, 0), ["dedup_ratio_above_limit", "no_output_rows", "row_loss_above_limit"]),
    ((True, 1000, 800, 200, 100, 70), ["dedup_ratio_above_limit", "row_loss_above_limit"]),
    ((False, 1000, 0, 0, 100, 900), ["run_failed"]),
    ((True, 1000, 990, 10, 100, 120), ["output_larger_than_input"]),
    ((True, 0, 0, 0, 100, 70), ["no_input_rows", "no_output_rows"]),
    ((True, 1000, 990, 5, 100, 70), ["row_counts_disagree"])])
def test_compaction_validation(spark, outcome, errors):
    schema = ("success boolean, input_rows long, output_rows long, duplicates_removed long, "
              "input_bytes long, output_bytes long")
    got = compaction.validate(spark.createDataFrame([outcome], schema)).head()
    assert sorted(got.errors) == errors and got.is_valid == (not errors)


def test_compaction_ratios(spark):
    schema = ("success boolean, input_rows long, output_rows long, duplicates_removed long, "
              "input_bytes long, output_bytes long")
    got = compaction.validate(spark.createDataFrame([(True, 1000, 950, 50, 1000, 700)], schema)).head()
    assert got.dedup_ratio == pytest.approx(0.05) and got.compression_ratio == pytest.approx(0.30)


MB = 1024 * 1024


@pytest.mark.parametrize("sizes, jobs", [([10, 15, 20], 1), ([10], 0), ([200, 10], 0), ([64, 64], 0)])
def test_compaction_plan(spark, sizes, jobs):
    files = spark.createDataFrame([("p/", f"p/{i}", s * MB) for i, s in enumerate(sizes)],
                                  "prefix string, path string, size long")
    got = compaction.plan_jobs(files).collect()
    assert len(got) == jobs
    if jobs:
        assert got[0].input_file_count == 3 and got[0].total_input_bytes == 45 * MB
        saved = compaction.estimate_savings(compaction.planned_files(files, compaction.plan_jobs(files)), files)
        assert saved.head().estimated_savings_pct == pytest.approx(35.0)


def test_savings_of_no_jobs(spark):
    files = spark.createDataFrame([], "prefix string, path string, size long")
    plan = compaction.planned_files(files, compaction.plan_jobs(files))
    got = compaction.estimate_savings(plan, files).head()
    assert got.jobs_planned == 0 and got.estimated_savings_pct == 0.0


def test_partition_specs(spark):
    days = spark.createDataFrame([(dt.date(2024, 1, 15),)], "day date")
    assert joins.expected_partitions(days, S.PARTITIONED_EVENT_TYPES).count() == 120
    two = joins.expected_partitions(days, ("impression", "click"))
    assert two.count() == 48
    done = two.where("hour < 5")
    assert joins.pending_partitions(two, done).count() == 38
    assert joins.finished_partitions(two, done).count() == 10
    assert joins.pending_partitions(two, two).count() == 0


def test_fold_prefers_new_values(spark):
    old = spark.createDataFrame([(1, 10), (2, 20)], "k long, v long")
    new = spark.createDataFrame([(2, 21), (3, 30)], "k long, v long")
    assert {(r.k, r.v) for r in joins.fold_state(old, new, "k").collect()} == {(1, 10), (2, 21), (3, 30)}


def test_rolling_hours_respects_gaps(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [("a", t + dt.timedelta(hours=h), 1) for h in (0, 1, 5, 6, 30)]
    df = spark.createDataFrame(rows, "k string, hour_start timestamp, n long")
    got = [(r.n_1h, r.n_6h, r.n_24h) for r in windows.rolling_hours(df, ["k"], ["n"])
           .orderBy("hour_start").collect()]
    assert got == [(1, 1, 1), (1, 2, 2), (1, 3, 3), (1, 3, 4), (1, 1, 1)]


# ---- rules -------------------------------------------------------------------

@pytest.fixture
def people(spark):
    return spark.createDataFrame(
        [(1, "US", 5, "spring sale"), (2, "DE", 50, "autumn"), (3, None, 500, None)],
        "user_id long, country string, clicks long, note string")


@pytest.mark.parametrize("operator, field, value, end, users", [
    ("equals", "country", "US", None, [1]), ("not_equals", "country", "US", None, [2]),
    ("greater_than", "clicks", 50, None, [3]), ("less_than", "clicks", 50, None, [1]),
    ("gte", "clicks", 50, None, [2, 3]), ("lte", "clicks", 50, None, [1, 2]),
    ("in", "country", ["US", "DE"], None, [1, 2]), ("not_in", "country", ["US"], None, [2]),
    ("contains", "note", "sale", None, [1]), ("between", "clicks", 5, 50, [1, 2])])
def test_each_comparison(people, operator, field, value, end, users):
    column = Condition(field, operator, value, end).column()
    assert sorted(r.user_id for r in people.where(column).collect()) == users


def test_nested_criteria(people):
    spec = {"logic": "OR", "rules": [{"field": "country", "operator": "equals", "value": "US"}],
            "nested_criteria": [{"rules": [
                {"field": "clicks", "operator": "gte", "value": 50},
                {"field": "country", "operator": "equals", "value": "DE"}]}]}
    criteria = Criteria.from_dict(spec)
    got = tag_segments(people, {"x": criteria, "all": Criteria("AND", (Condition("clicks", "gte", 0),))})
    assert sorted((r.user_id, r.segment_id) for r in got.collect()) == [
        (1, "all"), (1, "x"), (2, "all"), (2, "x"), (3, "all")]


def test_bad_rules_are_refused():
    assert Criteria().is_empty
    with pytest.raises(ValueError):
        Criteria().column()
    with pytest.raises(ValueError):
        Condition("a", "like", 1).column()
    with pytest.raises(ValueError):
        Condition("a", "between", 1).column()
    with pytest.raises(ValueError):
        Criteria("XOR", (Condition("a", "equals", 1),)).column()


# ---- quality -----------------------------------------------------------------

def test_null_grades(spark):
    df = spark.range(100).select(
        F.when(F.col("id") >= 60, 1).alias("user_id"), F.when(F.col("id") >= 30, 1).alias("campaign_id"),
        F.when(F.col("id") >= 6, 1).alias("ad_id"), F.when(F.col("id") >= 5, 1).alias("event_type"))
    got = {r.column: r.grade for r in quality.null_grades(df).collect()}
    assert got == {"user_id": "critical", "campaign_id": "warning", "ad_id": "minor", "event_type": "ok"}
    assert {r.grade for r in quality.null_grades(df.limit(0)).collect()} == {"empty_table"}


def test_checks_and_enforcement(spark):
    df = spark.range(10).withColumn("v", F.when(F.col("id") > 2, F.col("id")))
    checks = [
        quality.Check("rows", "row_count", threshold=10),
        quality.Check("nulls", "null_ratio", column="v", threshold=0.3),
        quality.Check("cols", "schema", columns=("id", "x"), warning_only=True),
        quality.Check("absent", "null_ratio", column="nope", threshold=1.0),
        quality.Check("range", "range", column="v", low=0, high=9),
        quality.Check("own", "condition", condition=F.col("id") < 9)]
    results = quality.run_checks(df, checks)
    assert [r.passed for r in results.orderBy("position").collect()] == [True, False, False, False, True, False]
    first = quality.run_checks(df, checks, stop_at_first_failure=True)
    assert [r.check for r in first.orderBy("position").collect()] == ["rows", "nulls"]
    summary = quality.summarise(results).head()
    assert (summary.total_checks, summary.passed, summary.failed, summary.warnings) == (6, 2, 3, 1)
    with pytest.raises(quality.QualityError, match="3 checks failed: absent, nulls, own"):
        quality.enforce(results)
    quality.enforce(quality.run_checks(df, checks[:1]))
    with pytest.raises(ValueError):
        quality.run_checks(df, [quality.Check("x", "custom")])


def test_missing_columns(spark):
    df = spark.range(1).select("id", F.lit(1).alias("extra"))
    assert quality.missing_columns(df, ["id"]) == []
    assert quality.missing_columns(df, ["z", "id", "b"]) == ["b", "z"]


def test_segment_checks(spark):
    sizes = spark.createDataFrame([("lost", 700, 0.7), ("loyal", 300, 0.3)], "tier string, users long, share double")
    got = quality.segment_checks(sizes, ("lost", "loyal", "champions"), min_total=1000).head()
    assert got.missing == ["champions"] and got.dominating == ["lost"] and not got.too_few_users
    assert not got.is_valid
    assert quality.segment_checks(sizes, ("lost",), min_total=1001).head().too_few_users


def event(**changes):
    base = dict(
        event_id="e", event_type="impression", ad_id="a", campaign_id="c", adset_id="s",
        advertiser_id="v", publisher_id="p", placement_id="l", timestamp=dt.datetime(2024, 1, 15, 12),
        user_id=None, session_id=None, device_type="mobile", country_code="us", platform="ios",
        revenue=0.0015, cost=0.001, metadata="{}")
    return base | changes


@pytest.mark.parametrize("changes, errors", [
    ({}, []), ({"revenue": -1.0}, ["negative_revenue"]), ({"cost": -0.1}, ["negative_cost"]),
    ({"event_type": "swipe"}, ["unknown_event_type"]), ({"device_type": "watch"}, ["unknown_device_type"]),
    ({"ad_id": None}, ["missing_ad_id"])])
def test_ad_event_rules(spark, changes, errors):
    open_schema = "struct<" + ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in S.AD_EVENT) + ">"
    df = spark.createDataFrame([event(**changes)], open_schema.replace("struct<", "").rstrip(">"))
    assert validation.with_errors(df, validation.ad_event_rules()).head().errors == errors


def test_normalise(spark):
    df = spark.createDataFrame([(None, "de", None), ("ctv", None, 2.0)],
                               "device_type string, country_code string, revenue double")
    got = validation.normalise(df, S.AD_EVENT_DEFAULTS).collect()
    assert [tuple(r) for r in got] == [("unknown", "DE", 0.0), ("ctv", "US", 2.0)]


def test_incremental_state_equals_rebuild(spark, small):
    events = log.ad_events(spark, small)
    reference, since = dt.date(2024, 2, 10), dt.date(2024, 1, 20)
    days = segments.user_days(events)
    stale = days.where(F.col("day") < F.lit(dt.date(2024, 1, 25)))
    merged = segments.replace_days(stale, days, since)
    a = segments.user_features(merged, reference).orderBy("user_id").collect()
    b = segments.user_features(days, reference).orderBy("user_id").collect()
    assert [(r.user_id, r.click_count_30d, round(r.total_spend_90d, 6)) for r in a] == [
        (r.user_id, r.click_count_30d, round(r.total_spend_90d, 6)) for r in b]


def test_never_converted_keeps_null_recency(spark):
    df = spark.createDataFrame(
        [(1, "impression", dt.datetime(2024, 2, 1), 0.0)],
        "user_id long, event_type string, timestamp timestamp, revenue double")
    got = segments.user_features(segments.user_days(df), dt.date(2024, 2, 10)).head()
    assert got.days_since_last_conversion is None and got.days_since_last_impression == 9.0


def test_fences_and_flagged_rows(spark):
    from adlumen.operators import quality

    values = [1.0, 2.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 100.0, -80.0, None]
    df = spark.createDataFrame([(i, v, -v if v is not None else None) for i, v in enumerate(values)], "id long, a double, b double")
    metrics = {"a": F.col("a"), "b": F.col("b")}
    known = sorted(v for v in values if v is not None)

    def at(share, data):
        place = share * (len(data) - 1)
        low = int(place)
        return data[low] + (data[min(low + 1, len(data) - 1)] - data[low]) * (place - low)

    q1, q3, middle = at(.25, known), at(.75, known), at(.5, known)
    spread = at(.5, sorted(abs(v - middle) for v in known)) * 1.4826 * 3
    by_quartiles = quality.quartile_fences(df, metrics)
    by_median = quality.median_fences(df, metrics)
    got = {r.metric: (r.low, r.high) for r in by_quartiles.collect()}
    assert got["a"] == pytest.approx((q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)))
    assert got["b"] == pytest.approx((-got["a"][1], -got["a"][0]))
    assert {r.metric: (r.low, r.high) for r in by_median.collect()}["a"] == pytest.approx((middle - spread, middle + spread))
    for fences in (by_quartiles, by_median):
        flagged = {r.id: r.outliers for r in quality.flag_outliers(df, fences, metrics).collect()}
        assert {i: x for i, x in flagged.items() if x} == {8: ["a", "b"], 9: ["a", "b"]} and flagged[10] == []
    empty = quality.flag_outliers(df.limit(0), quality.quartile_fences(df.limit(0), metrics), metrics)
    assert empty.count() == 0
    # without values there is no fence, and nothing is outside of it
    nulls = df.select("id", F.lit(None).cast("double").alias("a"))
    assert {tuple(r.outliers) for r in quality.flag_outliers(nulls, quality.median_fences(nulls, {"a": F.col("a")}), {"a": F.col("a")}).collect()} == {()}


def test_fence_checks(spark):
    from adlumen.operators.quality import Check, run_checks

    df = spark.createDataFrame([(float(v),) for v in [*range(1, 20), 500]], "a double")
    checks = [Check("q", "quartile_fence", "a", threshold=0.04), Check("m", "median_fence", "a", threshold=0.05),
              Check("x", "median_fence", "absent")]
    got = {r.check: (r.passed, r.actual) for r in run_checks(df, checks).collect()}
    assert got == {"q": (False, 0.05), "m": (True, 0.05), "x": (False, None)}
    assert {r.check: (r.passed, r.actual) for r in run_checks(df.limit(0), checks[:2]).collect()} == {"q": (True, 0.0), "m": (True, 0.0)}


def test_merged_sketches_stay_within_the_bound(spark, tmp_path):
    from adlumen.operators import sketches

    df = spark.range(60_000).selectExpr(
        "id % 30 AS day", "if(id % 3 = 0, 7.0D, exp(randn(5) * 2)) AS v", "if(id % 50 = 0, NULL, double(id * 7919 % 60000)) AS w")
    metrics = {"v": F.col("v"), "w": F.col("w")}
    df.write.parquet(str(tmp_path / "values"))  # random values are drawn once
    df = spark.read.parquet(str(tmp_path / "values"))
    states = sketches.quantile_states(df, metrics, "day")
    assert states.count() == 60
    cuts = sketches.merged_cuts(states.where("day < 20"), [0.01, 0.2, 0.5, 0.8, 0.99])
    judged = sketches.rank_errors(cuts, df.where("day < 20"), metrics).collect()
    assert len(judged) == 10 and all(r.rank_error <= sketches.RANK_ERROR for r in judged)
    assert {r.n for r in judged if r.metric == "w"} == {df.where("day < 20 AND w IS NOT NULL").count()}
    # states of states are states: two halves merged give the same bound
    late = sketches.rank_errors(sketches.merged_cuts(states, [0.5], "day"), df, metrics, "day").collect()
    assert len(late) == 60 and max(r.rank_error for r in late) <= sketches.RANK_ERROR
    assert sketches.quantile_states(df.limit(0), metrics, "day").count() == 0


def _rule_users(spark):
    import random

    rng = random.Random(11)
    rows = [(i, rng.choice([None, *range(-3, 12)]), rng.choice([None, 0.0, 0.5, 1.0, 2.5, 7.0]), rng.choice([None, "a", "ab", "b", "loyal", ""]))
            for i in range(300)]
    return spark.createDataFrame(rows, "user_id long, n int, x double, s string")


def _rule_sets(n):
    import random

    from adlumen.operators.rules import Condition, Criteria

    rng = random.Random(n)

    def condition():
        f = rng.choice("nxs")
        if f == "s":
            op = rng.choice(["equals", "not_equals", "in", "not_in", "contains"])
            value = rng.sample(["a", "b", "ab", "loyal", "zz", ""], 2) if op in ("in", "not_in") else rng.choice(["a", "b", "oy", "ab"])
            return Condition(f, op, value)
        op = rng.choice(["equals", "not_equals", "greater_than", "less_than", "gte", "lte", "in", "not_in", "between"])
        one, two = rng.randrange(-4, 12), rng.randrange(-4, 12)
        if f == "x":
            one = one / 2
        return Condition(f, op, [one, two] if op in ("in", "not_in") else one, two if op == "between" else None)

    def criteria(depth):
        groups = tuple(criteria(depth - 1) for _ in range(rng.randrange(3))) if depth else ()
        return Criteria(rng.choice(["AND", "OR"]), tuple(condition() for _ in range(rng.randrange(0 if groups else 1, 3))), groups)

    out = {}
    while len(out) < n:
        made = criteria(2)
        if not made.is_empty:
            out[f"s{len(out)}"] = made
    return out


def test_rule_index_gives_what_compiled_rules_give(spark):
    from adlumen.operators.rule_index import RuleIndex, tag_by_index
    from adlumen.operators.rules import tag_segments

    users, rules = _rule_users(spark), _rule_sets(60)
    got = sorted(map(tuple, tag_by_index(users, RuleIndex.build(rules)).collect()))
    assert got == sorted(map(tuple, tag_segments(users, rules).collect())) and len({s for _, s in got}) > 40
    assert tag_by_index(users.limit(0), RuleIndex.build(rules)).count() == 0


def test_rule_index_plan_does_not_grow_with_the_rules(spark):
    from adlumen.operators.rule_index import RuleIndex, tag_by_index
    from adlumen.operators.rules import Condition, Criteria

    users = _rule_users(spark)

    def bands(n):
        return {f"b{i}": Criteria("AND", (Condition("x", "gte", i / 100), Condition("n", "less_than", i % 9))) for i in range(n)}

    def branches(df):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        return plan.count("CASE WHEN"), len([x for x in plan.split("\n") if x.strip()])

    small, large = (tag_by_index(users, RuleIndex.build(bands(n))) for n in (10, 1_000))
    assert branches(small) == branches(large)
    want = users.where("x IS NOT NULL AND n IS NOT NULL").collect()
    assert large.count() == sum(u.x >= i / 100 and u.n < i % 9 for u in want for i in range(1_000))


def test_rule_index_refuses_what_compiled_rules_refuse():
    from adlumen.operators.rule_index import RuleIndex
    from adlumen.operators.rules import Condition, Criteria

    for bad in (Criteria(), Criteria("XOR", (Condition("n", "equals", 1),)), Criteria("AND", (Condition("n", "like", 1),)),
                Criteria("AND", (Condition("n", "between", 1),))):
        with pytest.raises(ValueError):
            RuleIndex.build({"x": bad})
    wide = Criteria("AND", groups=tuple(Criteria("OR", tuple(Condition("n", "equals", i) for i in range(10))) for _ in range(4)))
    with pytest.raises(ValueError):
        RuleIndex.build({"x": wide})


def test_decay_state_moves_like_a_new_start(spark):
    import random

    from adlumen.operators import decay_state

    rng, begin = random.Random(2), dt.datetime(2024, 1, 1)
    rows = [(k, begin + dt.timedelta(hours=h), rng.choice([0, 5, 9]), rng.randrange(3), rng.randrange(2), rng.random())
            for k in (1, 2, None) for h in range(100) if rng.random() < 0.3]
    rows.append((7, begin + dt.timedelta(hours=3), 0, 0, 0, 0.0))
    hourly = spark.createDataFrame(rows, "ad long, hour_start timestamp, impressions long, clicks long, conversions long, revenue double")

    def seen(state):
        return {r.ad: tuple(r)[1:] for r in decay_state.means(state, ["ad"]).collect()}

    at = begin + dt.timedelta(hours=10)
    state = decay_state.start(hourly, ["ad"], at)
    assert 7 in seen(state) and seen(state)[7][1:] == (0.0, 0.0, 0.0)
    for hours in (0, 1, 3, 24, 30, 7):
        new = at + dt.timedelta(hours=hours)
        state, at = decay_state.advance(state, hourly, ["ad"], at, new), new
        got, want = seen(state), seen(decay_state.start(hourly, ["ad"], at))
        assert got.keys() == want.keys() and (7 in got) == (at <= begin + dt.timedelta(hours=27))
        for k in got:
            assert got[k][0] == want[k][0] and got[k][1:] == pytest.approx(want[k][1:], abs=1e-9)
    with pytest.raises(ValueError):
        decay_state.advance(state, hourly, ["ad"], at, begin)
    assert decay_state.start(hourly.limit(0), ["ad"], at).count() == 0
