"""Formulas on single rows, with hand-computed values."""

import datetime as dt
import itertools
import math

import pytest
from pyspark.sql import functions as F

from adlumen.functions import decay, rates, rfm, storage as st, text, times
from adlumen.schemas import RFM_TIERS

MB = 1024 * 1024
COUNTS = "impressions long, clicks long, conversions long, spend double, revenue double"


def kpis(spark, *numbers):
    return spark.createDataFrame([numbers], COUNTS).select(
        *[c.alias(n) for n, c in rates.kpi_columns().items()]).head().asDict()


def test_kpis(spark):
    got = kpis(spark, 10_000, 200, 10, 100.0, 500.0)
    assert got == pytest.approx(
        {"ctr": 0.02, "cvr": 0.05, "cpa": 10, "cpc": 0.5, "cpm": 10, "roas": 5, "ecpm": 50})


def test_kpis_of_nothing_are_zero(spark):
    assert set(kpis(spark, 0, 0, 0, 0.0, 0.0).values()) == {0.0}


@pytest.mark.parametrize("clicks, impressions, expected", [
    (20, 1000, 20.001 / 1001), (1, 5, 0.001), (0, 0, 0.001), (3, 10, 3.001 / 11)])
def test_smoothed_ctr(value, spark, clicks, impressions, expected):
    assert value(rates.smoothed_ctr(F.lit(clicks), F.lit(impressions))) == pytest.approx(expected)
    by_name = spark.createDataFrame([(clicks, impressions)], "c long, i long").select(
        rates.smoothed_ctr("c", "i").alias("v")).head().v
    assert by_name == pytest.approx(expected)


def test_smoothed_cvr(value):
    assert value(rates.smoothed_cvr(F.lit(5), F.lit(100))) == pytest.approx(5.0001 / 101)
    assert value(rates.smoothed_cvr(F.lit(5), F.lit(9))) == 0.0001


def test_ecpm(value):
    assert value(rates.per_mille(F.lit(10.0), F.lit(5000))) == 2.0
    assert value(rates.per_mille(F.lit(10.0), F.lit(0))) == 0.0


def decayed(spark, pairs):
    df = spark.createDataFrame(pairs, "v double, age double")
    return df.agg(decay.decayed_mean(F.col("v"), F.col("age")).alias("m")).head().m


def test_decayed_mean(spark):
    assert decayed(spark, [(0.5, 0.0)]) == pytest.approx(0.5)
    assert decayed(spark, []) == 0.0
    assert decayed(spark, [(1.0, 0.0), (0.0, 6.0)]) == pytest.approx(1 / 1.5)
    assert 0 < decayed(spark, [(0.0, 0.0), (1.0, 24.0)]) < 1
    # the future takes no part
    assert decayed(spark, [(1.0, 0.0), (9.0, -1.0)]) == pytest.approx(1.0)


def test_half_life(value):
    assert value(decay.decay_weight(F.lit(6.0))) == pytest.approx(0.5)
    assert value(decay.decay_weight(F.lit(3.0), 1.0)) == pytest.approx(math.exp(-3 * math.log(2)))


RECENCY, FREQUENCY, MONETARY = [10, 30, 60, 90], [5, 10, 20, 50], [10, 50, 100, 200]


@pytest.mark.parametrize("days, count, spend, expected", [
    (2.0, 100, 500.0, (5, 5, 5)), (200.0, 1, 0.0, (1, 1, 1)), (10.0, 5, 10.0, (4, 2, 2)),
    (None, 1, 0.0, (1, 1, 1))])
def test_rfm_scores(value, days, count, spend, expected):
    def cuts(limits):
        return [F.lit(x) for x in limits]

    recency = rfm.descending_score(F.lit(days).cast("double"), cuts(RECENCY))
    got = (value(recency), value(rfm.ascending_score(F.lit(count), cuts(FREQUENCY))),
           value(rfm.ascending_score(F.lit(spend), cuts(MONETARY))))
    assert got == expected


def all_scores(spark):
    return spark.createDataFrame(list(itertools.product(range(1, 6), repeat=3)), "r int, f int, m int")


def test_every_score_has_a_tier(spark):
    scores = all_scores(spark)
    r, f, m = F.col("r"), F.col("f"), F.col("m")
    tiers = {x.c: x.t for x in scores.select(
        rfm.rfm_code(r, f, m).alias("c"), rfm.rfm_tier(r, f, m).alias("t")).collect()}
    assert len(tiers) == 125 and set(tiers.values()) == set(RFM_TIERS) - {"cant_lose"}
    assert [tiers[c] for c in ("555", "355", "511", "243", "111")] == [
        "champions", "loyal", "new_users", "at_risk", "lost"]
    assert tiers["333"] == "potential_loyal" and tiers["321"] == "hibernating"


def test_cant_lose_variant(spark):
    r, f, m = F.col("r"), F.col("f"), F.col("m")
    rows = all_scores(spark).where(rfm.rfm_tier(r, f, m, separate_cant_lose=True) == "cant_lose").collect()
    assert {(x.r, x.f, x.m) for x in rows} == set(itertools.product((1, 2), (4, 5), (4, 5)))


def engagement(value, ctr, cvr, impressions, days):
    return value(rfm.engagement_score(F.lit(ctr), F.lit(cvr), F.lit(impressions), F.lit(days)))


def test_engagement(value):
    assert engagement(value, 0.2, 0.1, 5000, 0) == pytest.approx(1.0)
    assert engagement(value, 0.0, 0.0, 0, 90) == pytest.approx(0.0)
    assert engagement(value, 0.05, 0.05, 500, 45) == pytest.approx(0.15 + 0.3 + 0.1 + 0.1)
    assert engagement(value, 0.0, 0.0, 0, None) == pytest.approx(0.0)


def test_partition_prefix(value):
    got = value(st.partition_prefix(F.lit(2024), F.lit(1), F.lit(15), F.lit(8), F.lit("impression")))
    assert got == "year=2024/month=01/day=15/hour=08/event_type=impression"
    day = st.partition_prefix(F.lit(2024), F.lit(1), F.lit(5))
    assert value(day) == "year=2024/month=01/day=05"
    assert value(st.partition_uri("b", day)) == "s3://b/events/year=2024/month=01/day=05/"


def test_file_sizes(value):
    assert value(st.needs_merge(F.lit(30 * MB))) and not value(st.needs_merge(F.lit(64 * MB)))
    assert value(st.needs_split(F.lit(600 * MB))) and not value(st.needs_split(F.lit(512 * MB)))


@pytest.mark.parametrize("mb, files", [(512, 2), (100, 1), (0, 1), (384, 2), (640, 2), (900, 4)])
def test_split_count_rounds_half_to_even(value, mb, files):
    assert value(st.split_count(F.lit(mb * MB))) == files == max(1, round(mb / 256))


def test_repartition_estimate(spark):
    e = st.repartition_estimate(F.lit(1000), F.lit(1024 * MB))
    got = spark.range(1).select(*[v.alias(k) for k, v in e.items()]).head()
    assert got.estimated_seconds == pytest.approx(1024 / 100 + 1024 / 50)
    assert got.estimated_output_files == 4
    assert got.estimated_cost_usd == pytest.approx(0.0004 + 4 / 1000 * 0.005 + 0.09)


@pytest.mark.parametrize("age, a7, a30, tier", [
    (5, 0, 0, "hot"), (400, 10, 0, "hot"), (45, 0, 0, "warm"), (400, 9, 3, "warm"),
    (200, 0, 2, "cold"), (365, 0, 0, "archive"), (29, 0, 0, "hot"), (30, 0, 0, "warm"),
    (90, 0, 0, "cold")])
def test_tiers(value, age, a7, a30, tier):
    assert value(st.target_tier(F.lit(age), F.lit(a7), F.lit(a30))) == tier


def test_savings_are_never_negative(value):
    gb = F.lit(10 * 1024 * MB)
    assert value(st.monthly_savings(gb, F.lit("hot"), F.lit("cold"))) == pytest.approx(0.19)
    assert value(st.monthly_savings(gb, F.lit("cold"), F.lit("hot"))) == 0.0


def test_tier_order(value):
    ranks = [value(st.tier_rank(F.lit(t))) for t in ("hot", "warm", "cold", "archive")]
    assert ranks == sorted(ranks) and len(set(ranks)) == 4


def test_age_is_elapsed_not_calendar(value):
    ts = F.lit(dt.datetime(2024, 1, 1, 23, 0)).cast("timestamp")
    assert value(times.age_days(ts, F.lit(dt.datetime(2024, 1, 2, 1, 0)))) == 0
    assert value(times.age_days(ts, F.lit(dt.datetime(2024, 1, 3, 23, 0)))) == 2
    assert value(times.age_hours(ts, F.lit(dt.datetime(2024, 1, 2, 0, 30)))) == 1.5


def test_rebuild_mode(value):
    monday, tuesday = F.lit(dt.date(2024, 1, 15)), F.lit(dt.date(2024, 1, 16))
    assert value(times.is_full_rebuild(monday)) and not value(times.is_full_rebuild(tuesday))
    assert value(times.is_full_rebuild(tuesday, forced=True))
    start = times.lookback_start(tuesday, times.is_full_rebuild(tuesday))
    assert value(start) == dt.date(2024, 1, 9)


def test_expiry_and_period(value):
    at = F.lit(dt.datetime(2024, 1, 31, 12)).cast("timestamp")
    assert value(times.expires_at(at)) == dt.datetime(2024, 2, 1, 12)
    assert value(times.period_days(F.lit(dt.date(2024, 1, 1)), F.lit(dt.date(2024, 1, 31)))) == 31


@pytest.mark.parametrize("address, ok", [
    ("a.b+c@mail.example.com", True), ("a@b.co", True), ("@b.co", False), ("a@b", False),
    ("a b@c.de", False), ("a@b.c", False), ("a@-.com", False),
    ("a..b@c.de", False), (".a@c.de", False), ("a" * 65 + "@c.de", False), ("a@b--c.de", True)])
def test_email(value, address, ok):
    assert value(text.is_email(F.lit(address))) is ok


def test_metric_name(value):
    tags = F.create_map(F.lit("task"), F.lit("load"), F.lit("dag"), F.lit("x"))
    assert value(text.metric_name(F.lit("rows"), tags)) == "rows.dag_x.task_load"
    none = F.create_map().cast("map<string,string>")
    assert value(text.metric_name(F.lit("rows"), none)) == "rows"
    assert value(text.metric_name(F.lit("rows"), F.lit(None).cast("map<string,string>"))) == "rows"
