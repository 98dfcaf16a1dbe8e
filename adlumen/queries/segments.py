"""Segmentation queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from adlumen.functions.times import is_full_rebuild, lookback_start
from adlumen.operators.joins import fold_state
from adlumen.operators.quality import missing_values_of, segment_checks
from adlumen.operators import sketches
from adlumen.operators.rule_index import RuleIndex, tag_by_index
from adlumen.operators.rules import Condition, Criteria, tag_segments
from adlumen.plans import segments as plan
from adlumen.queries.common import AD, USER_REFERENCE, joined, query, rounded, sql_ratio
from adlumen.schemas import RFM_TIERS
from adlumen.session import shared_dir
from adlumen.sinks.tables import membership_entries
from adlumen.sources import eventlog as log

QUERIES: dict = {}
SQL: dict[str, str] = {}

_PATCH_FROM = dt.date(2024, 1, 24)
_KINDS = ("impression", "click", "conversion")
_COUNTS = [f"{k}_count_{w}d" for w in (30, 90) for k in _KINDS]
_DOUBLES = ["total_spend_30d", "total_spend_90d", "days_since_last_impression",
            "days_since_last_click", "days_since_last_conversion", "avg_order_value",
            "ctr_30d", "cvr_30d"]
_REF = f"TIMESTAMP '{USER_REFERENCE} 00:00:00'"


def _features(spark, folder):
    return plan.user_features(plan.user_days(log.ad_events(spark, folder)), USER_REFERENCE)


def _tiers(spark, folder, **options):
    users = plan.qualified(plan.with_engagement(_features(spark, folder)))
    return plan.with_rfm(users, plan.rfm_cuts(users), **options)


def _uf_sql(source: str = "ad") -> str:
    recent = f"ts >= {_REF} - INTERVAL 30 DAY"
    counts = ", ".join(
        f"count(*) FILTER (event_type = '{k}'{' AND ' + recent if w == 30 else ''}) AS {k}_count_{w}d"
        for w in (30, 90) for k in _KINDS)
    since = ", ".join(
        f"(epoch_us({_REF}) - epoch_us(max(ts) FILTER (event_type = '{k}'))) / 86400e6 AS days_since_last_{k}"
        for k in _KINDS)
    return f"""u0 AS (SELECT user_id, {counts}, {since},
   sum(CASE WHEN {recent} THEN revenue ELSE 0 END) AS total_spend_30d, sum(revenue) AS total_spend_90d
   FROM {source} WHERE user_id IS NOT NULL AND event_type IN ('impression', 'click', 'conversion')
     AND ts >= {_REF} - INTERVAL 90 DAY AND ts < {_REF} GROUP BY user_id),
uf AS (SELECT *, {sql_ratio('total_spend_30d', 'conversion_count_30d')} AS avg_order_value,
   {sql_ratio('click_count_30d', 'impression_count_30d')} AS ctr_30d,
   {sql_ratio('conversion_count_30d', 'click_count_30d')} AS cvr_30d FROM u0)"""


_UF_OUT = f"user_id, {', '.join(_COUNTS)}, {', '.join(f'round({c}, 6) AS {c}' for c in _DOUBLES)}"


@query(QUERIES)
def user_features(spark, folder):
    return rounded(_features(spark, folder).select("user_id", *_COUNTS, *_DOUBLES))


SQL["user_features"] = f"WITH {AD}, {_uf_sql()} SELECT {_UF_OUT} FROM uf"


@query(QUERIES)
def qualified_users(spark, folder):
    return plan.qualified(_features(spark, folder)).select("user_id", "impression_count_90d")


SQL["qualified_users"] = f"""WITH {AD}, {_uf_sql()}
SELECT user_id, impression_count_90d FROM uf WHERE impression_count_90d >= 5"""


_ENGAGEMENT = """least(ctr_30d / 0.10, 1.0) * 0.3 + least(cvr_30d / 0.05, 1.0) * 0.3
  + least(impression_count_30d / 1000, 1.0) * 0.2
  + greatest(0.0, 1.0 - coalesce(days_since_last_impression, 90) / 90) * 0.2"""


@query(QUERIES)
def engagement_score(spark, folder):
    return rounded(plan.with_engagement(_features(spark, folder)).select("user_id", "engagement_score"))


SQL["engagement_score"] = f"""WITH {AD}, {_uf_sql()}
SELECT user_id, round({_ENGAGEMENT}, 6) AS engagement_score FROM uf"""


@query(QUERIES)
def rfm_thresholds(spark, folder):
    return rounded(plan.rfm_cuts(plan.qualified(_features(spark, folder))))


_METRIC_SQL = {
    "recency": "days_since_last_conversion",
    "frequency": "impression_count_90d + click_count_90d + conversion_count_90d",
    "monetary": "total_spend_90d",
}
_QUSERS = f"""{_uf_sql()},
q AS (SELECT *, {_ENGAGEMENT} AS engagement_score, {', '.join(f'{e} AS {n}' for n, e in _METRIC_SQL.items())}
      FROM uf WHERE impression_count_90d >= 5)"""
SQL["rfm_thresholds"] = f"WITH {AD}, {_QUSERS}\n" + "\nUNION ALL ".join(
    f"SELECT '{n}' AS metric, CAST({p} AS DOUBLE) AS probability, "
    f"round(quantile_cont(CAST({n} AS DOUBLE), {p}), 6) AS value FROM q"
    for n in _METRIC_SQL for p in plan.QUINTILES)


def _score_sql(metric: str, inverse: bool) -> str:
    cut = [f"{metric}_cut[{i}]" for i in (1, 2, 3, 4)]
    if inverse:
        steps = [f"WHEN {metric} IS NULL THEN 1"] + [
            f"WHEN {metric} >= {c} THEN {i}" for i, c in enumerate(reversed(cut), 1)]
    else:
        steps = [f"WHEN {metric} < {c} THEN {i}" for i, c in enumerate(cut, 1)]
    return f"CASE {' '.join(steps)} ELSE 5 END"


def _tiers_sql(separate: bool = False) -> str:
    cant = "WHEN r <= 2 AND f >= 4 AND m >= 4 THEN 'cant_lose'" if separate else ""
    cuts = ", ".join(f"quantile_cont(CAST({n} AS DOUBLE), [0.2, 0.4, 0.6, 0.8]) AS {n}_cut" for n in _METRIC_SQL)
    return f"""{AD}, {_QUSERS},
cuts AS (SELECT {cuts} FROM q),
s AS (SELECT q.*, {_score_sql('recency', True)} AS r, {_score_sql('frequency', False)} AS f,
        {_score_sql('monetary', False)} AS m FROM q, cuts),
t AS (SELECT *, CASE WHEN r >= 4 AND f >= 4 AND m >= 4 THEN 'champions' {cant}
   WHEN f >= 4 AND m >= 4 THEN 'loyal' WHEN r >= 3 AND f >= 3 THEN 'potential_loyal'
   WHEN r >= 4 AND f <= 2 THEN 'new_users' WHEN r <= 2 AND f >= 3 THEN 'at_risk'
   WHEN r <= 2 AND f <= 2 AND m <= 2 THEN 'lost' ELSE 'hibernating' END AS tier FROM s)"""


@query(QUERIES)
def rfm_scores(spark, folder):
    return _tiers(spark, folder).select(
        "user_id", "recency_score", "frequency_score", "monetary_score", "rfm_score", "rfm_total")


SQL["rfm_scores"] = f"""WITH {_tiers_sql()}
SELECT user_id, CAST(r AS INTEGER) AS recency_score, CAST(f AS INTEGER) AS frequency_score,
       CAST(m AS INTEGER) AS monetary_score, concat(r, f, m) AS rfm_score,
       CAST(r + f + m AS INTEGER) AS rfm_total FROM t"""


@query(QUERIES)
def rfm_tiers(spark, folder):
    return _tiers(spark, folder).select("user_id", "rfm_score", "tier")


SQL["rfm_tiers"] = f"WITH {_tiers_sql()} SELECT user_id, concat(r, f, m) AS rfm_score, tier FROM t"


@query(QUERIES)
def rfm_tiers_cant_lose(spark, folder):
    """The variant in which lapsed big spenders get their own tier."""
    return _tiers(spark, folder, separate_cant_lose=True).select("user_id", "rfm_score", "tier")


SQL["rfm_tiers_cant_lose"] = (
    f"WITH {_tiers_sql(True)} SELECT user_id, concat(r, f, m) AS rfm_score, tier FROM t")


@query(QUERIES)
def segment_sizes(spark, folder):
    return rounded(plan.segment_sizes(_tiers(spark, folder)))


_SIZES = f"""{_tiers_sql()},
z AS (SELECT tier, count(*) AS users, count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS share
      FROM t GROUP BY tier)"""
SQL["segment_sizes"] = f"WITH {_SIZES} SELECT tier, users, round(share, 6) AS share FROM z"


@query(QUERIES)
def segment_validation(spark, folder):
    checks = segment_checks(plan.segment_sizes(_tiers(spark, folder)), RFM_TIERS, min_total=1000)
    return checks.withColumns({c: joined(c) for c in ("missing", "dominating")})


_WANTED = ", ".join(f"('{t}')" for t in RFM_TIERS)
SQL["segment_validation"] = f"""WITH {_SIZES},
x AS (SELECT coalesce((SELECT CAST(sum(users) AS BIGINT) FROM z), 0) AS total_users,
  coalesce((SELECT string_agg(tier, ',' ORDER BY tier) FROM z WHERE share > 0.6), '') AS dominating,
  coalesce((SELECT string_agg(v.tier, ',' ORDER BY v.tier) FROM (VALUES {_WANTED}) v(tier)
            WHERE v.tier NOT IN (SELECT tier FROM z)), '') AS missing)
SELECT total_users, dominating, missing, total_users < 1000 AS too_few_users,
       missing = '' AND total_users >= 1000 AS is_valid FROM x"""


@query(QUERIES)
def missing_segments(spark, folder):
    return missing_values_of(_tiers(spark, folder), "tier", RFM_TIERS)


SQL["missing_segments"] = f"""WITH {_tiers_sql()}
SELECT v.tier FROM (VALUES {_WANTED}) v(tier) WHERE v.tier NOT IN (SELECT tier FROM t)"""


#: Every comparison of the rule language, with AND, OR and a nested group.
SEGMENTS = {
    "big_spenders": {"logic": "AND", "rules": [
        {"field": "total_spend_90d", "operator": "greater_than", "value": 700.0},
        {"field": "conversion_count_90d", "operator": "gte", "value": 8},
        {"field": "tier", "operator": "not_in", "value": ["lost", "hibernating"]}]},
    "lapsing": {"logic": "OR", "rules": [
        {"field": "tier", "operator": "in", "value": ["at_risk", "lost"]},
        {"field": "days_since_last_conversion", "operator": "between", "value": 14, "value_end": 40}],
        "nested_criteria": [{"logic": "AND", "rules": [
            {"field": "ctr_30d", "operator": "less_than", "value": 0.5},
            {"field": "click_count_30d", "operator": "lte", "value": 5}]}]},
    "loyal_like": {"logic": "AND", "rules": [
        {"field": "tier", "operator": "contains", "value": "loyal"},
        {"field": "rfm_score", "operator": "not_equals", "value": "555"}]},
    "exact_fifteen": {"rules": [{"field": "rfm_total", "operator": "equals", "value": 15}]},
}


@query(QUERIES)
def segment_rules(spark, folder):
    compiled = {name: Criteria.from_dict(spec) for name, spec in SEGMENTS.items()}
    return tag_segments(_tiers(spark, folder), compiled)


SQL["segment_rules"] = f"""WITH {_tiers_sql()},
n AS (SELECT *, concat(r, f, m) AS rfm_score FROM t)
SELECT user_id, 'big_spenders' AS segment_id FROM n
 WHERE total_spend_90d > 700 AND conversion_count_90d >= 8 AND tier NOT IN ('lost', 'hibernating')
UNION ALL SELECT user_id, 'lapsing' FROM n
 WHERE tier IN ('at_risk', 'lost') OR days_since_last_conversion BETWEEN 14 AND 40
    OR (ctr_30d < 0.5 AND click_count_30d <= 5)
UNION ALL SELECT user_id, 'loyal_like' FROM n WHERE tier LIKE '%loyal%' AND rfm_score <> '555'
UNION ALL SELECT user_id, 'exact_fifteen' FROM n WHERE r + f + m = 15"""



@query(QUERIES)
def segment_rule_index(spark, folder):
    """The same rules as an index table, together with 200 bands of spending.

    Spending is in cents, so no sum lies on an edge, whatever the order of summing.
    """
    bands = {f"band_{i:03}": Criteria("AND", (Condition("total_spend_90d", "gte", 10 * i + 0.005), Condition("total_spend_90d", "less_than", 10 * i + 10.005),
                                             Condition("impression_count_90d", "greater_than", i % 7))) for i in range(200)}
    compiled = {name: Criteria.from_dict(spec) for name, spec in SEGMENTS.items()}
    return tag_by_index(_tiers(spark, folder), RuleIndex.build(compiled | bands))


SQL["segment_rule_index"] = SQL["segment_rules"] + """
UNION ALL SELECT user_id, printf('band_%03d', i) FROM n, (SELECT unnest(range(200)) AS i)
 WHERE total_spend_90d >= 10 * i + 0.005 AND total_spend_90d < 10 * i + 10.005 AND impression_count_90d > i % 7"""

_VECTOR = ("ctr_30d", "cvr_30d", "total_spend_90d", "engagement_score")


@query(QUERIES)
def segment_vectors(spark, folder):
    vectors = plan.segment_vectors(_tiers(spark, folder), _VECTOR)
    return rounded(vectors.select("tier", "user_count", F.explode("feature_vector").alias("feature", "value")))


SQL["segment_vectors"] = f"""WITH {_tiers_sql()},
v AS (SELECT tier, count(*) AS user_count, unnest([{', '.join(f"'{c}'" for c in _VECTOR)}]) AS feature,
      unnest([{', '.join(f'avg({c})' for c in _VECTOR)}]) AS value FROM t GROUP BY tier)
SELECT tier, user_count, feature, round(value, 6) AS value FROM v"""


@query(QUERIES)
def membership_export(spark, folder):
    at = F.lit(USER_REFERENCE).cast("timestamp")
    out = membership_entries(plan.memberships(_tiers(spark, folder), at), at)
    return out.withColumns({"expires_at": F.unix_seconds("expires_at"),
                            "ttl_seconds": F.col("ttl_seconds").cast("long")})


SQL["membership_export"] = f"""WITH {_tiers_sql()}
SELECT 'segment:user:' || user_id AS key, tier AS value, CAST(86400 AS BIGINT) AS ttl_seconds,
       epoch_us({_REF}) // 1000000 + 86400 AS expires_at FROM t"""


@query(QUERIES)
def memberships(spark, folder):
    """Membership rows with a score between 0 and 1."""
    at = F.lit(USER_REFERENCE).cast("timestamp")
    out = plan.memberships(_tiers(spark, folder), at)
    return rounded(out.select("user_id", "segment_id", "score",
                              F.col("score").between(0, 1).alias("score_in_bounds")))


SQL["memberships"] = f"""WITH {_tiers_sql()}
SELECT user_id, tier AS segment_id, round((r + f + m - 3) / 12, 6) AS score, true AS score_in_bounds
FROM t"""


@query(QUERIES)
def incremental_merge(spark, folder):
    """Kept days plus a recomputed last week; must equal a full rebuild."""
    events = log.ad_events(spark, folder)
    # the kept state lacks the last week's late half: only the patch has it
    kept = plan.user_days(events.where(F.col("timestamp") < "2024-01-27"))
    patch = plan.user_days(events.where(F.col("timestamp") >= F.lit(_PATCH_FROM).cast("timestamp")))
    days = plan.replace_days(kept, patch, _PATCH_FROM)
    return rounded(plan.user_features(days, USER_REFERENCE).select("user_id", *_COUNTS, *_DOUBLES))


SQL["incremental_merge"] = SQL["user_features"]


@query(QUERIES)
def feature_fold(spark, folder):
    """Full outer fold: features of the last week over those of the days before."""
    events = log.ad_events(spark, folder)
    cut = F.lit(_PATCH_FROM).cast("timestamp")
    columns = ["user_id", *_COUNTS[:3], "total_spend_30d"]

    def part(condition):
        return plan.user_features(plan.user_days(events.where(condition)), USER_REFERENCE).select(*columns)

    return rounded(fold_state(part(F.col("timestamp") < cut), part(F.col("timestamp") >= cut), "user_id"))


def _fold_part(name, condition):
    return _uf_sql(f"(SELECT * FROM ad WHERE {condition})").replace("u0 AS", f"u0{name} AS").replace(
        "uf AS", f"{name} AS").replace("FROM u0)", f"FROM u0{name})")


SQL["feature_fold"] = f"""WITH {AD}, {_fold_part('a', f"ts < DATE '{_PATCH_FROM}'")},
{_fold_part('b', f"ts >= DATE '{_PATCH_FROM}'")}
SELECT coalesce(a.user_id, b.user_id) AS user_id,
  {', '.join(f'coalesce(b.{c}, a.{c}) AS {c}' for c in _COUNTS[:3])},
  round(coalesce(b.total_spend_30d, a.total_spend_30d), 6) AS total_spend_30d
FROM a FULL JOIN b ON a.user_id = b.user_id"""


@query(QUERIES)
def rebuild_mode(spark, folder):
    """Run mode and lookback of every day in the log."""
    days = log.table(spark, folder, "events").select(F.to_date("ts").alias("run_date")).distinct()
    full = is_full_rebuild(F.col("run_date"))
    return days.select(
        "run_date", F.when(full, "full").otherwise("incremental").alias("mode"),
        lookback_start(F.col("run_date"), full).alias("start_date"),
    )


SQL["rebuild_mode"] = """WITH d AS (SELECT DISTINCT CAST(ts AS DATE) AS run_date FROM events)
SELECT CAST(run_date AS VARCHAR) AS run_date, CASE WHEN isodow(run_date) = 1 THEN 'full' ELSE 'incremental' END AS mode,
       CAST(run_date - CAST(CASE WHEN isodow(run_date) = 1 THEN 90 ELSE 7 END AS INTEGER) AS VARCHAR) AS start_date
FROM d"""


@query(QUERIES)
def merged_quantiles(spark, folder):
    """Cut points of event values per type from daily sketches, held against exact ranks.

    Sketches are drawn by chance, so the query tells whether a cut is within the bound.
    """
    events = log.table(spark, folder, "events").withColumn("day", F.to_date("ts"))
    metrics = {"value": F.col("value")}
    states = sketches.quantile_states(events, metrics, "event_type", "day")
    root = shared_dir(spark, "quantile-states")
    states.write.partitionBy("day").parquet(root)
    kept = spark.read.parquet(root)
    cuts = sketches.merged_cuts(kept, [*plan.QUINTILES, 0.5, 0.99], "event_type")
    judged = sketches.rank_errors(cuts, events, metrics, "event_type")
    return judged.select("event_type", "metric", "probability", "n", (F.col("rank_error") <= sketches.RANK_ERROR).alias("within_bound"))


SQL["merged_quantiles"] = """SELECT event_type, 'value' AS metric, CAST(p AS DOUBLE) AS probability, count(value) AS n, true AS within_bound
FROM events, (SELECT unnest([0.2, 0.4, 0.6, 0.8, 0.5, 0.99]) AS p) WHERE value IS NOT NULL GROUP BY event_type, p"""
