"""Storage queries: partitioning, inventories, compaction and tiering.

Orders stand in for stored files (one file per order, one partition per order day), order
lines for reads of those files.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from adlumen.functions import storage as st
from adlumen.functions.times import age_days
from adlumen.operators import dedup, joins
from adlumen.plans import compaction, ingest, tiering
from adlumen.queries.common import AD, ALL_AD, FILE_REFERENCE, joined, query, rounded
from adlumen.schemas import PARTITIONED_EVENT_TYPES
from adlumen.session import shared_dir
from adlumen.sinks import tables
from adlumen.sources import eventlog as log, events as sources, exports, inventory
from adlumen.sources.listing import list_files_in_tasks

QUERIES: dict = {}
SQL: dict[str, str] = {}

_LEVELS = ["year", "month", "day", "hour", "event_type"]
_REF = f"TIMESTAMP '{FILE_REFERENCE}'"

FILES = """files AS (SELECT o_orderkey AS file_id, strftime(o_orderdate, 'events/year=%Y/month=%m/day=%d/') AS prefix,
  strftime(o_orderdate, 'events/year=%Y/month=%m/day=%d/') || 'part-' || o_orderkey || '.parquet' AS path,
  CAST(trunc(o_totalprice * 1000) AS BIGINT) AS size, o_orderdate AS modified, CAST(o_orderdate AS DATE) AS day,
  o_orderstatus AS status FROM orders)"""

_TYPES = ", ".join(f"'{t}'" for t in PARTITIONED_EVENT_TYPES)
_EXPECTED = f"""expected AS (SELECT CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
  CAST(day(d) AS INTEGER) AS day, CAST(hour AS INTEGER) AS hour, event_type
  FROM (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events), (SELECT unnest(range(24)) AS hour),
       (SELECT unnest([{_TYPES}]) AS event_type)),
present AS (SELECT DISTINCT CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
  CAST(day(ts) AS INTEGER) AS day, CAST(hour(ts) AS INTEGER) AS hour, event_type FROM ad)"""


# ---- partitioning ------------------------------------------------------------

def _expected(spark, folder):
    days = log.table(spark, folder, "events").select(F.to_date("ts").alias("day")).distinct()
    return joins.expected_partitions(days, PARTITIONED_EVENT_TYPES)


def _present(spark, folder):
    return ingest.existing_partitions(ingest.with_levels(log.ad_events(spark, folder)))


@query(QUERIES)
def partition_specs(spark, folder):
    return _expected(spark, folder)


SQL["partition_specs"] = f"WITH {AD}, {_EXPECTED} SELECT * FROM expected"


@query(QUERIES)
def pending_partitions(spark, folder):
    return joins.pending_partitions(_expected(spark, folder), _present(spark, folder))


SQL["pending_partitions"] = f"WITH {AD}, {_EXPECTED} SELECT * FROM expected EXCEPT SELECT * FROM present"


@query(QUERIES)
def finished_partitions(spark, folder):
    return joins.finished_partitions(_expected(spark, folder), _present(spark, folder))


SQL["finished_partitions"] = f"WITH {AD}, {_EXPECTED} SELECT * FROM expected INTERSECT SELECT * FROM present"


@query(QUERIES)
def partition_paths(spark, folder):
    """Full path of every partition of the log, with its rows."""
    events = ingest.with_levels(log.all_events(spark, folder))
    counts = events.groupBy(*_LEVELS).agg(F.count("*").alias("rows"))
    prefix = st.partition_prefix(*[F.col(c) for c in _LEVELS])
    return counts.select(prefix.alias("prefix"), st.partition_uri("lake", prefix).alias("uri"), "rows")


SQL["partition_paths"] = f"""WITH {ALL_AD},
p AS (SELECT strftime(ts, 'year=%Y/month=%m/day=%d/hour=%H') || '/event_type=' || event_type AS prefix FROM ad)
SELECT prefix, 's3://lake/events/' || prefix || '/' AS uri, count(*) AS rows FROM p GROUP BY ALL"""


@query(QUERIES)
def repartition_verified(spark, folder):
    """Events written as a table partitioned by day and type, counted on both sides.

    The log has few rows per hour; the hourly layout would cost one file for each.
    """
    levels = ["year", "month", "day", "event_type"]
    events = ingest.with_levels(log.all_events(spark, folder))
    root = shared_dir(spark, "events")
    tables.write_partitioned(events, root, levels)
    return joins.compare_counts(events, spark.read.parquet(root), levels)


SQL["repartition_verified"] = f"""WITH {ALL_AD}
SELECT CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,
  event_type, count(*) AS input_rows, count(*) AS output_rows,
  CAST(1 AS DOUBLE) AS processing_ratio, true AS verified
FROM ad GROUP BY ALL"""


@query(QUERIES)
def ingest_accounting(spark, folder):
    """Every row of the log judged for ingest: landed = stored + quarantined, with the reasons."""
    rows = ingest.judged(log.all_events(spark, folder))
    reasons = ("unknown_event_type", "unknown_device_type")
    by = ["year", "month", "day", "event_type"]
    return rows.groupBy(*by).agg(
        F.count("*").alias("landed"),
        *[F.count_if(F.col("outcome") == o).alias(o) for o in (ingest.STORED, ingest.QUARANTINED)],
        *[F.count_if(F.array_contains("errors", r)).alias(r) for r in reasons])


SQL["ingest_accounting"] = f"""WITH {ALL_AD},
j AS (SELECT *, event_type NOT IN ('impression', 'click', 'conversion', 'engagement') AS bad_type,
  coalesce(user_id % 5 = 4, false) AS bad_device FROM ad)
SELECT CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,
  event_type, count(*) AS landed, count(*) FILTER (NOT (bad_type OR bad_device)) AS stored,
  count(*) FILTER (bad_type OR bad_device) AS quarantined, count(*) FILTER (bad_type) AS unknown_event_type,
  count(*) FILTER (bad_device) AS unknown_device_type FROM j GROUP BY ALL"""


@query(QUERIES)
def partition_stats(spark, folder):
    sizes = inventory.partition_sizes(log.stored_files(spark, folder))
    return rounded(sizes.withColumn("last_modified", F.unix_micros("last_modified")), 2)


_STATS = """stats AS (SELECT prefix, count(*) AS file_count, CAST(sum(size) AS BIGINT) AS total_bytes,
  avg(size) AS avg_bytes, max(modified) AS last_modified FROM files GROUP BY prefix)"""
SQL["partition_stats"] = f"""WITH {FILES}, {_STATS}
SELECT prefix, file_count, total_bytes, round(avg_bytes, 2) AS avg_bytes,
  epoch_us(last_modified) AS last_modified, round(total_bytes / 1048576, 2) AS total_mb FROM stats"""


@query(QUERIES)
def repartition_cost(spark, folder):
    sizes = inventory.partition_sizes(log.stored_files(spark, folder))
    estimate = st.repartition_estimate(F.col("file_count"), F.col("total_bytes"))
    return rounded(sizes.select("prefix", "file_count", *[v.alias(k) for k, v in estimate.items()]), 9)


SQL["repartition_cost"] = f"""WITH {FILES}, {_STATS},
s AS (SELECT *, greatest(1, CAST(round_even(total_bytes / 268435456.0, 0) AS BIGINT)) AS n FROM stats)
SELECT prefix, file_count, round(total_bytes / 104857600 + total_bytes / 52428800, 9) AS estimated_seconds,
  round(file_count / 1000 * 0.0004 + n / 1000 * 0.005 + total_bytes / 1073741824 * 0.09, 9) AS estimated_cost_usd,
  CAST(n AS BIGINT) AS estimated_output_files FROM s"""


@query(QUERIES)
def file_sizing(spark, folder):
    """Merge and split decisions, number of output files and address of every file."""
    size = F.col("size")
    return rounded(log.stored_files(spark, folder).select(
        "path", st.object_uri(F.lit("lake"), F.col("path")).alias("uri"),
        st.megabytes(size).alias("size_mb"), st.needs_merge(size).alias("needs_merge"),
        st.needs_split(size, 400).alias("needs_split"), st.split_count(size, 128).alias("split_count")))


SQL["file_sizing"] = f"""WITH {FILES}
SELECT path, 's3://lake/' || path AS uri, round(size / 1048576, 6) AS size_mb, size < 67108864 AS needs_merge,
  size > 419430400 AS needs_split,
  greatest(1, CAST(round_even(size / 134217728.0, 0) AS BIGINT)) AS split_count FROM files"""


# ---- inventories -------------------------------------------------------------

@query(QUERIES)
def child_prefixes(spark, folder):
    """Year folders, the months of one year and the days of one month."""
    files = log.stored_files(spark, folder)
    years, months = inventory.child_prefixes(files), inventory.child_prefixes(files, 1998)
    return years.unionByName(months).unionByName(inventory.child_prefixes(files, 1998, 7))


SQL["child_prefixes"] = f"""WITH {FILES}
SELECT DISTINCT strftime(day, 'events/year=%Y/') AS child_prefix FROM files
UNION ALL SELECT DISTINCT strftime(day, 'events/year=%Y/month=%m/') FROM files WHERE year(day) = 1998
UNION ALL SELECT DISTINCT prefix FROM files WHERE year(day) = 1998 AND month(day) = 7"""


@query(QUERIES)
def small_files(spark, folder):
    files = log.stored_files(spark, folder).drop("day")
    since = (FILE_REFERENCE.date().replace(year=2000))
    return inventory.small_files(files, since).select("path", "size", "year", "month", "day")


SQL["small_files"] = f"""WITH {FILES}
SELECT path, size, CAST(year(day) AS INTEGER) AS year, CAST(month(day) AS INTEGER) AS month,
  CAST(day(day) AS INTEGER) AS day FROM files WHERE size < 67108864 AND day >= DATE '2000-08-10'"""


def _objects(spark, folder):
    """Files plus the success markers of partitions with a finished order."""
    files = log.stored_files(spark, folder)
    markers = files.where(F.col("status") == "F").select("prefix").distinct()
    return files.select("prefix", "name", "size", "modified").unionByName(markers.select(
        "prefix", F.lit(inventory.MARKER).alias("name"), F.lit(0).cast("long").alias("size"),
        F.lit(None).cast("timestamp").alias("modified")))


@query(QUERIES)
def partition_ready(spark, folder):
    return inventory.readiness(_objects(spark, folder), min_files=3, min_bytes=500_000_000,
                               require_marker=True)


SQL["partition_ready"] = f"""WITH {FILES},
r AS (SELECT prefix, count(*) AS file_count, CAST(sum(size) AS BIGINT) AS total_bytes,
  bool_or(status = 'F') AS has_marker FROM files GROUP BY prefix)
SELECT *, file_count >= 3 AND total_bytes >= 500000000 AND has_marker AS is_ready FROM r"""


@query(QUERIES)
def freshness(spark, folder):
    out = inventory.freshness(log.stored_files(spark, folder), F.lit(FILE_REFERENCE), 60 * 24 * 400, "prefix")
    return rounded(out.withColumn("last_modified", F.unix_micros("last_modified")))


SQL["freshness"] = f"""WITH {FILES}, m AS (SELECT prefix, max(modified) AS lm FROM files GROUP BY prefix)
SELECT prefix, epoch_us(lm) AS last_modified, round((epoch_us({_REF}) - epoch_us(lm)) / 6e7, 6) AS staleness_minutes,
  epoch_us({_REF}) - epoch_us(lm) <= CAST(60 * 24 * 400 AS BIGINT) * 60000000 AS is_fresh FROM m"""


@query(QUERIES)
def validated_partitions(spark, folder):
    out = inventory.validated_partitions(log.stored_files(spark, folder), min_files=4)
    return out.select("prefix", "file_count", "total_bytes", "validation_status")


SQL["validated_partitions"] = f"""WITH {FILES}, {_STATS}
SELECT prefix, file_count, total_bytes,
  CASE WHEN file_count >= 4 AND total_bytes > 0 THEN 'passed' ELSE 'failed' END AS validation_status FROM stats"""


_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
           "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@query(QUERIES)
def file_inventory(spark, folder):
    """Rows of each table, as the listed files hold them."""
    held = [log.table(spark, folder, t).select(F.col("_metadata.file_path").alias("path")) for t in _TABLES]
    rows = reduce(DataFrame.unionByName, held).groupBy("path").agg(F.count("*").alias("rows"))
    table = F.regexp_extract("path", r"/([a-z_]+)\.parquet(/|$)", 1)
    return (
        inventory.list_files(spark, folder).select("path").join(rows, "path", "left")
        .groupBy(table.alias("table_name")).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))
    )


SQL["file_inventory"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in _TABLES)


@query(QUERIES)
def file_inventory_by_tasks(spark, folder):
    """The same from a listing that the executors make."""
    held = [log.table(spark, folder, t).select(F.col("_metadata.file_path").alias("url")) for t in _TABLES]
    name = r"/([a-z_]+\.parquet(/.*)?)$"
    rows = reduce(DataFrame.unionByName, held).groupBy(F.regexp_extract("url", name, 1).alias("file")).agg(F.count("*").alias("rows"))
    listed = list_files_in_tasks(spark, folder).select(F.regexp_extract("path", name, 1).alias("file"))
    return (listed.join(rows, "file", "left").groupBy(F.regexp_extract("file", r"^([a-z_]+)\.", 1).alias("table_name"))
            .agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")))


SQL["file_inventory_by_tasks"] = SQL["file_inventory"]


# ---- compaction --------------------------------------------------------------

@query(QUERIES)
def compaction_plan(spark, folder):
    return compaction.plan_jobs(log.stored_files(spark, folder))


_JOBS = """jobs AS (SELECT prefix, count(*) AS input_file_count, CAST(sum(size) AS BIGINT) AS total_input_bytes
  FROM files WHERE size < 67108864 GROUP BY prefix HAVING count(*) >= 2)"""
SQL["compaction_plan"] = f"""WITH {FILES}, {_JOBS}
SELECT *, greatest(1, CAST(round_even(total_input_bytes / 268435456.0, 0) AS BIGINT)) AS output_file_count FROM jobs"""


@query(QUERIES)
def compaction_files(spark, folder):
    files = log.stored_files(spark, folder)
    return compaction.planned_files(files, compaction.plan_jobs(files)).select("prefix", "path", "size")


SQL["compaction_files"] = f"""WITH {FILES}, {_JOBS}
SELECT prefix, path, size FROM files JOIN jobs USING (prefix) WHERE size < 67108864"""


@query(QUERIES)
def compaction_first_jobs(spark, folder):
    """The bounded work list of one run (a top-k by path)."""
    return compaction.first_jobs(compaction.plan_jobs(log.stored_files(spark, folder))).select(
        "prefix", "input_file_count", "total_input_bytes")


SQL["compaction_first_jobs"] = f"WITH {FILES}, {_JOBS} SELECT * FROM jobs ORDER BY prefix LIMIT 100"


@query(QUERIES)
def compaction_savings(spark, folder):
    """Expected savings; files that vanished since planning count as 0 bytes."""
    files = log.stored_files(spark, folder)
    plan = compaction.planned_files(files, compaction.plan_jobs(files))
    return rounded(compaction.estimate_savings(plan, files.where(F.col("status") != "P")), 4)


SQL["compaction_savings"] = f"""WITH {FILES}, {_JOBS},
b AS (SELECT count(DISTINCT prefix) AS jobs_planned, CAST(sum(CASE WHEN status <> 'P' THEN size ELSE 0 END) AS DOUBLE) AS t
      FROM files JOIN jobs USING (prefix) WHERE size < 67108864)
SELECT jobs_planned, round(t, 4) AS total_input_bytes, round(t * 0.65, 4) AS estimated_output_bytes,
  round(t - t * 0.65, 4) AS estimated_savings_bytes,
  round(CASE WHEN t > 0 THEN (t - t * 0.65) / t ELSE 0 END * 100, 4) AS estimated_savings_pct FROM b"""


def _with_copies(events):
    """The log with a second copy of every 50th event, later and with another value."""
    copies = F.when(F.col("event_id") % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return events.withColumn("copy", F.explode(copies)).withColumn(
        "cost", F.col("cost") + F.col("copy"))


@query(QUERIES)
def dedup_events(spark, folder):
    rows = _with_copies(log.all_events(spark, folder))
    kept = dedup.drop_duplicates(rows, ["event_id"], [F.col("timestamp"), F.col("copy")])
    return rounded(kept.select("event_id", "event_type", "ad_id", "revenue", "cost"))


SQL["dedup_events"] = f"""WITH {ALL_AD}
SELECT event_id, event_type, ad_id, round(revenue, 6) AS revenue, round(cost, 6) AS cost FROM ad"""


@query(QUERIES)
def dedup_accounting(spark, folder):
    rows = ingest.with_levels(_with_copies(log.all_events(spark, folder)))
    return rounded(dedup.duplicate_accounting(rows, ["event_id"], ["year", "month", "day", "event_type"]))


SQL["dedup_accounting"] = f"""WITH {ALL_AD},
d AS (SELECT CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
  CAST(day(ts) AS INTEGER) AS day, event_type, count(*) + count(*) FILTER (event_id % 50 = 0) AS input_rows,
  count(*) AS output_rows, count(*) FILTER (event_id % 50 = 0) AS duplicates_removed FROM ad GROUP BY ALL)
SELECT *, round(duplicates_removed / CAST(input_rows AS DOUBLE), 6) AS dedup_ratio,
  round((input_rows - output_rows) / CAST(input_rows AS DOUBLE), 6) AS row_loss_ratio FROM d"""


def _outcomes(spark, folder):
    """Orders as compaction outcomes, lines as their rows; returned lines are the duplicates."""
    lines = log.table(spark, folder, "lineitem").groupBy("l_orderkey").agg(
        F.count("*").alias("input_rows"),
        F.count_if(F.col("l_returnflag") == "R").alias("duplicates_removed"),
        F.sum("l_extendedprice").alias("price"))
    orders = log.table(spark, folder, "orders")
    return orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left").select(
        F.concat(F.lit("p"), F.col("o_orderkey").cast("string")).alias("prefix"),
        (F.col("o_orderstatus") != "P").alias("success"),
        F.coalesce("input_rows", F.lit(0)).alias("input_rows"),
        (F.coalesce("input_rows", F.lit(0)) - F.coalesce("duplicates_removed", F.lit(0))).alias("output_rows"),
        F.coalesce("duplicates_removed", F.lit(0)).alias("duplicates_removed"),
        F.round(F.col("o_totalprice") * 200).cast("long").alias("input_bytes"),
        F.round(F.coalesce("price", F.lit(0.0)) * 100).cast("long").alias("output_bytes"),
        F.lit(3).cast("long").alias("input_file_count"))


_OUTCOMES = """l AS (SELECT l_orderkey, count(*) AS n, count(*) FILTER (l_returnflag = 'R') AS d,
  sum(l_extendedprice) AS price FROM lineitem GROUP BY l_orderkey),
o AS (SELECT 'p' || o_orderkey AS prefix, o_orderstatus <> 'P' AS success, coalesce(n, 0) AS input_rows,
  coalesce(n, 0) - coalesce(d, 0) AS output_rows, coalesce(d, 0) AS duplicates_removed,
  CAST(o_totalprice * 200 AS BIGINT) AS input_bytes, CAST(coalesce(price, 0) * 100 AS BIGINT) AS output_bytes
  FROM orders LEFT JOIN l ON o_orderkey = l_orderkey),
v AS (SELECT *, CASE WHEN input_rows > 0 THEN duplicates_removed / CAST(input_rows AS DOUBLE) ELSE 0 END AS dedup_ratio,
  1 - CASE WHEN input_bytes > 0 THEN output_bytes / CAST(input_bytes AS DOUBLE) ELSE 0 END AS compression_ratio FROM o),
j AS (SELECT *, concat_ws(',',
  CASE WHEN success AND dedup_ratio > 0.05 THEN 'dedup_ratio_above_limit' END,
  CASE WHEN success AND input_rows <= 0 THEN 'no_input_rows' END,
  CASE WHEN success AND output_rows <= 0 THEN 'no_output_rows' END,
  CASE WHEN success AND output_bytes > input_bytes * 1.1 THEN 'output_larger_than_input' END,
  CASE WHEN success AND dedup_ratio > 0.05 THEN 'row_loss_above_limit' END,
  CASE WHEN NOT success THEN 'run_failed' END) AS errors FROM v)"""


@query(QUERIES)
def compaction_validation(spark, folder):
    out = compaction.validate(_outcomes(spark, folder))
    return rounded(out.select("prefix", "input_rows", "output_rows", "dedup_ratio", "compression_ratio",
                              joined("errors").alias("errors"), "is_valid"))


SQL["compaction_validation"] = f"""WITH {_OUTCOMES}
SELECT prefix, input_rows, output_rows, round(dedup_ratio, 6) AS dedup_ratio,
  round(compression_ratio, 6) AS compression_ratio, errors, errors = '' AS is_valid FROM j"""


@query(QUERIES)
def compaction_run_totals(spark, folder):
    out = compaction.run_totals(compaction.validate(_outcomes(spark, folder)))
    return out.withColumn("first_failures", joined("first_failures"))


SQL["compaction_run_totals"] = f"""WITH {_OUTCOMES}
SELECT count(*) AS jobs, count(*) FILTER (errors = '') AS succeeded,
  CAST(3 * count(*) FILTER (errors = '') AS BIGINT) AS retired_files,
  CAST(coalesce(sum(input_bytes) FILTER (errors = ''), 0) AS BIGINT) AS freed_bytes,
  (SELECT string_agg(prefix, ',' ORDER BY prefix) FROM (SELECT prefix FROM j WHERE errors <> '' ORDER BY prefix LIMIT 5))
  AS first_failures FROM j"""


# ---- tiering -----------------------------------------------------------------

def _accesses(spark, folder):
    return tiering.access_counts(log.file_accesses(spark, folder), F.lit(FILE_REFERENCE), "file_id")


def _decisions(spark, folder):
    """Partitions of one day; finished orders' partitions are already warm."""
    metadata = tiering.partition_metadata(
        log.stored_files(spark, folder), _accesses(spark, folder), "file_id",
        F.min("day").alias("partition_date"),
        F.when(F.count_if(F.col("status") == "F") > 3, "warm").otherwise("hot").alias("current_tier"))
    return tiering.decide(metadata, F.lit(FILE_REFERENCE))


_PRICE = "CASE {t} WHEN 'hot' THEN 0.023 WHEN 'warm' THEN 0.0125 WHEN 'cold' THEN 0.004 ELSE 0.00099 END"
_RANK = "CASE {t} WHEN 'hot' THEN 1 WHEN 'warm' THEN 2 WHEN 'cold' THEN 3 ELSE 4 END"
_DECISIONS = f"""{FILES},
acc AS (SELECT l_orderkey AS file_id, count(*) FILTER (l_shipdate >= {_REF} - INTERVAL 7 DAY) AS a7, count(*) AS a30
  FROM lineitem WHERE l_shipdate >= {_REF} - INTERVAL 30 DAY AND l_shipdate < {_REF} GROUP BY l_orderkey),
meta AS (SELECT prefix, count(*) AS file_count, CAST(sum(size) AS BIGINT) AS size_bytes,
  CAST(coalesce(sum(a7), 0) AS BIGINT) AS access_count_7d, CAST(coalesce(sum(a30), 0) AS BIGINT) AS access_count_30d,
  min(day) AS partition_date, CASE WHEN count(*) FILTER (status = 'F') > 3 THEN 'warm' ELSE 'hot' END AS current_tier
  FROM files LEFT JOIN acc USING (file_id) GROUP BY prefix),
aged AS (SELECT *, (epoch_us({_REF}) - epoch_us(CAST(partition_date AS TIMESTAMP))) // 86400000000 AS age_days FROM meta),
tiers AS (SELECT *, CASE WHEN age_days < 30 OR access_count_7d >= 10 THEN 'hot'
  WHEN age_days < 90 OR access_count_30d >= 3 THEN 'warm' WHEN age_days < 365 THEN 'cold' ELSE 'archive' END AS target_tier
  FROM aged),
dec AS (SELECT *, CASE target_tier
    WHEN 'hot' THEN format('age {{}} d, {{}} accesses in 7 d', age_days, access_count_7d)
    WHEN 'warm' THEN format('age {{}} d, {{}} accesses in 30 d', age_days, access_count_30d)
    ELSE format('age {{}} d, rarely accessed', age_days) END AS reason,
  target_tier <> current_tier AS requires_action,
  {_RANK.format(t='target_tier')} > {_RANK.format(t='current_tier')} AS is_downgrade,
  greatest(0.0, size_bytes / 1073741824.0 * ({_PRICE.format(t='current_tier')} - {_PRICE.format(t='target_tier')})) AS monthly_savings_usd
  FROM tiers)"""


@query(QUERIES)
def access_counts(spark, folder):
    return _accesses(spark, folder)


SQL["access_counts"] = f"""WITH {_DECISIONS}
SELECT file_id, a7 AS access_count_7d, a30 AS access_count_30d FROM acc"""


@query(QUERIES)
def tier_classification(spark, folder):
    return rounded(_decisions(spark, folder), 9)


SQL["tier_classification"] = f"""WITH {_DECISIONS}
SELECT prefix, file_count, size_bytes, access_count_7d, access_count_30d, CAST(partition_date AS VARCHAR) AS partition_date, current_tier,
  CAST(age_days AS BIGINT) AS age_days, target_tier, reason, requires_action, is_downgrade,
  round(CAST(monthly_savings_usd AS DOUBLE), 9) AS monthly_savings_usd FROM dec"""


@query(QUERIES)
def tier_summary(spark, folder):
    return rounded(tiering.summary(_decisions(spark, folder)))


SQL["tier_summary"] = f"""WITH {_DECISIONS}
SELECT count(*) AS total_partitions, count(*) FILTER (requires_action) AS requiring_action,
  round(CAST(sum(monthly_savings_usd) AS DOUBLE), 6) AS total_monthly_savings_usd,
  {', '.join(f"count(*) FILTER (target_tier = '{t}') AS target_{t}_count" for t in ('hot', 'warm', 'cold', 'archive'))}
FROM dec"""


@query(QUERIES)
def tier_moves(spark, folder):
    return tiering.move_list(_decisions(spark, folder))


SQL["tier_moves"] = f"""WITH {_DECISIONS}
SELECT prefix, target_tier, size_bytes, CASE target_tier WHEN 'cold' THEN 'GLACIER_IR' ELSE 'DEEP_ARCHIVE' END AS storage_class
FROM dec WHERE target_tier IN ('cold', 'archive')"""


@query(QUERIES)
def tiering_report(spark, folder):
    return tiering.savings_report(_decisions(spark, folder))


SQL["tiering_report"] = f"""WITH {_DECISIONS},
s AS (SELECT count(*) AS n, count(*) FILTER (target_tier = 'cold') AS c, count(*) FILTER (target_tier = 'archive') AS a,
  CAST(sum(size_bytes) FILTER (target_tier IN ('cold', 'archive')) AS DOUBLE) / 1073741824 AS gb FROM dec)
SELECT n AS partitions_analyzed, c + a AS partitions_moved, c AS cold_partitions, a AS archive_partitions,
  round(gb, 2) AS data_moved_gb,
  round(gb * 0.023 - gb * (c * 0.004 + a * 0.00099) / CAST(greatest(c + a, 1) AS DOUBLE), 2) AS estimated_monthly_savings_usd
FROM s"""


@query(QUERIES)
def event_ages(spark, folder):
    """Whole elapsed days of every file at noon, floored, not calendar differences."""
    noon = F.lit(FILE_REFERENCE.replace(hour=12))
    files = log.stored_files(spark, folder)
    return files.groupBy(age_days(F.col("modified"), noon).alias("age_days")).agg(F.count("*").alias("files"))


SQL["event_ages"] = f"""WITH {FILES}
SELECT (epoch_us({_REF} + INTERVAL 12 HOUR) - epoch_us(modified)) // 86400000000 AS age_days, count(*) AS files
FROM files GROUP BY ALL"""


@query(QUERIES)
def gzip_round_trip(spark, folder):
    """The log exported as csv and as json lines, compressed and plain, and read back with its types."""
    events = log.table(spark, folder, "events")
    rows = events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value", "props")
    back = []
    for fmt in ("csv", "json"):
        for compressed in (True, False):
            path = shared_dir(spark, f"export-{fmt}")
            tables.export_text(rows, path, fmt, compressed)
            read = exports.read_text_export(spark, path, rows.schema, fmt, compressed)
            back.append(read.withColumns({"fmt": F.lit(fmt), "compressed": F.lit(compressed), "ts": F.unix_micros("ts")}))
    return rounded(reduce(DataFrame.unionByName, back))


SQL["gzip_round_trip"] = """SELECT event_id, epoch_us(ts) AS ts, user_id, event_type, round(value, 6) AS value, props, fmt, compressed
FROM events, (SELECT unnest(['csv', 'json']) AS fmt), (SELECT unnest([true, false]) AS compressed)"""


def _stored_log(spark, folder, root):
    """The log by day and type; returns the schema with partition levels. Hours would be a file each."""
    levels = ["year", "month", "day", "event_type"]
    rows = ingest.with_levels(log.all_events(spark, folder)).select("event_id", "timestamp", "user_id", "ad_id", "cost", *levels)
    tables.write_partitioned(rows.where(F.col("event_type").isin(*PARTITIONED_EVENT_TYPES)), root, levels)
    return rows.schema


@query(QUERIES)
def event_range_read(spark, folder):
    """Ten days of clicks and conversions read back from the partitioned log."""
    root = shared_dir(spark, "range") + "/events"
    schema = _stored_log(spark, folder, root)
    got = sources.read_events(spark, root, dt.date(2024, 1, 6), dt.date(2024, 1, 15), ["click", "conversion"], schema)
    return rounded(got.select("event_id", "event_type", F.unix_micros("timestamp").alias("ts"), "day", "cost"))


SQL["event_range_read"] = f"""WITH {ALL_AD}
SELECT event_id, event_type, epoch_us(ts) AS ts, CAST(day(ts) AS INTEGER) AS day, round(cost, 6) AS cost
FROM ad WHERE event_type IN ('click', 'conversion') AND CAST(ts AS DATE) BETWEEN DATE '2024-01-06' AND DATE '2024-01-15'"""


@query(QUERIES)
def event_window_read(spark, folder):
    """The 36 hours before a moment, across the edge of days."""
    root = shared_dir(spark, "window") + "/events"
    got = sources.read_window(spark, root, dt.datetime(2024, 1, 11, 7, 30), 36, schema=_stored_log(spark, folder, root))
    return got.select("event_id", "event_type", F.unix_micros("timestamp").alias("ts"))


SQL["event_window_read"] = f"""WITH {ALL_AD}
SELECT event_id, event_type, epoch_us(ts) AS ts FROM ad WHERE event_type IN ({_TYPES})
  AND ts >= TIMESTAMP '2024-01-11 07:30:00' - INTERVAL 36 HOUR AND ts < TIMESTAMP '2024-01-11 07:30:00'"""


@query(QUERIES)
def landing_day_read(spark, folder):
    """Landed days of the log, each read in one scan with all its hours and types."""
    root = shared_dir(spark, "landing")
    rows = log.all_events(spark, folder).select("event_id", "event_type", "timestamp")
    schema, parts = rows.withColumn("hour", F.lit(0)).schema, []
    for day in (dt.date(2024, 1, 3), dt.date(2024, 1, 17)):
        landed = rows.where(F.to_date("timestamp") == F.lit(day)).withColumn("hour", F.date_format("timestamp", "HH"))
        landed.coalesce(1).write.partitionBy("hour", "event_type").parquet(f"{root}/{day:%Y%m%d}")
        parts.append(sources.read_landing_day(spark, root, day, schema).withColumn("landed", F.lit(day)))
    return reduce(DataFrame.unionByName, parts).groupBy("landed", "hour", "event_type").agg(F.count("*").alias("rows"))


SQL["landing_day_read"] = f"""WITH {ALL_AD}
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS landed, CAST(hour(ts) AS INTEGER) AS hour, event_type, count(*) AS rows FROM ad
WHERE CAST(ts AS DATE) IN (DATE '2024-01-03', DATE '2024-01-17') GROUP BY ALL"""
