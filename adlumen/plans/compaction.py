"""Small-file compaction with deduplication.

A plan is a table of files, not a list per partition, so a partition with very many files
needs no oversized row. One job compacts all planned partitions together.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from adlumen.functions import storage as st
from adlumen.functions.rates import ratio
from adlumen.operators import dedup, validation
from adlumen.operators.joins import lookup_sizes
from adlumen.sinks.snapshots import Table
from adlumen.sinks.tables import EVENT_LAYOUT
from adlumen.sources.inventory import list_files, partition_sizes, with_partition_levels

MAX_PARTITIONS = 100


def plan_jobs(files: DataFrame, min_mb: int = st.MIN_FILE_MB) -> DataFrame:
    """Partitions with at least two undersized files."""
    return (
        files.where(st.needs_merge(F.col("size"), min_mb))
        .groupBy("prefix")
        .agg(F.count("*").alias("input_file_count"), F.sum("size").alias("total_input_bytes"))
        .where(F.col("input_file_count") >= 2)
        .withColumn("output_file_count", st.split_count(F.col("total_input_bytes")))
    )


def first_jobs(jobs: DataFrame, limit: int = MAX_PARTITIONS) -> DataFrame:
    """The partitions one run works on, in path order."""
    return jobs.orderBy("prefix").limit(limit)


def planned_files(files: DataFrame, jobs: DataFrame, min_mb: int = st.MIN_FILE_MB) -> DataFrame:
    """The undersized files of the planned partitions, one row each."""
    return files.where(st.needs_merge(F.col("size"), min_mb)).join(
        jobs.select("prefix", "output_file_count"), "prefix"
    )


def estimate_savings(plan: DataFrame, inventory: DataFrame) -> DataFrame:
    """Expected bytes before and after, with current sizes of the planned files."""
    total = F.col("total_input_bytes")
    per_prefix = lookup_sizes(plan.select("prefix", "path"), inventory).groupBy("prefix").agg(
        F.sum("size").alias("bytes")
    )
    return per_prefix.agg(
        F.count("*").alias("jobs_planned"),
        F.coalesce(F.sum("bytes"), F.lit(0)).cast("double").alias("total_input_bytes"),
    ).withColumns({
        "estimated_output_bytes": total * st.COMPACTED_SHARE,
        "estimated_savings_bytes": total - total * st.COMPACTED_SHARE,
        "estimated_savings_pct": ratio(total - total * st.COMPACTED_SHARE, total) * 100,
    })


def validate(results: DataFrame) -> DataFrame:
    """Adds ``errors`` and ``is_valid`` to outcome rows."""
    judged = dedup.with_loss_ratios(results).withColumn(
        "compression_ratio", F.lit(1.0) - ratio("output_bytes", "input_bytes")
    )
    return validation.with_errors(judged, validation.compaction_rules()).withColumn(
        "is_valid", F.size("errors") == 0
    )


def run_totals(outcomes: DataFrame) -> DataFrame:
    """What a run achieved; files are retired and bytes freed only where the result is valid."""
    # five names at most leave each task
    named = outcomes.where(~F.col("is_valid")).select("prefix").orderBy("prefix").limit(5)
    failures = named.agg(F.sort_array(F.collect_list("prefix")).alias("prefixes"))
    totals = outcomes.agg(
        F.count("*").alias("jobs"),
        F.count_if("is_valid").alias("succeeded"),
        F.coalesce(F.sum(F.when(F.col("is_valid"), F.col("input_file_count"))), F.lit(0))
        .alias("retired_files"),
        F.coalesce(F.sum(F.when(F.col("is_valid"), F.col("input_bytes"))), F.lit(0))
        .alias("freed_bytes"),
    )
    return totals.withColumn("first_failures", failures.scalar())


def stage_compaction(
    spark: SparkSession,
    root: str,
    files: DataFrame,
    staging: str,
    dedup_keys: tuple[str, ...] = ("event_id",),
    order: Column | None = None,
    limit: int | None = None,
    min_mb: int = st.MIN_FILE_MB,
    layout: list[str] = EVENT_LAYOUT,
    source: DataFrame | None = None,
) -> DataFrame | None:
    """Read the planned files, drop duplicates, write compacted files to ``staging``.

    Returns validated outcomes per partition, or None when nothing needs compacting. The
    source is not touched: see :func:`compact` for tables with versions and :func:`swap_in`
    for plain folders. Rows come from ``root``, or from ``source``, which has their file's
    path as a column. The number of
    output files of a partition follows from its bytes; rows are spread over them by key.
    All planned partitions are worked on unless the caller sets a ``limit``.
    """
    order = F.col("timestamp") if order is None else order
    jobs = plan_jobs(files, min_mb)
    if limit is not None:
        jobs = first_jobs(jobs, limit)
    if jobs.isEmpty():
        return None
    plan = planned_files(files, jobs, min_mb)
    partitions = with_partition_levels(jobs).select(*layout)
    if source is None:
        source = spark.read.parquet(root).withColumn("path", F.col("_metadata.file_path"))
    rows = (
        source.join(partitions, layout, "left_semi")
        .join(plan.select(F.col("path"), "output_file_count"), "path")
    )
    # the content hash settles copies with the same time in the same file
    ties = [order, F.col("path"), F.xxhash64(*rows.columns)]
    keep = dedup.drop_duplicates(rows, list(dedup_keys), ties, within=layout)
    salt = F.pmod(F.xxhash64(*dedup_keys), F.col("output_file_count"))
    (
        keep.withColumn("_salt", salt)
        .repartition(*layout, "_salt").drop("_salt", "path", "output_file_count")
        .write.mode("overwrite").option("compression", "snappy")
        .partitionBy(*layout).parquet(staging)
    )
    # one row per partition, read several times from here on: written instead of recomputed
    judged_root = f"{staging.rstrip('/')}_outcomes"
    judge(spark, rows, jobs, staging, dedup_keys, layout).write.mode("overwrite").parquet(judged_root)
    return spark.read.parquet(judged_root)


def judge(
    spark: SparkSession, rows: DataFrame, jobs: DataFrame, staging: str, dedup_keys: tuple[str, ...],
    layout: list[str] = EVENT_LAYOUT,
) -> DataFrame:
    """Counts read back from both sides, with staged bytes, judged per partition."""
    before = dedup.duplicate_accounting(rows, list(dedup_keys), layout).select(
        *layout, "input_rows", "duplicates_removed"
    )
    after = spark.read.parquet(staging).groupBy(*layout).agg(F.count("*").alias("output_rows"))
    staged = with_partition_levels(list_files(spark, staging))
    out_bytes = partition_sizes(staged, *layout).select(
        *layout, F.col("total_bytes").alias("output_bytes")
    )
    planned = with_partition_levels(jobs).select(
        *layout, "prefix", "input_file_count",
        F.col("total_input_bytes").alias("input_bytes"),
    )
    joined = (
        planned.join(before, layout, "left").join(after, layout, "left")
        .join(out_bytes, layout, "left")
        .na.fill(0, ["input_rows", "duplicates_removed", "output_rows", "output_bytes"])
        .withColumn("success", F.lit(True))
    )
    return validate(joined)


def swap_in(
    spark: SparkSession, root: str, files: DataFrame, judged: DataFrame, staging: str,
    min_mb: int = st.MIN_FILE_MB,
) -> DataFrame:
    """Add the staged files of valid partitions; return the files to retire.

    Compacted files are added next to the originals under the same partition. Retiring
    means deleting exactly the returned paths: files that were not part of the plan never
    appear. Until then a plain reader sees rows twice; a table with versions has no such
    time, see :func:`compact`.
    """
    valid = judged.where("is_valid").select(*EVENT_LAYOUT)
    (
        spark.read.parquet(staging).join(valid, EVENT_LAYOUT, "left_semi")
        .hint("rebalance", *EVENT_LAYOUT)
        .write.mode("append").option("compression", "snappy").partitionBy(*EVENT_LAYOUT).parquet(root)
    )
    return retired(files, judged, min_mb).select("path", "size")


def retired(files: DataFrame, judged: DataFrame, min_mb: int = st.MIN_FILE_MB) -> DataFrame:
    """The planned files of valid partitions."""
    return files.where(st.needs_merge(F.col("size"), min_mb)).join(
        judged.where("is_valid").select("prefix"), "prefix", "left_semi")


def compact(
    table: Table, operation: str, dedup_keys: tuple[str, ...] = ("event_id",), order: Column | None = None,
    limit: int | None = None, min_mb: int = st.MIN_FILE_MB,
) -> DataFrame | None:
    """Compact the undersized files of a table and commit the valid partitions at once.

    Readers see the files from before or those from after, never both. An attempt that
    breaks off before the commit changes nothing, and neither does a call under the name
    of an ``operation`` that was committed. Returns the outcomes per partition, None when
    there is nothing to do. Raises a conflict if another commit came first. Replaced files
    stay for readers of older versions until the table's expiry lists them.
    """
    if table.version_of(operation) is not None:
        return None
    since, layout = table.version(), list(table.levels)
    # small files of one partition belong together wherever they lie
    files = table.files(since)
    staging = table.folder()
    by_url = files.drop(*layout).withColumn("path", F.col("url"))
    judged = stage_compaction(table.spark, table.root, by_url, staging, dedup_keys, order, limit, min_mb, layout,
                              table.scan(files.where(st.needs_merge(F.col("size"), min_mb)), "path"))
    if judged is None:
        return None
    valid = judged.where("is_valid").select("prefix")
    added = table.written(staging).join(valid, "prefix", "left_semi")
    table.commit(operation, added, retired(files, judged, min_mb), since)
    return judged
