"""File inventories as DataFrames: one row per stored object.

Columns: path, prefix (folder, with trailing slash), name, size, modified, and, for
inventory reports, etag and storage_class.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from adlumen.functions import storage as st
from adlumen.functions.times import micros_between

MARKER = "_SUCCESS"
_LEVELS = {"year": "int", "month": "int", "day": "int", "hour": "int", "event_type": "string"}


def list_files(spark: SparkSession, root: str, suffix: str = ".parquet") -> DataFrame:
    """Files below ``root``. Contents are never read: the content column is pruned."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*{suffix}")
        .load(root)
    )
    return shaped(
        files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    )


def from_inventory_report(report: DataFrame, bucket: str, suffix: str = "") -> DataFrame:
    """A storage-inventory report table (key, size, last_modified_date, e_tag, storage_class)."""
    rows = report.where(F.col("key").endswith(suffix)) if suffix else report
    return shaped(rows.select(
        st.object_uri(F.lit(bucket), F.col("key")).alias("path"),
        "size",
        F.col("last_modified_date").alias("modified"),
        F.col("e_tag").alias("etag"),
        "storage_class",
    ))


def shaped(files: DataFrame) -> DataFrame:
    return files.withColumns({
        "prefix": st.parent_prefix(F.col("path")),
        "name": F.regexp_extract("path", "[^/]+$", 0),
        "size_mb": st.megabytes(F.col("size")),
    })


def with_partition_levels(files: DataFrame) -> DataFrame:
    """Hive levels of the path as columns; NULL where a level is absent."""
    return files.withColumns({
        level: F.nullif(F.regexp_extract("prefix", f"/{level}=([^/]+)/", 1), F.lit("")).cast(kind)
        for level, kind in _LEVELS.items()
    })


def listed_partitions(files: DataFrame) -> DataFrame:
    """Distinct partitions that hold files, from the listing alone: no data file is opened."""
    levels = list(_LEVELS)
    return with_partition_levels(files).select(*levels).dropna(subset=levels).distinct()


def child_prefixes(
    files: DataFrame, year: int | None = None, month: int | None = None, day: int | None = None
) -> DataFrame:
    """Distinct folders one level below a year, month or day; the years without arguments."""
    if year is None:
        root = F.regexp_extract("prefix", "^(.*?/?year=[^/]+/)", 1)
        return files.select(root.alias("child_prefix")).where(F.col("child_prefix") != "").distinct()
    levels = [f"year={year:04d}"]
    levels += [] if month is None else [f"month={month:02d}"]
    levels += [] if month is None or day is None else [f"day={day:02d}"]
    base = "/".join(levels)
    child = F.regexp_extract("prefix", f"^(.*?/?{base}/[^/]+/)", 1)
    return files.select(child.alias("child_prefix")).where(F.col("child_prefix") != "").distinct()


def partition_sizes(files: DataFrame, *keys: str) -> DataFrame:
    keys = keys or ("prefix",)
    return files.groupBy(*keys).agg(
        F.count("*").alias("file_count"),
        F.sum("size").alias("total_bytes"),
        F.avg("size").alias("avg_bytes"),
        F.max("modified").alias("last_modified"),
    ).withColumn("total_mb", st.megabytes(F.col("total_bytes")))


def small_files(files: DataFrame, since: dt.date, min_mb: int = st.MIN_FILE_MB) -> DataFrame:
    """Undersized files of recent partitions."""
    day = F.make_date("year", "month", "day")
    return with_partition_levels(files).where(
        (day >= F.lit(since)) & st.needs_merge(F.col("size"), min_mb)
    )


def readiness(
    objects: DataFrame,
    min_files: int = 1,
    min_bytes: int = 0,
    require_marker: bool = False,
    suffix: str = ".parquet",
) -> DataFrame:
    """Per prefix: enough files, enough bytes and, if asked for, a success marker.

    ``objects`` must list the marker objects too when a marker is required.
    """
    data = F.col("name").endswith(suffix)
    ready: Column = (F.col("file_count") >= min_files) & (F.col("total_bytes") >= min_bytes)
    if require_marker:
        ready = ready & F.col("has_marker")
    return (
        objects.groupBy("prefix")
        .agg(
            F.count_if(data).alias("file_count"),
            F.coalesce(F.sum(F.when(data, F.col("size"))), F.lit(0)).alias("total_bytes"),
            F.bool_or(F.col("name") == MARKER).alias("has_marker"),
        )
        .withColumn("is_ready", ready)
    )


def freshness(objects: DataFrame, now: Column, max_staleness_minutes: int, *keys: str) -> DataFrame:
    """Age of the newest object per key (default: the whole listing, NULL when empty)."""
    micros = micros_between(now, F.col("last_modified"))
    return objects.groupBy(*keys).agg(F.max("modified").alias("last_modified")).withColumns({
        "staleness_minutes": micros / F.lit(60_000_000.0),
        "is_fresh": F.coalesce(micros <= max_staleness_minutes * 60_000_000, F.lit(False)),
    })


def validated_partitions(files: DataFrame, min_files: int = 1) -> DataFrame:
    """Partition metadata with a status; a partition without data files fails."""
    return partition_sizes(files).withColumn(
        "validation_status",
        F.when((F.col("file_count") >= min_files) & (F.col("total_bytes") > 0), "passed")
        .otherwise("failed"),
    )


def marker_exists(spark: SparkSession, prefix: str) -> bool:
    """One metadata call; Spark's own listing hides names that start with an underscore."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{prefix.rstrip('/')}/{MARKER}")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
