"""Table writers.

Layout work is left to adaptive execution: a REBALANCE hint shuffles by partition value,
splits partitions above the advisory size and merges small ones, so a partition with a
large share of the rows becomes several files instead of one slow task.
"""

from __future__ import annotations

import datetime as dt
import itertools
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from adlumen import schemas as S
from adlumen.functions import storage as st
from adlumen.functions.text import metric_name
from adlumen.functions.times import expires_at
from adlumen.operators.windows import first_per_key

#: Times in text exports; the default would cut them to milliseconds.
EXPORT_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
EVENT_LAYOUT = ["year", "month", "day", "hour", "event_type"]


def write_partitioned(
    df: DataFrame, root: str, columns: list[str], max_records_per_file: int = 0
) -> None:
    """Replace the partitions present in ``df``; leave all others alone."""
    (
        df.hint("rebalance", *columns)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(*columns)
        .parquet(root)
    )


def replace_partitions(
    df: DataFrame, root: str, columns: list[str], scope: dict[str, list], fmt: str = "parquet"
) -> None:
    """Everything in ``scope`` becomes ``df``: partitions it does not have any more go.

    ``scope`` names values of the leading partition columns, such as the days of a run.
    The rows are written to a hidden folder first; then each partition of the scope is
    removed or replaced by a rename. A run that breaks off is made good by running it
    again. Rows outside the scope are refused before anything is touched.
    """
    spark = df.sparkSession
    if list(scope) != columns[:len(scope)]:
        raise ValueError(f"{list(scope)} are not the first of {columns}")
    root = root.rstrip("/")
    staged = f"{root}/.replacing-{uuid.uuid4().hex}"
    (
        df.hint("rebalance", *columns).write.option("compression", "snappy" if fmt == "parquet" else "none")
        .partitionBy(*columns).format(fmt).save(staged)
    )
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def partitions(base: str, patterns: list[str]) -> list[str]:
        """Partition folders below ``base``, as relative paths: one listing a level."""
        found = [str(s.getPath().toUri().getPath()) for p in patterns for s in fs.globStatus(path(f"{base}/{p}")) or []]
        return sorted(f.split(f"{path(base).toUri().getPath()}/", 1)[1] for f in found)

    try:
        tail = "".join(f"/{c}=*" for c in columns[len(scope):])
        wanted = ["/".join(f"{c}={v}" for c, v in zip(scope, values)) for values in itertools.product(*scope.values())]
        new = partitions(staged, ["/".join(f"{c}=*" for c in columns)])
        outside = [p for p in new if not any(p == w or p.startswith(f"{w}/") for w in wanted)]
        if outside:
            raise ValueError(f"outside the scope: {outside[:5]}")
        old = partitions(root, [w + tail for w in wanted])
        for part in new:
            target = path(f"{root}/{part}")
            fs.delete(target, True)
            fs.mkdirs(target.getParent())
            if not fs.rename(path(f"{staged}/{part}"), target):
                raise OSError(f"could not move {part} into {root}")
        for part in sorted(set(old) - set(new)):
            fs.delete(path(f"{root}/{part}"), True)
    finally:
        fs.delete(path(staged), True)


def write_events(events: DataFrame, root: str) -> None:
    write_partitioned(
        events.withColumns(st.partition_columns(F.col("timestamp"))), root, EVENT_LAYOUT
    )


def write_features(
    vectors: DataFrame, root: str, hour: dt.datetime, exported_at: dt.datetime
) -> DataFrame:
    """Vectors of one hour plus a metadata record describing them; returns the stored rows."""
    stamped = vectors.withColumns(st.partition_columns(F.lit(hour)))
    replace_partitions(stamped, root, EVENT_LAYOUT[:4], {
        "year": [f"{hour:%Y}"], "month": [f"{hour:%m}"], "day": [f"{hour:%d}"], "hour": [f"{hour:%H}"]})
    # a declared schema: an hour without vectors has no file to tell it
    levels = T.StructType([T.StructField(c, T.IntegerType()) for c in EVENT_LAYOUT[:4]])
    written = vectors.sparkSession.read.schema(T.StructType([*vectors.schema.fields, *levels.fields])).parquet(root).where(
        (F.col("year") == hour.year) & (F.col("month") == hour.month)
        & (F.col("day") == hour.day) & (F.col("hour") == hour.hour)
    )
    feature_metadata(written, hour, exported_at).write.mode("append").json(
        f"{root.rstrip('/')}_metadata"
    )
    return written


def feature_metadata(vectors: DataFrame, hour: dt.datetime, exported_at: dt.datetime) -> DataFrame:
    return vectors.agg(F.count("*").alias("ads_count")).select(
        F.lit(S.FEATURE_VERSION).alias("feature_version"),
        F.lit(hour.isoformat()).alias("computation_hour"),
        "ads_count",
        F.lit(exported_at.isoformat()).alias("export_timestamp"),
        F.array(*[F.lit(n) for n in S.FEATURE_NAMES]).alias("feature_names"),
    )


def membership_entries(members: DataFrame, computed_at: Column, ttl_seconds: int = 86_400) -> DataFrame:
    """Key/value rows for a cache: ``segment:user:<id>`` → segment, with expiry."""
    return members.select(
        F.concat(F.lit("segment:user:"), F.col("user_id").cast("string")).alias("key"),
        F.col("segment_id").alias("value"),
        F.lit(ttl_seconds).alias("ttl_seconds"),
        expires_at(computed_at, ttl_seconds).alias("expires_at"),
    )


def exists(spark: SparkSession, root: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def write_memberships(entries: DataFrame, root: str, day: dt.date) -> None:
    replace_partitions(entries.withColumn("date", F.lit(f"{day:%Y-%m-%d}")), root, ["date"], {"date": [str(day)]})


def merge_latest(current: DataFrame, updates: DataFrame, keys: list[str], version: str) -> DataFrame:
    """One row per key, the one with the highest ``version``; an update wins a tie."""
    both = current.withColumn("_new", F.lit(0)).unionByName(updates.withColumn("_new", F.lit(1)))
    return first_per_key(both, keys, [F.col(version).desc(), F.col("_new").desc()]).drop("_new")


def upsert_daily(
    spark: SparkSession, root: str, updates: DataFrame, keys: list[str], version: str,
    staging_root: str, date_column: str = "report_date", complete: list[dt.date] | None = None,
) -> None:
    """Merge ``updates`` into a table partitioned by date.

    Only touched dates are read and rewritten. The merged rows go to a staging table
    first: the target is never overwritten while it is being read, and a lost executor
    can still recompute its part from either table. With ``complete`` the updates are all
    there is on those dates: rows without an update vanish, unless their version is higher
    than that of every update. Tables with versions merge by file instead, see
    :meth:`adlumen.sinks.snapshots.Table.merge`.
    """
    staging = f"{staging_root.rstrip('/')}/upsert-{uuid.uuid4().hex}"
    merged = updates
    if exists(spark, root):
        # the declared types keep the partition column a date on both sides
        current = spark.read.schema(updates.schema).parquet(root).select(*updates.columns)
        touched = updates.select(date_column).distinct()
        if complete is not None:
            days = F.col(date_column).isin(complete)
            newest = updates.agg(F.max(version)).scalar()
            has_update = updates.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
            same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
            stale = current.where(days & (newest.isNull() | F.col(version).isNull() | (F.col(version) <= newest))).join(has_update, same, "left_anti")
            touched = touched.union(current.where(days).select(date_column)).distinct()
            # of rows that stay, those with an update or with a higher version
            gone = stale.select(*[F.col(k).alias(f"_{k}") for k in keys])
            kept = current.join(gone, same, "left_anti")
        else:
            kept = current
        kept = kept.join(touched, date_column, "left_semi").select(*updates.columns)
        merged = merge_latest(kept, updates, keys, version)
    merged.write.parquet(staging)
    stored = spark.read.schema(merged.schema).parquet(staging)
    if complete is None:
        write_partitioned(stored, root, [date_column])
        return
    dates = {r[0] for r in stored.select(date_column).distinct().collect()} | set(complete)
    replace_partitions(stored, root, [date_column], {date_column: sorted(str(d) for d in dates)})


def write_reports(documents: DataFrame, root: str, day: dt.date) -> None:
    """JSON documents of one day below date=…/advertiser_id=…/; a vanished advertiser's goes."""
    replace_partitions(documents, root, ["date", "advertiser_id"], {"date": [str(day)]}, "json")


def export_text(df: DataFrame, path: str, fmt: str = "csv", compressed: bool = False) -> None:
    """Ad-hoc export as csv or json lines, optionally gzip; times keep their microseconds."""
    writer = df.write.mode("errorifexists").option("timestampFormat", EXPORT_TIME)
    if compressed:
        writer = writer.option("compression", "gzip")
    if fmt == "csv":
        writer = writer.option("header", "true")
    writer.format(fmt).save(path)


def ledger_entry(measures: DataFrame, run_type: str, run_date: dt.date, recorded_at: dt.datetime,
                 tags: dict[str, str] | None = None, status: str = "complete") -> DataFrame:
    """One-row measures → one ledger row with a metrics map."""
    pairs = [x for c in measures.columns for x in (F.lit(c), F.col(c).cast("double"))]
    labels = [F.lit(x) for kv in (tags or {}).items() for x in kv]
    tag_map = F.create_map(*labels) if labels else F.create_map().cast("map<string,string>")
    return measures.select(
        F.lit(run_type).alias("run_type"), F.lit(run_date).alias("run_date"),
        F.lit(recorded_at).alias("recorded_at"), F.lit(status).alias("status"),
        F.create_map(*pairs).alias("metrics"), tag_map.alias("tags"),
    )


def append_ledger(entry: DataFrame, root: str) -> None:
    entry.write.mode("append").parquet(root)


def ledger_gauges(ledger: DataFrame) -> DataFrame:
    """Ledger metrics under flat names: ``metric.tag_value…``."""
    return ledger.select(
        "run_type", "run_date", F.explode("metrics").alias("metric", "value"), "tags"
    ).select("run_type", "run_date", metric_name(F.col("metric"), F.col("tags")).alias("gauge"), "value")
