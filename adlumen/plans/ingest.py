"""Landing → validated, partitioned events, with every landed row accounted for."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from adlumen import schemas as S
from adlumen.functions import storage as st
from adlumen.operators import joins, validation
from adlumen.sinks import tables

_LEVELS = {"year": "int", "month": "int", "day": "int", "hour": "int", "event_type": "string"}
STORED, QUARANTINED, PRESENT = "stored", "quarantined", "present"


@dataclass(frozen=True)
class Kind:
    """What a landed table is: its rules, its defaults, its time and its type column."""

    rules: Callable[[], dict[str, Column]]
    defaults: dict
    time: str = "timestamp"
    type: str = "event_type"


AD_EVENTS = Kind(validation.ad_event_rules, S.AD_EVENT_DEFAULTS)
SSP_EVENTS = Kind(validation.ssp_event_rules, S.AD_EVENT_DEFAULTS | S.SSP_DEFAULTS)
DSP_EVENTS = Kind(validation.dsp_event_rules, S.AD_EVENT_DEFAULTS | S.DSP_DEFAULTS)
USER_ACTIONS = Kind(validation.user_action_rules, S.USER_ACTION_DEFAULTS, "action_timestamp", "action_type")


def with_levels(events: DataFrame, time: str = "timestamp") -> DataFrame:
    """Partition levels as typed columns, as they read back from disk."""
    parts = st.partition_columns(F.col(time))
    return events.withColumns({k: v.cast(_LEVELS[k]) for k, v in parts.items()})


def existing_partitions(table: DataFrame) -> DataFrame:
    """Partition values present in a table without Hive folders.

    For a partitioned table take :func:`adlumen.sources.inventory.listed_partitions`.
    """
    return table.select(*[F.col(c).cast(t) for c, t in _LEVELS.items()]).distinct()


def judged(landed: DataFrame, kind: Kind = AD_EVENTS, day: dt.date | None = None,
           existing: DataFrame | None = None) -> DataFrame:
    """Normalised rows with ``errors``, ``outcome`` and partition levels; no row is lost.

    With ``day``, rows of another day are errors of their own. Valid rows of a partition in
    ``existing`` are ``present``: they were stored by an earlier run.
    """
    rules = kind.rules()
    if day is not None:
        rules["outside_day"] = F.to_date(kind.time) != F.lit(day)
    rows = validation.with_errors(validation.normalise(landed, kind.defaults), rules)
    rows = with_levels(rows, kind.time)
    if kind.type != "event_type":
        rows = rows.withColumn("event_type", F.col(kind.type))
    bad = F.size("errors") > 0
    outcome = F.when(bad, QUARANTINED).otherwise(STORED)
    if existing is not None:
        done = existing.select(*_LEVELS, F.lit(True).alias("_done"))
        if day is not None:  # the partitions of one day
            done = done.where((F.col("year") == day.year) & (F.col("month") == day.month) & (F.col("day") == day.day))
        rows = rows.join(done, list(_LEVELS), "left")
        outcome = F.when(bad, QUARANTINED).when(F.col("_done"), PRESENT).otherwise(STORED)
    return rows.withColumn("outcome", outcome).drop("_done")


def accounting(rows: DataFrame, *keys: str) -> DataFrame:
    """Landed rows per key, and how many of them were stored, quarantined or present."""
    return rows.groupBy(*keys).agg(
        F.count("*").alias("landed"),
        *[F.count_if(F.col("outcome") == o).alias(o) for o in (STORED, QUARANTINED, PRESENT)])


def _counted(rows: DataFrame) -> DataFrame:
    """Levels without nulls, so that rows without a time or type compare as well."""
    return rows.select(*_LEVELS).na.fill(-1).na.fill("")


def run_partitioning(
    spark: SparkSession,
    landed: DataFrame,
    day: dt.date,
    out_root: str,
    recorded_at: dt.datetime,
    existing: DataFrame | None = None,
    kind: Kind = AD_EVENTS,
) -> DataFrame:
    """Write the day's partitions; those in ``existing`` are left untouched.

    Valid rows of every declared type are stored. Invalid rows, and rows of another day,
    go to quarantine with their errors. Without ``existing`` the whole day is replaced, so
    that nothing of an earlier run stays behind. Returns row counts per partition: all
    landed rows against stored, quarantined and present ones. The landed rows are read
    once: they are counted while they are staged, and the staged rows must be as many.
    """
    run = uuid.uuid4().hex
    # rules are evaluated once; everything below reads the judged rows
    staged = f"{out_root}/staging/date={day}/run={run}"
    seen = Observation()
    judged(landed.observe(seen, F.count(F.lit(1)).alias("landed")), kind, day, existing).write.parquet(staged)
    rows = spark.read.parquet(staged)
    stored = rows.where(F.col("outcome") == STORED).drop("outcome", "errors", "year", "month", "day", "hour")

    folder = f"{out_root}/events/year={day:%Y}/month={day:%m}/day={day:%d}"
    hours = stored.withColumn("hour", F.date_format(kind.time, "HH"))
    (
        hours.hint("rebalance", "hour", "event_type").write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if existing is None else "dynamic")
        .option("compression", "snappy").partitionBy("hour", "event_type").parquet(folder)
    )
    refused_root = f"{out_root}/quarantine/date={day}"
    rows.where(F.col("outcome") == QUARANTINED).drop("outcome").write.mode("overwrite").option(
        "partitionOverwriteMode", "static").parquet(refused_root)

    # declared schemas: a day without stored or refused rows has no file to tell them
    written = spark.read.schema(hours.schema).parquet(folder)
    kept = written.selectExpr(f"{day.year} AS year", f"{day.month} AS month", f"{day.day} AS day",
                              "CAST(hour AS INT) AS hour", "event_type")
    if existing is not None:  # of partitions of earlier runs, the rows found present count
        kept = kept.join(existing, list(_LEVELS), "left_anti").unionByName(
            rows.where(F.col("outcome") == PRESENT).select(*_LEVELS))
    refused = spark.read.schema(rows.drop("outcome").schema).parquet(refused_root)
    before = _counted(rows)
    after = _counted(kept.unionByName(refused.select(*_LEVELS)))
    # written once: the ledger and the caller both read it
    outcome = f"{out_root}/verification/date={day}/run={run}"
    joins.compare_counts(before, after, list(_LEVELS)).write.parquet(outcome)
    verified = spark.read.parquet(outcome)
    measures = verified.agg(
        F.count("*").alias("partitions"), F.sum("output_rows").alias("rows"),
        F.count_if(~F.col("verified")).alias("mismatches"), F.sum("input_rows").alias("landed"),
    )
    counted = measures.head()
    failed = counted.mismatches or (counted.landed or 0) != seen.get["landed"]
    measures = measures.drop("landed")
    tables.append_ledger(
        tables.ledger_entry(measures, "partitioning", day, recorded_at,
                            status="mismatch" if failed else "complete"), f"{out_root}/ledger")
    return verified
