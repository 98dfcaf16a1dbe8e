"""File sizing, partition paths, tier rules and cost estimates."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from adlumen.schemas import STORAGE_TIERS

MB = 1024 * 1024
GB = 1024 * MB

# Layout goals, prices and cost-model constants.
MIN_FILE_MB, TARGET_FILE_MB, MAX_FILE_MB = 64, 256, 512
PRICE_PER_GB_MONTH = {"hot": 0.023, "warm": 0.0125, "cold": 0.004, "archive": 0.00099}
READ_MB_PER_SECOND, WRITE_MB_PER_SECOND = 100, 50
GET_USD_PER_1000, PUT_USD_PER_1000, TRANSFER_USD_PER_GB = 0.0004, 0.005, 0.09
COMPACTED_SHARE = 0.65


# ---- paths -------------------------------------------------------------------

def partition_columns(ts: Column) -> dict[str, Column]:
    """Zero-padded Hive partition values of an event time."""
    return {
        "year": F.date_format(ts, "yyyy"),
        "month": F.date_format(ts, "MM"),
        "day": F.date_format(ts, "dd"),
        "hour": F.date_format(ts, "HH"),
    }


def partition_prefix(year, month, day, hour=None, event_type=None) -> Column:
    """``year=…/month=…/day=…[/hour=…][/event_type=…]``; null levels are left out."""
    def level(name, value, width=2):
        return F.concat(F.lit(f"{name}="), F.lpad(value.cast("string"), width, "0"))

    parts = [level("year", year, 4), level("month", month), level("day", day)]
    if hour is not None:
        parts.append(level("hour", hour))
    if event_type is not None:
        parts.append(F.concat(F.lit("event_type="), event_type))
    return F.concat_ws("/", *parts)


def partition_uri(bucket: str, prefix: Column, base: str = "events") -> Column:
    return F.concat(F.lit(f"s3://{bucket}/{base}/"), prefix, F.lit("/"))


def object_uri(bucket: Column, key: Column) -> Column:
    return F.concat(F.lit("s3://"), bucket, F.lit("/"), key)


def parent_prefix(path: Column) -> Column:
    return F.regexp_replace(path, "[^/]+$", "")


# ---- sizes -------------------------------------------------------------------

def megabytes(size: Column) -> Column:
    return size / F.lit(float(MB))


def needs_merge(size: Column, min_mb: int = MIN_FILE_MB) -> Column:
    return size < F.lit(min_mb * MB)


def needs_split(size: Column, max_mb: int = MAX_FILE_MB) -> Column:
    return size > F.lit(max_mb * MB)


def split_count(size: Column, target_mb: int = TARGET_FILE_MB) -> Column:
    """Output files for a size, ties rounded to even."""
    return F.greatest(F.lit(1), F.bround(size / F.lit(float(target_mb * MB)))).cast("long")


def repartition_estimate(files: Column, size: Column) -> dict[str, Column]:
    out_files = split_count(size)
    return {
        "estimated_seconds": size / F.lit(float(READ_MB_PER_SECOND * MB))
        + size / F.lit(float(WRITE_MB_PER_SECOND * MB)),
        "estimated_cost_usd": files / 1000 * GET_USD_PER_1000
        + out_files / 1000 * PUT_USD_PER_1000
        + size / F.lit(float(GB)) * TRANSFER_USD_PER_GB,
        "estimated_output_files": out_files,
    }


# ---- tiers -------------------------------------------------------------------

def tier_rank(tier: Column) -> Column:
    return F.array_position(F.array(*[F.lit(t) for t in STORAGE_TIERS]), tier)


def tier_price(tier: Column) -> Column:
    pairs = [F.lit(x) for kv in PRICE_PER_GB_MONTH.items() for x in kv]
    return F.element_at(F.create_map(*pairs), tier)


def target_tier(
    age: Column,
    accesses_7d: Column,
    accesses_30d: Column,
    hot_days: int = 30,
    warm_days: int = 90,
    archive_days: int = 365,
    hot_accesses: int = 10,
    warm_accesses: int = 3,
) -> Column:
    return (
        F.when((age < hot_days) | (accesses_7d >= hot_accesses), "hot")
        .when((age < warm_days) | (accesses_30d >= warm_accesses), "warm")
        .when(age < archive_days, "cold")
        .otherwise("archive")
    )


def tier_reason(tier: Column, age: Column, accesses_7d: Column, accesses_30d: Column) -> Column:
    return (
        F.when(tier == "hot", F.format_string("age %d d, %d accesses in 7 d", age, accesses_7d))
        .when(tier == "warm", F.format_string("age %d d, %d accesses in 30 d", age, accesses_30d))
        .otherwise(F.format_string("age %d d, rarely accessed", age))
    )


def monthly_savings(size: Column, current: Column, target: Column) -> Column:
    """Never negative: moving to a dearer tier saves nothing."""
    return F.greatest(
        F.lit(0.0), size / F.lit(float(GB)) * (tier_price(current) - tier_price(target))
    )
