"""Row validation with quarantine, and normalisation of optional fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from adlumen import schemas as S


def _missing(schema: StructType) -> dict[str, Column]:
    return {f"missing_{c}": F.col(c).isNull() for c in S.required_columns(schema)}


def _negative(*columns: str) -> dict[str, Column]:
    return {f"negative_{c}": F.col(c) < 0 for c in columns}


def _outside(column: str, low: float, high: float) -> dict[str, Column]:
    return {f"{column}_out_of_range": ~F.col(column).between(low, high)}


def ad_event_rules() -> dict[str, Column]:
    return (
        _missing(S.AD_EVENT)
        | {"unknown_event_type": ~F.col("event_type").isin(*S.EVENT_TYPES),
           "unknown_device_type": ~F.col("device_type").isin(*S.DEVICE_TYPES)}
        | _negative("revenue", "cost")
    )


def ssp_event_rules() -> dict[str, Column]:
    return (
        ad_event_rules() | _missing(S.SSP_EVENT) | _negative("floor_price", "winning_bid")
        | _outside("viewability_score", 0.0, 1.0)
    )


def dsp_event_rules() -> dict[str, Column]:
    return ad_event_rules() | _missing(S.DSP_EVENT) | _outside("pacing_factor", 0.0, 2.0)


def user_action_rules() -> dict[str, Column]:
    return _missing(S.USER_ACTION) | _negative("revenue_value")


def normalise(df: DataFrame, defaults: dict) -> DataFrame:
    """Fill optional fields and upper-case the country code."""
    filled = {c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items() if c in df.columns}
    if "country_code" in filled:
        filled["country_code"] = F.upper(filled["country_code"])
    return df.withColumns(filled)


def with_errors(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Adds ``errors``: names of all broken rules, empty for a valid row."""
    names = [F.when(bad, F.lit(name)).otherwise(F.lit("")) for name, bad in rules.items()]
    # array_remove is compiled code; array_compact would call a lambda per element
    return df.withColumn("errors", F.array_remove(F.array(*names), ""))


def split_valid(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with their errors)."""
    checked = with_errors(df, rules)
    valid = checked.where(F.size("errors") == 0).drop("errors")
    return valid, checked.where(F.size("errors") > 0)


def error_counts(df: DataFrame, rules: dict[str, Column], *keys: str) -> DataFrame:
    """Rows breaking each rule, per key: plain counts in one pass, unfolded afterwards."""
    counts = df.groupBy(*keys).agg(*[F.count_if(bad).alias(name) for name, bad in rules.items()])
    names = ", ".join(f"'{name}', `{name}`" for name in rules)
    return counts.selectExpr(
        *[f"`{k}`" for k in keys], f"stack({len(rules)}, {names}) AS (error, rows)"
    ).where(F.col("rows") > 0)


def report_rules(
    max_ctr: float = 0.5, max_cvr: float = 1.0
) -> tuple[dict[str, Column], dict[str, Column]]:
    """(errors, warnings) for advertiser totals with a campaign_count."""
    c = F.col
    errors = {
        "no_campaigns": c("campaign_count") == 0,
        "negative_spend": c("spend") < 0,
        "cvr_above_limit": (c("clicks") > 0) & (c("conversions") > c("clicks") * max_cvr),
        "clicks_exceed_impressions": c("clicks") > c("impressions"),
    }
    warnings = {
        "ctr_above_limit": (c("impressions") > 0) & (c("clicks") > c("impressions") * max_ctr)
    }
    return errors, warnings


def validate_reports(totals: DataFrame, **limits) -> DataFrame:
    errors, warnings = report_rules(**limits)
    checked = with_errors(totals, warnings).withColumnRenamed("errors", "warnings")
    return with_errors(checked, errors).withColumn("is_valid", F.size("errors") == 0)


def feature_rules() -> dict[str, Column]:
    c = F.col
    return {
        "ctr_24h_above_half": c("ctr_24h") > 0.5,
        "cvr_24h_above_one": c("cvr_24h") > 1.0,
        "ecpm_24h_above_100": c("ecpm_24h") > 100.0,
        "clicks_without_impressions": (c("impressions_24h") == 0) & (c("clicks_24h") > 0),
    }


def compaction_rules(max_loss: float = 0.05, max_growth: float = 1.1) -> dict[str, Column]:
    """A failed run is reported as such and its other numbers are not judged."""
    c, ok = F.col, F.col("success")
    return {
        "run_failed": ~ok,
        "no_input_rows": ok & (c("input_rows") <= 0),
        "no_output_rows": ok & (c("output_rows") <= 0),
        "dedup_ratio_above_limit": ok & (c("dedup_ratio") > max_loss),
        "row_loss_above_limit": ok & (c("row_loss_ratio") > max_loss),
        "row_counts_disagree": ok
        & (c("input_rows") - c("output_rows") != c("duplicates_removed")),
        "output_larger_than_input": ok & (c("output_bytes") > c("input_bytes") * max_growth),
    }
