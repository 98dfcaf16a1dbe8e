"""Declared data-quality checks, evaluated in one aggregation pass."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from adlumen.functions.rates import ratio
from adlumen.operators.ranks import quantile_cuts

# Columns graded by default; the limits of the grades are in null_grades.
GRADED_COLUMNS = ("user_id", "campaign_id", "ad_id", "event_type", "amount")


class QualityError(RuntimeError):
    """A check failed that is not a mere warning."""


@dataclass(frozen=True)
class Check:
    """One check.

    kind: ``row_count`` (at least ``threshold`` rows), ``null_ratio`` (share of NULLs in
    ``column`` below ``threshold``), ``schema`` (all ``columns`` present), ``range``
    (``column`` inside ``low``..``high``), ``condition`` (``condition`` true on every row),
    ``quartile_fence`` and ``median_fence`` (share of values of ``column`` outside its fence
    at most ``threshold``; see :func:`quartile_fences`, :func:`median_fences`).
    """

    name: str
    kind: str
    column: str | None = None
    threshold: float = 0.0
    columns: tuple[str, ...] = ()
    low: float | None = None
    high: float | None = None
    condition: Column | None = None
    warning_only: bool = False


def quartile_fences(df: DataFrame, metrics: dict[str, Column], width: float = 1.5) -> DataFrame:
    """Rows (metric, low, high): ``width`` interquartile ranges beyond the quartiles.

    The quartiles are exact and found without a single-task sort. NULLs are left out; a
    metric without values has no row.
    """
    cuts = quantile_cuts(df, metrics, [0.25, 0.75]).groupBy("metric").agg(F.min("value").alias("q1"), F.max("value").alias("q3"))
    reach = (F.col("q3") - F.col("q1")) * width
    return cuts.select("metric", (F.col("q1") - reach).alias("low"), (F.col("q3") + reach).alias("high"))


def median_fences(df: DataFrame, metrics: dict[str, Column], width: float = 3.0) -> DataFrame:
    """Rows (metric, low, high): ``width`` deviations around the median.

    The deviation is the median distance from the median, scaled to that of a normal
    distribution; up to half of the values can be outliers without moving it. A second
    pass is needed for the distances.
    """
    medians = quantile_cuts(df, metrics, [0.5]).select("metric", F.col("value").alias("median"))
    distances = {name: F.abs(value.cast("double") - medians.where(F.col("metric") == name).select("median").scalar())
                 for name, value in metrics.items()}
    spread = quantile_cuts(df, distances, [0.5]).select("metric", (F.col("value") * _NORMAL * width).alias("reach"))
    return medians.join(spread, "metric").select(
        "metric", (F.col("median") - F.col("reach")).alias("low"), (F.col("median") + F.col("reach")).alias("high"))


#: Fixed value: standard deviations in one median distance of a normal distribution.
_NORMAL = 1.4826
_FENCES = {"quartile_fence": quartile_fences, "median_fence": median_fences}


def flag_outliers(df: DataFrame, fences: DataFrame, metrics: dict[str, Column]) -> DataFrame:
    """Adds ``outliers``: names of the metrics whose value lies outside its fence; none for NULLs.

    The fences, a row for each metric, stay in the plan as scalar subqueries.
    """
    names = []
    for name, value in metrics.items():
        own = fences.where(F.col("metric") == name)
        outside = ~value.cast("double").between(own.select("low").scalar(), own.select("high").scalar())
        names.append(F.when(outside, F.lit(name)).otherwise(F.lit("")))
    return df.withColumn("outliers", F.array_remove(F.array(*names), ""))


def _measure(check: Check, df: DataFrame) -> tuple[Column, Column]:
    """(measured value as an aggregate, passed as an expression of it)."""
    present = df.columns
    if check.kind == "row_count":
        value = F.count(F.lit(1)).cast("double")
        return value, value >= check.threshold
    if check.kind == "schema":
        absent = len(set(check.columns) - set(present))
        return F.max(F.lit(float(absent))), F.lit(absent == 0)
    if check.kind not in ("null_ratio", "range", "condition", *_FENCES):
        raise ValueError(f"unknown check kind {check.kind!r}")
    if check.kind != "condition" and check.column not in present:
        return F.max(F.lit(None).cast("double")), F.lit(False)
    if check.kind == "null_ratio":
        value = F.coalesce(F.avg(F.col(check.column).isNull().cast("double")), F.lit(0.0))
        return value, value < check.threshold
    if check.kind in _FENCES:
        fence = _FENCES[check.kind](df, {check.column: F.col(check.column)})
        outside = ~F.col(check.column).between(fence.select("low").scalar(), fence.select("high").scalar())
        value = F.coalesce(F.avg(outside.cast("double")), F.lit(0.0))
        return value, value <= check.threshold
    bad = (
        ~F.coalesce(check.condition, F.lit(False))
        if check.kind == "condition"
        else ~F.col(check.column).between(check.low, check.high)
    )
    value = F.count_if(bad).cast("double")
    return value, value == 0


def run_checks(df: DataFrame, checks: list[Check], stop_at_first_failure: bool = False) -> DataFrame:
    """Rows (position, check, kind, passed, actual, is_warning)."""
    measured = []
    for i, check in enumerate(checks):
        value, passed = _measure(check, df)
        measured.append(F.struct(
            F.lit(i).alias("position"), F.lit(check.name).alias("check"),
            F.lit(check.kind).alias("kind"), passed.alias("passed"), value.alias("actual"),
            F.lit(check.warning_only).alias("is_warning"),
        ))
    results = df.agg(F.array(*measured).alias("r")).select(F.explode("r").alias("r")).select("r.*")
    if not stop_at_first_failure:
        return results
    failed = F.when(~F.col("passed") & ~F.col("is_warning"), F.col("position"))
    everything = Window.partitionBy(F.lit(0))  # one row per declared check
    return (
        results.withColumn("_stop", F.min(failed).over(everything))
        .where(F.col("_stop").isNull() | (F.col("position") <= F.col("_stop")))
        .drop("_stop")
    )


def summarise(results: DataFrame) -> DataFrame:
    failed = ~F.col("passed") & ~F.col("is_warning")
    return results.agg(
        F.count("*").alias("total_checks"),
        F.count_if("passed").alias("passed"),
        F.count_if(failed).alias("failed"),
        F.count_if(~F.col("passed") & F.col("is_warning")).alias("warnings"),
        F.sort_array(F.collect_list(F.when(failed, F.col("check")))).alias("failures"),
    ).withColumn("overall_status", F.when(F.col("failed") == 0, "passed").otherwise("failed"))


def enforce(results: DataFrame, shown: int = 5) -> None:
    """Raise when a check that is not a warning failed; names the first few."""
    row = summarise(results).select("failed", F.slice("failures", 1, shown).alias("first")).head()
    if row.failed:
        raise QualityError(f"{row.failed} checks failed: {', '.join(row.first)}")


def null_grades(df: DataFrame, columns: tuple[str, ...] = GRADED_COLUMNS) -> DataFrame:
    """NULL share per column, graded; columns the table lacks are skipped."""
    present = [c for c in columns if c in df.columns]
    pct = {c: F.avg(F.col(c).isNull().cast("double")) * 100 for c in present}
    rows = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"_{c}").alias("null_pct")) for c in present
    ]))
    value = F.col("null_pct")
    grade = (
        F.when(value.isNull(), "empty_table").when(value > 50, "critical")
        .when(value > 20, "warning").when(value > 5, "minor").otherwise("ok")
    )
    return (
        df.agg(*[v.alias(f"_{c}") for c, v in pct.items()])
        .select(rows.alias("r")).select("r.*")
        .withColumn("grade", grade)
    )


def missing_columns(df: DataFrame, expected: list[str]) -> list[str]:
    """Schema check on metadata alone; extra columns are allowed."""
    return sorted(set(expected) - set(df.columns))


def missing_values_of(observed: DataFrame, column: str, required: tuple[str, ...]) -> DataFrame:
    """Required values that never occur in ``column``."""
    spark = observed.sparkSession
    wanted = spark.createDataFrame([(v,) for v in required], f"{column} string")
    return wanted.join(observed.select(column).distinct(), column, "left_anti")


def segment_checks(
    sizes: DataFrame, required: tuple[str, ...], min_total: int = 1000, max_share: float = 0.6
) -> DataFrame:
    """One row: missing tiers, total too low (both errors), dominating tiers (warning).

    ``sizes`` has one row per tier: (tier, users, share).
    """
    wanted = F.array(*[F.lit(t) for t in required])
    return (
        sizes.agg(
            F.coalesce(F.sum("users"), F.lit(0)).alias("total_users"),
            F.collect_set("tier").alias("_seen"),  # one entry per tier
            F.sort_array(F.collect_list(F.when(F.col("share") > max_share, F.col("tier"))))
            .alias("dominating"),
        )
        .withColumn("missing", F.sort_array(F.array_except(wanted, "_seen")))
        .withColumn("too_few_users", F.col("total_users") < min_total)
        .withColumn("is_valid", (F.size("missing") == 0) & ~F.col("too_few_users"))
        .drop("_seen")
    )


def share_of_total(df: DataFrame, count: str) -> Column:
    return ratio(F.col(count), F.sum(count).over(Window.partitionBy(F.lit(0))))
