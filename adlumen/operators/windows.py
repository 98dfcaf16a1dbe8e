"""Window operators.

``row_number() <= k`` is recognised by Spark's window-group-limit rule: each map task
keeps at most k rows per key before the shuffle, so a hot key never arrives whole.
The other windows run on pre-aggregated rows, where a key has one row per period.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from adlumen.functions.rates import ratio

_HOUR = 3600


def first_per_key(df: DataFrame, keys: list[str], order: list[Column], k: int = 1) -> DataFrame:
    """The first ``k`` rows of every key; ``order`` must be total within a key."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") <= k).drop("_place")


def ranked_per_key(df: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("rank", place).where(F.col("rank") <= k)


def period_over_period(df: DataFrame, keys: list[str], period: str, metrics: list[str],
                       step: str = "INTERVAL 1 DAY") -> DataFrame:
    """Value one ``step`` earlier, change and relative change of each metric, per key.

    Where that period has no row, the value before and both changes are unknown (NULL).
    """
    w = Window.partitionBy(*keys).orderBy(period)
    adjacent = F.lag(period, 1).over(w) == F.col(period) - F.expr(step)
    out = df.withColumns({f"prev_{m}": F.when(adjacent, F.lag(m, 1).over(w)) for m in metrics})
    change = {m: F.col(m) - F.col(f"prev_{m}") for m in metrics}
    return out.withColumns(
        {f"{m}_change": change[m] for m in metrics}
        | {f"{m}_change_pct": F.when(F.col(f"prev_{m}").isNotNull(), ratio(change[m], F.col(f"prev_{m}")))
           for m in metrics}
    )


def rolling_hours(
    hourly: DataFrame, keys: list[str], metrics: list[str], hours: tuple[int, ...] = (1, 6, 24)
) -> DataFrame:
    """Trailing sums ending with each hour; input is one row per key and hour."""
    base = Window.partitionBy(*keys).orderBy(F.col("hour_start").cast("long"))
    return hourly.withColumns(
        {
            f"{m}_{h}h": F.sum(m).over(base.rangeBetween(-(h - 1) * _HOUR, 0))
            for m in metrics
            for h in hours
        }
    )
