"""Duplicate removal and its accounting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from adlumen.functions.rates import ratio
from adlumen.operators.windows import first_per_key


def drop_duplicates(
    df: DataFrame, keys: list[str], order: list[Column], within: list[str] | None = None
) -> DataFrame:
    """Keep the first row of every key (inside its partition, when given)."""
    return first_per_key(df, [*(within or []), *keys], order)


def duplicate_accounting(df: DataFrame, keys: list[str], within: list[str]) -> DataFrame:
    """Rows in, rows out and duplicates per partition, without materialising the output.

    Copies are counted per key first; a key with very many copies is combined map-side.
    """
    per_key = df.groupBy(*within, *keys).agg(F.count("*").alias("copies"))
    return with_loss_ratios(
        per_key.groupBy(*within).agg(
            F.sum("copies").alias("input_rows"),
            F.count("*").alias("output_rows"),
            (F.sum("copies") - F.count("*")).alias("duplicates_removed"),
        )
    )


def with_loss_ratios(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "dedup_ratio": ratio("duplicates_removed", "input_rows"),
        "row_loss_ratio": ratio(F.col("input_rows") - F.col("output_rows"), F.col("input_rows")),
    })
