"""Ratios, campaign KPIs and smoothed rates."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Smoothing defaults.
PRIOR_CTR = 0.001
PRIOR_CVR = 0.0001
MIN_DENOMINATOR = 10
ALPHA = 1.0


def ratio(num: Column | str, den: Column | str, scale: float = 1.0) -> Column:
    """num / den · scale, or 0.0 unless the denominator is positive (ANSI mode raises on x/0).

    Plain column names make one SQL expression: wide feature tables use many ratios, and
    each Column operation is a round trip from Python to the JVM.
    """
    if isinstance(num, str) and isinstance(den, str):
        return F.expr(f"CASE WHEN `{den}` > 0 THEN double(`{num}`) / `{den}` * {scale}D ELSE 0.0D END")
    num, den = _col(num), _col(den)
    return F.when(den > 0, num.cast("double") / den * scale).otherwise(F.lit(0.0))


def per_mille(num: Column | str, den: Column | str) -> Column:
    return ratio(num, den, 1000.0)


def kpi_columns() -> dict[str, Column]:
    """The seven campaign KPIs over impressions, clicks, conversions, spend, revenue."""
    return {
        "ctr": ratio("clicks", "impressions"),
        "cvr": ratio("conversions", "clicks"),
        "cpa": ratio("spend", "conversions"),
        "cpc": ratio("spend", "clicks"),
        "cpm": per_mille("spend", "impressions"),
        "roas": ratio("revenue", "spend"),
        "ecpm": per_mille("revenue", "impressions"),
    }


def smoothed_rate(
    hits: Column | str,
    trials: Column | str,
    prior: float,
    alpha: float = ALPHA,
    min_trials: int = MIN_DENOMINATOR,
) -> Column:
    """Additive smoothing toward ``prior``; the prior itself below ``min_trials``."""
    if isinstance(hits, str) and isinstance(trials, str):
        return F.expr(
            f"CASE WHEN `{trials}` < {min_trials} THEN {prior}D "
            f"ELSE (`{hits}` + {alpha * prior}D) / (`{trials}` + {alpha}D) END"
        )
    hits, trials = _col(hits), _col(trials)
    return F.when(trials < min_trials, F.lit(prior)).otherwise(
        (hits + F.lit(alpha * prior)) / (trials + F.lit(alpha))
    )


def smoothed_ctr(clicks, impressions, **kw) -> Column:
    return smoothed_rate(clicks, impressions, kw.pop("prior", PRIOR_CTR), **kw)


def smoothed_cvr(conversions, clicks, **kw) -> Column:
    return smoothed_rate(conversions, clicks, kw.pop("prior", PRIOR_CVR), **kw)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
