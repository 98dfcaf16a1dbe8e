"""Sums that do not depend on the order of their rows."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Holds values below 10^19 with nine decimals; its sum has room for 10^10 such rows.
_FIXED = "decimal(28,9)"


def exact_sum(value: Column) -> Column:
    """Sum of doubles: equal rows have equal sums, whichever way they were dealt over tasks.

    A value counts as a decimal number; what has no place there (digits beyond the ninth,
    values too large, infinite or NaN) is summed beside it. NULL if all values are.
    """
    fixed = value.try_cast(_FIXED)
    rest = value - F.coalesce(fixed.cast("double"), F.lit(0.0))
    return F.coalesce(F.sum(fixed).cast("double"), F.lit(0.0)) + F.sum(rest)
