"""Exponential time decay."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

HALF_LIFE_HOURS = 6.0


def decay_weight(age_hours: Column, half_life_hours: float = HALF_LIFE_HOURS) -> Column:
    return F.exp(age_hours * F.lit(-math.log(2) / half_life_hours))


def decayed_mean(
    value: Column, age_hours: Column, half_life_hours: float = HALF_LIFE_HOURS
) -> Column:
    """Aggregate: weighted mean, 0.0 for an empty group.

    Ages below zero lie in the future of the reference time and take no part.
    """
    weight = F.when(
        (age_hours >= 0) & value.isNotNull(), decay_weight(age_hours, half_life_hours)
    )
    total = F.sum(weight)
    return F.when(total > 0, F.sum(value * weight) / total).otherwise(F.lit(0.0))
