"""RFM scores, tiers and the engagement score."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def ascending_score(value: Column, cuts: list[Column]) -> Column:
    """1 + number of the first cut the value lies below; the top score past all cuts."""
    branches = F
    for score, cut in enumerate(cuts, 1):
        branches = branches.when(value < cut, F.lit(score))
    return branches.otherwise(F.lit(len(cuts) + 1))


def descending_score(value: Column, cuts: list[Column]) -> Column:
    """Low is good: count down from the highest cut. An unknown value scores lowest."""
    branches = F.when(value.isNull(), F.lit(1))
    for score, cut in enumerate(reversed(cuts), 1):
        branches = branches.when(value >= cut, F.lit(score))
    return branches.otherwise(F.lit(len(cuts) + 1))


def rfm_tier(r: Column, f: Column, m: Column, separate_cant_lose: bool = False) -> Column:
    """First matching tier.

    In the standard order the ``cant_lose`` rule is shadowed by ``loyal`` and never
    fires; ``separate_cant_lose`` moves it ahead so that lapsed big spenders get it.
    """
    rules = {
        "champions": (r >= 4) & (f >= 4) & (m >= 4),
        "loyal": (f >= 4) & (m >= 4),
        "potential_loyal": (r >= 3) & (f >= 3),
        "new_users": (r >= 4) & (f <= 2),
        "at_risk": (r <= 2) & (f >= 3),
        "lost": (r <= 2) & (f <= 2) & (m <= 2),
    }
    order = list(rules)
    if separate_cant_lose:
        rules["cant_lose"] = (r <= 2) & (f >= 4) & (m >= 4)
        order.insert(1, "cant_lose")
    tier = F
    for name in order:
        tier = tier.when(rules[name], F.lit(name))
    return tier.otherwise(F.lit("hibernating"))


def rfm_code(r: Column, f: Column, m: Column) -> Column:
    return F.concat(r.cast("string"), f.cast("string"), m.cast("string"))


def engagement_score(
    ctr: Column,
    cvr: Column,
    impressions: Column,
    days: Column,
    full_impressions: int = 1000,
    full_days: int = 90,
) -> Column:
    """0..1 composite: 30 % CTR, 30 % CVR, 20 % volume, 20 % recency."""
    # least/greatest skip NULL, so missing inputs are settled first
    ctr, cvr, impressions = (F.coalesce(c, F.lit(0)) for c in (ctr, cvr, impressions))
    days = F.coalesce(days, F.lit(full_days))
    one, zero = F.lit(1.0), F.lit(0.0)
    return (
        F.least(ctr / 0.10, one) * 0.3
        + F.least(cvr / 0.05, one) * 0.3
        + F.least(impressions / full_impressions, one) * 0.2
        + F.greatest(zero, one - days / full_days) * 0.2
    )
