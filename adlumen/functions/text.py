"""E-mail format and metric names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# An address: dotted words before the @, none empty; after it labels that neither start nor
# end with a hyphen, the last of letters alone. No part can be read in two ways, so matching
# takes linear time.
EMAIL_PATTERN = (
    r"^[0-9A-Za-z_+-]+(\.[0-9A-Za-z_+-]+)*@([0-9A-Za-z]+(-+[0-9A-Za-z]+)*\.)+[A-Za-z]{2,}$"
)
EMAIL_LOCAL_LENGTH = 64


def is_email(text: Column) -> Column:
    local = F.substring_index(text, "@", 1)
    return text.rlike(EMAIL_PATTERN) & (F.length(local) <= EMAIL_LOCAL_LENGTH)


def metric_name(metric: Column, tags: Column) -> Column:
    """``metric.k1_v1.k2_v2`` with tags in key order; the bare metric without tags."""
    suffix = F.array_join(
        F.transform(
            F.array_sort(F.map_entries(tags)), lambda e: F.concat(e["key"], F.lit("_"), e["value"])
        ),
        ".",
    )
    return F.when(F.coalesce(F.size(tags), F.lit(0)) <= 0, metric).otherwise(
        F.concat(metric, F.lit("."), suffix)
    )
