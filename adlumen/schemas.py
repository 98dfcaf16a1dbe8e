"""Declared schemas and fixed vocabularies of the ad-event tables."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Vocabularies shared with the systems that produce the events.
EVENT_TYPES = (
    "impression", "click", "conversion", "bid_request", "bid_response", "view", "engagement",
)
PARTITIONED_EVENT_TYPES = ("impression", "click", "conversion", "bid_request", "bid_response")
DEVICE_TYPES = ("mobile", "desktop", "tablet", "ctv", "unknown")
RFM_TIERS = (
    "champions", "loyal", "potential_loyal", "new_users",
    "at_risk", "cant_lose", "hibernating", "lost",
)
STORAGE_TIERS = ("hot", "warm", "cold", "archive")
FEATURE_NAMES = (
    "ctr_1h", "ctr_6h", "ctr_24h",
    "cvr_1h", "cvr_6h", "cvr_24h",
    "ecpm_1h", "ecpm_24h",
    "ctr_decayed", "cvr_decayed", "ecpm_decayed",
    "budget_utilization", "pacing_factor",
    "impressions_24h_log", "clicks_24h_log", "conversions_24h_log",
)
FEATURE_VERSION = "v1"

HIERARCHY = ("advertiser_id", "campaign_id", "adset_id", "ad_id")
METRICS = ("impressions", "clicks", "conversions", "views", "spend", "revenue")


def _fields(required: dict, optional: dict) -> list[StructField]:
    return [StructField(n, t, False) for n, t in required.items()] + [
        StructField(n, t, True) for n, t in optional.items()
    ]


_S, _D, _T, _L = StringType(), DoubleType(), TimestampType(), LongType()

AD_EVENT = StructType(
    _fields(
        dict.fromkeys(
            ("event_id", "event_type", "ad_id", "campaign_id", "adset_id",
             "advertiser_id", "publisher_id", "placement_id"), _S)
        | {"timestamp": _T},
        {
            "user_id": _S, "session_id": _S, "device_type": _S, "country_code": _S,
            "platform": _S, "revenue": _D, "cost": _D, "metadata": _S,
        },
    )
)

SSP_EVENT = StructType(
    AD_EVENT.fields
    + _fields(
        {"auction_id": _S},
        {"floor_price": _D, "winning_bid": _D, "deal_id": _S,
         "inventory_type": _S, "viewability_score": _D},
    )
)

DSP_EVENT = StructType(
    AD_EVENT.fields
    + _fields(
        {},
        {"bid_price": _D, "clearing_price": _D, "targeting_data": _S, "frequency_cap": _L,
         "frequency_count": _L, "budget_remaining": _D, "pacing_factor": _D},
    )
)

USER_ACTION = StructType(
    _fields(
        dict.fromkeys(
            ("action_id", "user_id", "ad_id", "campaign_id", "advertiser_id", "action_type"), _S)
        | {"action_timestamp": _T},
        {"click_timestamp": _T, "impression_timestamp": _T,
         "attribution_window_days": IntegerType(), "revenue_value": _D, "currency": _S,
         "is_view_through": BooleanType(), "metadata": _S},
    )
)

SEGMENT_MEMBERSHIP = StructType(
    _fields(
        {"user_id": _S, "segment_id": _S, "score": _D, "computed_at": _T},
        {"expires_at": _T, "features": MapType(_S, _D)},
    )
)

RUN_LEDGER = StructType(
    _fields(
        {"run_type": _S, "run_date": DateType(), "recorded_at": _T},
        {"status": _S, "metrics": MapType(_S, _D), "tags": MapType(_S, _S)},
    )
)

# What a missing optional field means.
AD_EVENT_DEFAULTS = {"device_type": "unknown", "country_code": "US", "revenue": 0.0, "cost": 0.0,
                     "metadata": "{}"}
SSP_DEFAULTS = {"floor_price": 0.0, "inventory_type": "display"}
DSP_DEFAULTS = {"bid_price": 0.0, "targeting_data": "{}", "frequency_count": 0, "pacing_factor": 1.0}
USER_ACTION_DEFAULTS = {"attribution_window_days": 7, "revenue_value": 0.0, "currency": "USD",
                        "is_view_through": False, "metadata": "{}"}


def columns_of(schema: StructType) -> list[str]:
    return [f.name for f in schema.fields]


def required_columns(schema: StructType) -> list[str]:
    return [f.name for f in schema.fields if not f.nullable]
