"""Raw feeds to clean tables: one row per key, normal labels, derived columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions import (
    budget_tier,
    channel_group,
    conversion_label,
    elapsed,
    micros_to_euros,
    month_start,
    normalize_label,
    revenue_tier,
    strip_space,
    week_start,
)
from clickloom.operators import dedup_latest, dedup_latest_rare, hot_keys, skew_safe_left_join


def _calendar(prefix: str, ts: str = "timestamp") -> list[Column]:
    """Date, Monday week and month of an event, as ``<prefix>_date`` and so on."""
    return [
        F.to_date(ts).alias(f"{prefix}_date"),
        week_start(ts).alias(f"{prefix}_week"),
        month_start(ts).alias(f"{prefix}_month"),
    ]


def _audience() -> list[Column]:
    return [
        F.coalesce("device_type", F.lit("unknown")).alias("device_type"),
        F.coalesce("country", F.lit("XX")).alias("country"),
    ]


def _cost() -> list[Column]:
    return [F.col("cost_micros"), micros_to_euros("cost_micros").alias("cost_euros")]


def _labels() -> list[Column]:
    return [normalize_label("channel", "upper").alias("channel"),
            normalize_label("platform", "lower").alias("platform")]


def stg_ad_impressions(raw_impressions: DataFrame) -> DataFrame:
    """Clean impressions, one row per impression_id (the latest wins).

    The widest and largest feed, of which few events are sent again, and nobody looks up its rows by a join
    that could be dropped: so only repeated impressions are compared.
    """
    latest = dedup_latest_rare(raw_impressions, ["impression_id"], "timestamp")
    return latest.select(
        "impression_id", "campaign_id", *_labels(), "timestamp", *_calendar("impression"),
        *_audience(), *_cost(),
    )


def stg_campaigns(raw_campaigns: DataFrame) -> DataFrame:
    """Clean campaigns with duration, budget tier and channel group; rows are not deduplicated."""
    return raw_campaigns.select(
        "campaign_id",
        strip_space("campaign_name").alias("campaign_name"),
        *_labels(),
        "start_date", "end_date",
        F.datediff("end_date", "start_date").cast("bigint").alias("campaign_duration_days"),
        "budget_euros",
        budget_tier("budget_euros").alias("budget_tier"),
        F.coalesce("target_audience", F.lit("unspecified")).alias("target_audience"),
        normalize_label("objective", "lower").alias("objective"),
        channel_group(normalize_label("channel", "upper")).alias("channel_group"),
    )


def clean_clicks(raw_clicks: DataFrame) -> DataFrame:
    """Clean clicks, one row per click_id, before they meet their impressions."""
    latest = dedup_latest(raw_clicks, ["click_id"], "timestamp")
    return latest.select(
        "click_id", "impression_id", "campaign_id", *_labels(),
        F.col("timestamp").alias("click_timestamp"), *_calendar("click"), *_audience(), *_cost(),
    )


def impression_times(impressions: DataFrame) -> DataFrame:
    """Time of each impression, from raw or clean impressions.

    Deduplication keeps the latest copy, so its time is the greatest one; reading only two
    columns and aggregating spares the wide deduplication when it is not needed otherwise.
    """
    return impressions.groupBy("impression_id").agg(F.max("timestamp").alias("impression_timestamp"))


def stg_clicks(raw_clicks: DataFrame, impressions: DataFrame, impressions_unique: bool = False) -> DataFrame:
    """Clean clicks with the time of their impression and the seconds between the two.

    ``impressions`` may be the raw feed or the clean table; say ``impressions_unique`` for
    the latter to read it without aggregating.
    """
    if impressions_unique:
        times = impressions.select("impression_id", F.col("timestamp").alias("impression_timestamp"))
    else:
        times = impression_times(impressions)
    joined = skew_safe_left_join(clean_clicks(raw_clicks), times, ["impression_id"], ["click_id"],
                                 hot=hot_keys(raw_clicks, ["impression_id"]))
    columns = [
        "click_id", "impression_id", "campaign_id", "channel", "platform", "click_timestamp",
        "click_date", "click_week", "click_month", "device_type", "country", "cost_micros", "cost_euros",
    ]
    return joined.select(
        *columns, "impression_timestamp",
        elapsed("SECOND", "impression_timestamp", "click_timestamp").alias("seconds_to_click"),
    )


def clean_conversions(raw_conversions: DataFrame) -> DataFrame:
    """Clean conversions, one row per conversion_id, before they meet their clicks."""
    latest = dedup_latest(raw_conversions, ["conversion_id"], "timestamp")
    return latest.select(
        "conversion_id", "click_id", "campaign_id", "customer_id",
        F.col("timestamp").alias("conversion_timestamp"), *_calendar("conversion"),
        F.coalesce("revenue", F.lit(0.0)).alias("revenue_euros"),
        normalize_label("conversion_type", "lower").alias("conversion_type"),
    )


def stg_conversions(raw_conversions: DataFrame, clicks: DataFrame) -> DataFrame:
    """Clean conversions with the channel, audience and time of their click, and tiers.

    ``clicks`` is any frame with one row per click_id: clean_clicks or stg_clicks.
    """
    context = clicks.select("click_id", "channel", "platform", "device_type", "country", "click_timestamp")
    joined = skew_safe_left_join(clean_conversions(raw_conversions), context, ["click_id"], ["conversion_id"],
                                 hot=hot_keys(raw_conversions, ["click_id"]))
    return joined.select(
        "conversion_id", "click_id", "campaign_id", "customer_id", "conversion_timestamp",
        "conversion_date", "conversion_week", "conversion_month", "revenue_euros", "conversion_type",
        "channel", "platform", "device_type", "country", "click_timestamp",
        elapsed("MINUTE", "click_timestamp", "conversion_timestamp").alias("minutes_to_convert"),
        revenue_tier("revenue_euros").alias("revenue_tier"),
        conversion_label("conversion_type").alias("conversion_type_label"),
    )
