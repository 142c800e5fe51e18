"""Declared schemas, domains and physical layout of the raw tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The value domains of the feeds.
CHANNEL_PLATFORM = {
    "Google_Ads": "google",
    "Meta_Ads": "meta",
    "TikTok_Ads": "tiktok",
    "LinkedIn_Ads": "linkedin",
    "Email": "email",
    "SEO": "organic",
}
CHANNELS = list(CHANNEL_PLATFORM)
PLATFORMS = list(CHANNEL_PLATFORM.values())
DEVICES = ["mobile", "desktop", "tablet"]
COUNTRIES = ["ES", "FR", "DE", "PT", "IT", "UK"]
CONVERSION_TYPES = ["purchase", "signup", "lead"]
OBJECTIVES = ["awareness", "consideration", "conversion"]


def _field(name: str, kind: T.DataType, required: bool, comment: str) -> T.StructField:
    return T.StructField(name, kind, not required, {"comment": comment})


def _ad_event(id_name: str, noun: str, extra: list[T.StructField]) -> T.StructType:
    """Impressions and clicks share everything but their keys."""
    return T.StructType(
        [_field(id_name, T.StringType(), True, f"Key of the {noun}")]
        + extra
        + [
            _field("campaign_id", T.StringType(), True, "Campaign the event belongs to"),
            _field("channel", T.StringType(), True, "Channel: " + ", ".join(CHANNELS)),
            _field("platform", T.StringType(), True, "Platform: " + ", ".join(PLATFORMS)),
            _field("timestamp", T.TimestampType(), True, f"Instant of the {noun} (UTC)"),
            _field("device_type", T.StringType(), False, "Device: " + ", ".join(DEVICES)),
            _field("country", T.StringType(), False, "Two-letter market code"),
            _field("cost_micros", T.LongType(), False, "Cost in millionths of a euro"),
        ]
    )


RAW_AD_IMPRESSIONS = _ad_event("impression_id", "impression", [])
RAW_CLICKS = _ad_event(
    "click_id", "click", [_field("impression_id", T.StringType(), True, "Impression that was clicked")]
)
RAW_CONVERSIONS = T.StructType(
    [
        _field("conversion_id", T.StringType(), True, "Key of the conversion"),
        _field("click_id", T.StringType(), True, "Click that led to the conversion"),
        _field("campaign_id", T.StringType(), True, "Campaign the conversion belongs to"),
        _field("customer_id", T.StringType(), True, "Customer who converted"),
        _field("timestamp", T.TimestampType(), True, "Instant of the conversion (UTC)"),
        _field("revenue", T.DoubleType(), False, "Revenue in euros; zero for signups"),
        _field("conversion_type", T.StringType(), False, "Type: " + ", ".join(CONVERSION_TYPES)),
    ]
)
RAW_CAMPAIGNS = T.StructType(
    [
        _field("campaign_id", T.StringType(), True, "Key of the campaign"),
        _field("campaign_name", T.StringType(), True, "Name shown in reports"),
        _field("channel", T.StringType(), True, "Channel the campaign runs on"),
        _field("platform", T.StringType(), True, "Platform the campaign runs on"),
        _field("start_date", T.DateType(), True, "First day"),
        _field("end_date", T.DateType(), True, "Last day"),
        _field("budget_euros", T.DoubleType(), True, "Whole budget in euros"),
        _field("target_audience", T.StringType(), False, "Audience description"),
        _field("objective", T.StringType(), True, "Objective: " + ", ".join(OBJECTIVES)),
    ]
)


@dataclass(frozen=True)
class TableSpec:
    """Name, schema and layout of a table."""

    layer: str
    name: str
    schema: T.StructType | None = None
    partition_by: str | None = None  # column that the files are partitioned by
    partition_expr: str | None = None  # SQL expression for it, when it is derived on write
    cluster_by: tuple[str, ...] = ()  # sort order within files, for min/max pruning
    description: str = ""
    labels: dict[str, str] = field(default_factory=dict)


RAW_TABLES = {
    spec.name: spec
    for spec in (
        TableSpec("raw", "raw_ad_impressions", RAW_AD_IMPRESSIONS, "event_date", "to_date(timestamp)",
                  ("campaign_id", "channel"), "Ad impressions from all channels",
                  {"source": "ad_platforms", "grain": "impression"}),
        TableSpec("raw", "raw_clicks", RAW_CLICKS, "event_date", "to_date(timestamp)",
                  ("campaign_id", "channel"), "Ad clicks, keyed to impressions",
                  {"source": "ad_platforms", "grain": "click"}),
        TableSpec("raw", "raw_conversions", RAW_CONVERSIONS, "event_date", "to_date(timestamp)",
                  ("campaign_id", "conversion_type"), "Purchases, signups and leads",
                  {"source": "ad_platforms", "grain": "conversion"}),
        TableSpec("raw", "raw_campaigns", RAW_CAMPAIGNS, None, None,
                  ("channel", "objective"), "Campaigns with budget and targeting",
                  {"source": "campaign_management", "grain": "campaign"}),
    )
}

DERIVED_TABLES = {
    spec.name: spec
    for spec in (
        TableSpec("staging", "stg_ad_impressions", description="Clean impressions, one row per impression"),
        TableSpec("staging", "stg_campaigns", description="Clean campaigns with tiers and groups"),
        TableSpec("staging", "stg_clicks", description="Clean clicks with the time of their impression"),
        TableSpec("staging", "stg_conversions", description="Clean conversions with the context of their click"),
        TableSpec("analytics", "int_campaign_performance", description="Funnel totals and ratios by campaign"),
        TableSpec("analytics", "int_attribution", description="Conversion credit by attribution model"),
        TableSpec("analytics", "rpt_marketing_dashboard", None, "date", None, ("channel",),
                  "Daily performance by channel and platform", {"mart": "dashboard", "refresh": "daily"}),
        TableSpec("analytics", "rpt_channel_roi",
                  description="Return on investment by channel", labels={"mart": "channel_roi", "refresh": "daily"}),
        TableSpec("analytics", "rpt_customer_acquisition",
                  description="Acquisition cost and lifetime value by channel and month",
                  labels={"mart": "customer_acquisition", "refresh": "daily"}),
    )
}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the declared columns, in order, with the declared types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
