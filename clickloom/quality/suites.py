"""The suites of the raw feeds and of the daily report."""

from __future__ import annotations

from clickloom.quality.expectations import (
    CLICKS_HAVE_IMPRESSIONS,
    CONVERSIONS_HAVE_CLICKS,
    Suite,
    check,
    suite,
)
from clickloom.schemas import (
    CHANNELS,
    CONVERSION_TYPES,
    COUNTRIES,
    DEVICES,
    RAW_AD_IMPRESSIONS,
    RAW_CLICKS,
    RAW_CONVERSIONS,
)

# Row-count floors, the cost and revenue ranges, and the campaign key pattern.
MIN_IMPRESSIONS, MIN_CLICKS, MIN_CONVERSIONS = 1_000_000, 100_000, 50_000
COST_MICROS = (0, 1_000_000)
REVENUE_EUROS = (0.01, 10_000.0)
MOSTLY = 0.99
CAMPAIGN_KEY = r"C\d{3}"

RAW_IMPRESSIONS_SUITE = suite(
    "raw_impressions_suite", "raw_ad_impressions",
    check.rows_between(MIN_IMPRESSIONS),
    check.not_null("impression_id", "campaign_id", "channel", "timestamp"),
    check.unique("impression_id"),
    check.in_set("channel", CHANNELS),
    check.in_set("device_type", DEVICES),
    check.in_set("country", COUNTRIES),
    check.between("cost_micros", *COST_MICROS, mostly=MOSTLY),
    check.matches("campaign_id", CAMPAIGN_KEY),
    check.exist(*RAW_AD_IMPRESSIONS.names),
)

RAW_CLICKS_SUITE = suite(
    "raw_clicks_suite", "raw_clicks",
    check.rows_between(MIN_CLICKS),
    check.not_null("click_id", "impression_id", "campaign_id", "timestamp"),
    check.unique("click_id"),
    check.between("cost_micros", *COST_MICROS, mostly=MOSTLY),
    check.in_set("channel", CHANNELS),
    check.exist(*RAW_CLICKS.names),
)

RAW_CONVERSIONS_SUITE = suite(
    "raw_conversions_suite", "raw_conversions",
    check.rows_between(MIN_CONVERSIONS),
    check.not_null("conversion_id", "click_id", "campaign_id", "timestamp", "revenue"),
    check.unique("conversion_id"),
    check.between("revenue", *REVENUE_EUROS, mostly=MOSTLY),
    check.in_set("conversion_type", CONVERSION_TYPES),
    check.exist(*RAW_CONVERSIONS.names),
)

MART_DASHBOARD_SUITE = suite(
    "mart_dashboard_suite", "rpt_marketing_dashboard",
    check.rows_above(0),
    check.not_null("date", "channel"),
    check.between("spend_euros", 0),
    check.between("revenue_euros", 0),
    check.between("ctr_pct", 0, 100),
    check.between("conversion_rate_pct", 0, 100),
    check.exist("date", "channel", "spend_euros", "revenue_euros"),
)

SUITES = {s.name: s for s in (RAW_IMPRESSIONS_SUITE, RAW_CLICKS_SUITE, RAW_CONVERSIONS_SUITE, MART_DASHBOARD_SUITE)}

CHECKPOINTS = {
    "raw_data_checkpoint": [RAW_IMPRESSIONS_SUITE, RAW_CLICKS_SUITE, RAW_CONVERSIONS_SUITE],
    "mart_data_checkpoint": [MART_DASHBOARD_SUITE],
}


def integrity_suites() -> list[Suite]:
    """Checks across tables and of costs, which the plain suites leave out."""
    return [
        suite("impression_cost_suite", "raw_ad_impressions", check.positive("cost_micros")),
        suite("click_integrity_suite", "raw_clicks", check.references(CLICKS_HAVE_IMPRESSIONS),
              check.positive("cost_micros")),
        suite("conversion_integrity_suite", "raw_conversions", check.references(CONVERSIONS_HAVE_CLICKS)),
    ]
