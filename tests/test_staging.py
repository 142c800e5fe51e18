import datetime as dt

from pyspark.sql import functions as F

from clickloom.plans import staging
from tests.rows import raw, rows_of, ts

IMPRESSION_COLUMNS = [
    "impression_id", "campaign_id", "channel", "platform", "timestamp", "impression_date", "impression_week",
    "impression_month", "device_type", "country", "cost_micros", "cost_euros"]
CAMPAIGN_COLUMNS = [
    "campaign_id", "campaign_name", "channel", "platform", "start_date", "end_date", "campaign_duration_days",
    "budget_euros", "budget_tier", "target_audience", "objective", "channel_group"]
CLICK_COLUMNS = [
    "click_id", "impression_id", "campaign_id", "channel", "platform", "click_timestamp", "click_date", "click_week",
    "click_month", "device_type", "country", "cost_micros", "cost_euros", "impression_timestamp", "seconds_to_click"]
CONVERSION_COLUMNS = [
    "conversion_id", "click_id", "campaign_id", "customer_id", "conversion_timestamp", "conversion_date",
    "conversion_week", "conversion_month", "revenue_euros", "conversion_type", "channel", "platform", "device_type",
    "country", "click_timestamp", "minutes_to_convert", "revenue_tier", "conversion_type_label"]


def test_impressions(spark):
    df = staging.stg_ad_impressions(raw(spark, "raw_ad_impressions", [
        {"impression_id": "i1", "timestamp": ts("2024-01-07 10:00:00"), "channel": "old"},
        {"impression_id": "i1", "timestamp": ts("2024-01-07 23:59:59"), "channel": " Google_Ads\t", "platform": " GOOGLE ",
         "device_type": None, "country": None, "cost_micros": 12350},
    ]))
    assert df.columns == IMPRESSION_COLUMNS
    assert [tuple(r) for r in df.collect()] == [(
        "i1", "x", "GOOGLE_ADS", "google", ts("2024-01-07 23:59:59"), dt.date(2024, 1, 7), ts("2024-01-01"),
        dt.date(2024, 1, 1), "unknown", "XX", 12350, 0.0124)]


def test_campaigns_are_not_deduplicated(spark):
    df = staging.stg_campaigns(raw(spark, "raw_campaigns", [
        {"campaign_id": "C001", "campaign_name": " Promo ", "channel": "Email", "platform": "EMAIL",
         "end_date": dt.date(2024, 1, 31), "budget_euros": 7000.0, "target_audience": None, "objective": " Awareness"},
        {"campaign_id": "C001"},
    ]))
    assert df.columns == CAMPAIGN_COLUMNS
    got = rows_of(df.filter(F.col("campaign_name") == "Promo"), *CAMPAIGN_COLUMNS)
    assert got == [("C001", "Promo", "EMAIL", "email", dt.date(2024, 1, 1), dt.date(2024, 1, 31), 30, 7000.0,
                    "medium", "unspecified", "awareness", "Owned")]
    assert df.count() == 2
    assert df.filter("channel = 'X'").first().channel_group == "Other"


def test_clicks_meet_the_latest_copy_of_their_impression(spark):
    impressions = raw(spark, "raw_ad_impressions", [
        {"impression_id": "i1", "timestamp": ts("2024-01-01 00:00:00")},
        {"impression_id": "i1", "timestamp": ts("2024-01-01 00:00:05")},
    ])
    clicks = raw(spark, "raw_clicks", [
        {"click_id": "k1", "impression_id": "i1", "timestamp": ts("2024-01-01 00:01:00")},
        {"click_id": "k2", "impression_id": "gone", "timestamp": ts("2024-01-01 00:01:00")},
        {"click_id": "k3", "impression_id": "i1", "timestamp": ts("2024-01-01 00:00:00")},
    ])
    from_raw = staging.stg_clicks(clicks, impressions)
    from_clean = staging.stg_clicks(clicks, staging.stg_ad_impressions(impressions), impressions_unique=True)
    assert from_raw.columns == CLICK_COLUMNS
    for df in (from_raw, from_clean):
        assert rows_of(df, "click_id", "impression_timestamp", "seconds_to_click") == [
            ("k1", ts("2024-01-01 00:00:05"), 55), ("k2", None, None), ("k3", ts("2024-01-01 00:00:05"), -5)]


def test_conversions(spark):
    clicks = staging.clean_clicks(raw(spark, "raw_clicks", [
        {"click_id": "k1", "timestamp": ts("2024-01-01 00:00:30"), "channel": "seo", "device_type": None}]))
    df = staging.stg_conversions(raw(spark, "raw_conversions", [
        {"conversion_id": "v1", "click_id": "k1", "timestamp": ts("2024-01-01 01:00:29"), "revenue": None,
         "conversion_type": " SIGNUP"},
        {"conversion_id": "v2", "click_id": "gone", "revenue": 200.0, "conversion_type": "call"},
    ]), clicks)
    assert df.columns == CONVERSION_COLUMNS
    picked = ["conversion_id", "channel", "device_type", "minutes_to_convert", "revenue_euros", "revenue_tier",
              "conversion_type", "conversion_type_label"]
    assert rows_of(df, *picked) == [
        ("v1", "SEO", "unknown", 59, 0.0, "no_value", "signup", "Signup"),
        ("v2", None, None, None, 200.0, "medium", "call", "Other")]


def test_staging_keys_are_unique_on_the_feeds(feeds):
    for df, key in (
        (staging.stg_ad_impressions(feeds.impressions), "impression_id"),
        (staging.stg_clicks(feeds.clicks, feeds.impressions), "click_id"),
        (staging.stg_conversions(feeds.conversions, staging.clean_clicks(feeds.clicks)), "conversion_id"),
    ):
        assert df.groupBy(key).count().filter("count > 1").count() == 0
