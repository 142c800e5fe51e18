import datetime as dt

import pytest
from pyspark.sql import functions as F

from clickloom.plans import campaigns, marts, staging
from tests.rows import raw, rows_of, ts

DASHBOARD_COLUMNS = [
    "date", "channel", "platform", "impressions", "clicks", "conversions", "spend_euros", "revenue_euros", "ctr_pct",
    "cpc_eur", "cpa_eur", "roas", "conversion_rate_pct", "purchases", "signups", "leads", "cost_of_revenue_pct"]
ROI_COLUMNS = [
    "channel", "total_impressions", "total_clicks", "total_conversions", "total_spend_euros", "total_revenue_euros",
    "profit_euros", "roi_pct", "avg_cpa_eur", "avg_roas", "ctr_pct", "conversion_rate_pct", "best_campaign_name",
    "best_campaign_roas", "worst_campaign_name", "worst_campaign_roas", "channel_health_score"]
ACQUISITION_COLUMNS = [
    "channel", "acquisition_month", "new_customers", "cac_eur", "avg_first_order_value", "avg_ltv_30d", "avg_ltv_90d",
    "payback_period_days", "ltv_90d_to_cac_ratio", "acquisition_health", "avg_conversions_per_customer"]


@pytest.fixture(scope="module")
def tables(spark):
    camp = staging.stg_campaigns(raw(spark, "raw_campaigns", [
        {"campaign_id": "C1", "campaign_name": "One", "channel": "seo"},
        {"campaign_id": "C2", "campaign_name": "Two", "channel": "seo"},
        {"campaign_id": "C3", "campaign_name": "Idle", "channel": "email"},
    ]))
    imp = staging.stg_ad_impressions(raw(spark, "raw_ad_impressions", [
        {"impression_id": f"i{n}", "campaign_id": "C1", "channel": ch, "platform": "p"}
        for n, ch in enumerate(["seo", "seo", "email", "seo"])
    ] + [{"impression_id": "j", "campaign_id": "C2", "channel": "seo", "platform": "p", "cost_micros": 500_000}]))
    clk = staging.clean_clicks(raw(spark, "raw_clicks", [
        {"click_id": "k1", "campaign_id": "C1", "channel": "seo", "platform": "p"},
        {"click_id": "k2", "campaign_id": "C1", "channel": "seo", "platform": "p"},
        {"click_id": "k3", "campaign_id": "C2", "channel": "radio", "platform": "p"},
    ]))
    cv = staging.stg_conversions(raw(spark, "raw_conversions", [
        {"conversion_id": "v1", "click_id": "k1", "campaign_id": "C1", "customer_id": "u1", "revenue": 30.0,
         "conversion_type": "purchase"},
        {"conversion_id": "v2", "click_id": "k2", "campaign_id": "C1", "customer_id": "u1", "revenue": 5.0,
         "conversion_type": "lead"},
    ]), clk)
    return camp, imp, clk, cv


def test_campaign_rows_fan_out_by_impression_channel(tables):
    perf = campaigns.int_campaign_performance(*tables)
    got = rows_of(perf, "campaign_id", "total_impressions", "total_clicks", "total_conversions", "total_cost_euros",
                  "total_revenue_euros", "unique_customers", "ctr", "roas")
    assert got == [
        ("C1", 1, 2, 2, 1.0, 35.0, 1, 2.0, 35.0),
        ("C1", 3, 2, 2, 3.0, 35.0, 1, 2 / 3, 35.0 / 3),
        ("C2", 1, 1, 0, 0.5, 0.0, 0, 1.0, None),
        ("C3", 0, 0, 0, 0.0, 0.0, 0, None, None)]


def test_campaign_grain_gives_one_row_per_campaign(tables):
    perf = campaigns.int_campaign_performance(*tables, grain="campaign")
    assert rows_of(perf, "campaign_id", "total_impressions", "total_purchases", "total_signups", "total_leads") == [
        ("C1", 4, 1, 0, 1), ("C2", 1, 0, 0, 0), ("C3", 0, 0, 0, 0)]
    with pytest.raises(ValueError):
        campaigns.int_campaign_performance(*tables, grain="country")


def test_dashboard_is_driven_by_impressions(tables):
    _, imp, clk, cv = tables
    dash = marts.rpt_marketing_dashboard(imp, clk, cv)
    assert dash.columns == DASHBOARD_COLUMNS
    assert rows_of(dash, "channel", "impressions", "clicks", "conversions", "spend_euros", "ctr_pct", "cpa_eur") == [
        ("EMAIL", 1, 0, 0, 1.0, None, None), ("SEO", 4, 2, 2, 3.5, 50.0, 1.75)]
    full = marts.rpt_marketing_dashboard(imp, clk, cv, keep_unmatched=True)
    assert rows_of(full.filter("channel = 'RADIO'"), "impressions", "clicks", "spend_euros") == [(0, 1, 0.0)]


def test_channel_roi(tables):
    roi = marts.rpt_channel_roi(campaigns.int_campaign_performance(*tables))
    assert roi.columns == ROI_COLUMNS
    seo = roi.filter("channel = 'SEO'").first()
    # Conversions of the fanned-out campaign count once per row.
    assert (seo.total_conversions, seo.total_spend_euros, seo.total_revenue_euros) == (4, 4.5, 70.0)
    assert (seo.best_campaign_name, seo.best_campaign_roas) == ("One", 35.0)
    assert (seo.worst_campaign_name, seo.worst_campaign_roas) == ("One", 11.67)  # an unknown return ranks last
    assert seo.channel_health_score == 100.0
    idle = roi.filter("channel = 'EMAIL'").first()
    assert (idle.best_campaign_name, idle.roi_pct, idle.channel_health_score) == (None, None, None)


def test_best_and_worst_break_ties_by_campaign(spark):
    perf = spark.createDataFrame(
        [("SEO", "C2", "b", 1.0, 2.0), ("SEO", "C1", "a", 1.0, 2.0), ("SEO", "C0", "free", 0.0, 9.0),
         ("SEO", "C3", "none", 1.0, None)],
        "channel string, campaign_id string, campaign_name string, total_cost_euros double, roas double")
    row = marts.best_worst_campaign(perf).first()
    assert (row.best_campaign_name, row.worst_campaign_name) == ("a", "a")


def test_health_score_bounds(spark):
    df = spark.createDataFrame([(1, 0.5, 0.001, 0.001), (2, None, 0.1, 0.1), (3, -9.0, 0.0, 0.0), (4, 0.0, 0.02, 0.034)],
                               "i int, r double, c double, v double")
    got = [r[1] for r in df.select("i", marts.health_score(F.col("r"), F.col("c"), F.col("v"))).orderBy("i").collect()]
    assert got == [26.0, None, 0.0, 100.0]


def conversions(spark, rows):
    return spark.createDataFrame(
        [(f"v{i}", *r, "lead") for i, r in enumerate(rows)],
        "conversion_id string, customer_id string, channel string, platform string, campaign_id string, "
        "conversion_timestamp timestamp, revenue_euros double, conversion_type string")


def acquisition(spark, rows, spend=(("SEO", 100.0),)):
    perf = spark.createDataFrame(list(spend), "channel string, total_cost_euros double")
    return marts.rpt_customer_acquisition(conversions(spark, rows), perf)


def test_ltv_windows_count_elapsed_days(spark):
    start = ts("2024-01-01 12:00:00")
    rows = [("u", "SEO", "p", "C", start + dt.timedelta(**d), 1.0)
            for d in ({}, {"days": 30, "seconds": 1}, {"days": 31}, {"days": 90, "hours": 23}, {"days": 91})]
    ltv = marts.customer_ltv(conversions(spark, rows))
    assert rows_of(ltv, "ltv_30d", "ltv_90d", "ltv_total", "total_conversions") == [(2.0, 4.0, 5.0, 5)]


def test_acquisition_of_a_customer_with_two_first_conversions(spark):
    at = ts("2024-01-15 00:00:00")
    df = acquisition(spark, [("u", "SEO", "p", "C", at, 10.0), ("u", "SEO", "p", "C", at, 20.0),
                             ("w", "SEO", "p", "C", at, 60.0)])
    assert df.columns == ACQUISITION_COLUMNS
    row = df.first()
    # Counted once, but averaged once per conversion at the first instant: (30 + 30 + 60) / 3.
    assert (row.new_customers, row.avg_ltv_90d, row.cac_eur) == (2, 40.0, 50.0)
    assert row.avg_conversions_per_customer == 1.7
    assert (row.ltv_90d_to_cac_ratio, row.payback_period_days, row.acquisition_health) == (0.8, 113.0, "unhealthy")


def test_tied_first_conversions_on_two_channels_count_for_both(spark):
    at = ts("2024-01-15 00:00:00")
    df = acquisition(spark, [("u", "SEO", "p", "C", at, 10.0), ("u", "EMAIL", "p", "C", at, 20.0),
                             ("u", "META", "p", "C", at + dt.timedelta(days=1), 20.0)])
    assert rows_of(df, "channel", "new_customers", "avg_ltv_30d") == [("EMAIL", 1, 50.0), ("SEO", 1, 50.0)]


def test_customer_without_channel_is_unhealthy(spark):
    row = acquisition(spark, [("u", None, None, "C", ts("2024-01-15 00:00:00"), 10.0)]).first()
    assert (row.channel, row.cac_eur, row.acquisition_health) == (None, None, "unhealthy")


def test_first_conversions_keep_ties(spark):
    at = ts("2024-01-15 00:00:00")
    rows = [("u", "SEO", "p", "C1", at, 1.0), ("u", "EMAIL", "p", "C2", at, 1.0),
            ("u", "SEO", "p", "C3", at + dt.timedelta(seconds=1), 1.0)]
    df = marts.first_conversions(conversions(spark, rows))
    assert rows_of(df, "acquisition_campaign_id", "acquisition_month") == [
        ("C1", ts("2024-01-01")), ("C2", ts("2024-01-01"))]


def test_spend_of_the_dashboard_is_the_spend_of_the_impressions(feeds):
    imp = staging.stg_ad_impressions(feeds.impressions)
    clk = staging.clean_clicks(feeds.clicks)
    cv = staging.stg_conversions(feeds.conversions, clk)
    dash = marts.rpt_marketing_dashboard(imp, clk, cv)
    total = dash.agg(F.sum("spend_euros"), F.sum("impressions")).first()
    known = imp.agg(F.sum("cost_euros"), F.count("*")).first()
    assert total[1] == known[1]
    assert total[0] == pytest.approx(known[0], abs=0.005 * dash.count())


def test_sketches_of_days_merge_to_any_span(spark):
    import datetime as dt

    from clickloom.plans import campaigns

    # One campaign with most customers; a customer converts on several days and for several campaigns.
    df = spark.range(60_000).selectExpr(
        "if(id % 3 = 0, concat('C', id % 7), 'hot') as campaign_id", "date_add(date'2024-01-01', int(id % 40)) as conversion_date",
        "concat('u', hash(id) % 9000) as customer_id")
    kept = campaigns.customer_sketches(df)
    start, end = dt.date(2024, 1, 10), dt.date(2024, 1, 25)
    for by, first, last in ((["campaign_id"], None, None), (["campaign_id"], start, end), ([], start, None), (["conversion_date"], None, None)):
        rows = df.filter(f"conversion_date >= '{first or dt.date.min}' and conversion_date <= '{last or dt.date.max}'")
        exact = {tuple(r)[:-1]: r[-1] for r in rows.groupBy(*by).agg(F.countDistinct("customer_id")).collect()}
        got = {tuple(r)[:-1]: r[-1] for r in campaigns.estimated_customers(kept, by, first, last).collect()}
        assert set(got) == set(exact)
        assert all(abs(got[k] - exact[k]) <= campaigns.sketch_error() * exact[k] for k in exact)
    # Small groups are counted exactly.
    few = campaigns.estimated_customers(campaigns.customer_sketches(df.limit(50)), []).first()[0]
    assert few == df.limit(50).select("customer_id").distinct().count()
