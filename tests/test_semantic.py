import datetime as dt

import pytest

from clickloom.semantic import CHANNEL_ROI, CUSTOMER_ACQUISITION, MARKETING_DASHBOARD, TILES, run_tile, tiles, with_ratings
from tests.rows import rows_of

D = dt.date


@pytest.fixture(scope="module")
def dash(spark):
    rows = [
        (D(2024, 3, 31), "SEO", "organic", 100, 10, 2, 5.0, 20.0, 1, 1, 0),
        (D(2024, 4, 1), "SEO", "organic", 100, 0, 0, 5.0, 0.0, 0, 0, 0),
        (D(2024, 4, 7), "EMAIL", "email", 50, 5, 1, 0.0, 3.0, 0, 0, 1),
        (D(2024, 1, 2), "EMAIL", "email", 50, 5, 1, 1.0, 3.0, 0, 0, 1),
    ]
    return spark.createDataFrame(
        rows, "date date, channel string, platform string, impressions bigint, clicks bigint, conversions bigint, "
              "spend_euros double, revenue_euros double, purchases bigint, signups bigint, leads bigint")


def test_default_window_is_the_last_90_days_including_today(dash):
    q = MARKETING_DASHBOARD.query(dash, [], ["count_days"], trusted=True, as_of=D(2024, 4, 1))
    assert q.first().count_days == 3 - 1 + 0  # the later day is out, 2024-01-02 is day 91 counting from today
    q = MARKETING_DASHBOARD.query(dash, [], ["count_days"], trusted=True, as_of=D(2024, 3, 31))
    assert q.first().count_days == 2  # 2024-01-02 is the 90th day
    assert MARKETING_DASHBOARD.query(dash, [], ["count_days"], trusted=True, as_of=D(2024, 4, 7), window=7).first().count_days == 2
    assert MARKETING_DASHBOARD.query(dash, [], ["count_days"], trusted=True, window="all").first().count_days == 4


def test_formulas_bring_their_own_sums(dash):
    q = MARKETING_DASHBOARD.query(dash, ["channel"], ["avg_ctr", "overall_roas", "total_profit"], trusted=True, window="all")
    assert q.columns == ["channel", "avg_ctr", "overall_roas", "total_profit"]
    assert rows_of(q, "*") == [("EMAIL", 10.0, 6.0, 5.0), ("SEO", 5.0, 2.0, 10.0)]


def test_zero_base_is_null(dash):
    q = MARKETING_DASHBOARD.query(dash, ["date"], ["avg_cpc", "avg_conversion_rate"], trusted=True, window="all",
                                  filters={"channel": ["SEO"]})
    assert rows_of(q, "*") == [(D(2024, 3, 31), 0.5, 20.0), (D(2024, 4, 1), None, None)]


def test_time_buckets(dash):
    q = MARKETING_DASHBOARD.query(dash, ["week", "month"], ["total_impressions"], trusted=True, window="all")
    assert rows_of(q, "*") == [
        (D(2024, 1, 1), D(2024, 1, 1), 50), (D(2024, 3, 25), D(2024, 3, 1), 100), (D(2024, 4, 1), D(2024, 4, 1), 150)]


def test_dimensions_without_measures_are_distinct(dash):
    assert rows_of(MARKETING_DASHBOARD.query(dash, ["channel"], trusted=True, window="all"), "*") == [("EMAIL",), ("SEO",)]


def test_access_filter(dash):
    q = MARKETING_DASHBOARD.query(dash, ["channel"], ["total_clicks"], window="all",
                                  user={"allowed_channels": ["SEO"]})
    assert rows_of(q, "*") == [("SEO", 10)]
    with pytest.raises(PermissionError):
        MARKETING_DASHBOARD.query(dash, ["channel"], [], user={})
    with pytest.raises(PermissionError):
        MARKETING_DASHBOARD.query(dash, ["channel"], [])
    assert MARKETING_DASHBOARD.query(dash, ["channel"], ["total_clicks"], window="all",
                                     user={"allowed_channels": []}).count() == 0


def test_filters(dash):
    assert MARKETING_DASHBOARD.query(dash, ["channel"], [], trusted=True, window="all", filters={"channel": []}).count() == 2
    q = MARKETING_DASHBOARD.query(dash, ["channel"], [], trusted=True, window="all", filters={"date": dash.date > D(2024, 4, 1)})
    assert rows_of(q, "*") == [("EMAIL",)]


def test_sort_and_limit(dash):
    q = MARKETING_DASHBOARD.query(dash, ["channel"], ["total_spend"], sort=["total_spend desc"], limit=1, trusted=True, window="all")
    assert [tuple(r) for r in q.collect()] == [("SEO", 10.0)]


def test_window_choices(spark):
    roi = spark.createDataFrame([("SEO", 1.0)], "channel string, total_spend_euros double")
    assert CHANNEL_ROI.query(roi, [], ["total_spend"], window="30").first().total_spend == 1.0
    with pytest.raises(ValueError):
        CHANNEL_ROI.query(roi, [], ["total_spend"], window="45")


def test_weighted_cost_and_months(spark):
    acq = spark.createDataFrame(
        [("SEO", D(2024, 4, 1), 3, 10.0), ("SEO", D(2023, 5, 1), 1, 2.0), ("SEO", D(2023, 4, 1), 9, 99.0),
         ("SEO", D(2024, 4, 1), 4, None)],
        "channel string, acquisition_month date, new_customers bigint, cac_eur double")
    q = CUSTOMER_ACQUISITION.query(acq, ["channel"], ["avg_cac", "total_new_customers", "channel_count"],
                                   as_of=D(2024, 4, 20))
    assert rows_of(q, "*") == [("SEO", 4.0, 8, 3)]


def test_funnel(dash):
    got = [tuple(r) for r in tiles.funnel(dash, trusted=True, window="all").orderBy("step_no").collect()]
    assert got == [(1, "impressions", 300, None, 100.0), (2, "clicks", 20, 20 / 300 * 100, 20 / 300 * 100),
                   (3, "conversions", 4, 20.0, 4 / 300 * 100)]


def test_week_over_week_ignores_gaps(dash):
    q = tiles.week_over_week(dash, trusted=True, window="all")
    assert rows_of(q.filter("channel = 'SEO'"), "date", "spend_before") == [
        (D(2024, 3, 31), None), (D(2024, 4, 1), None)]
    shifted = tiles.week_over_week(dash, days=1, trusted=True, window="all").filter("date = '2024-04-01'").first()
    assert (shifted.spend_before, shifted.revenue_change_pct) == (5.0, -100.0)


def test_every_tile_runs(dash):
    for name, tile in TILES.items():
        if tile.view == "marketing_dashboard":
            assert run_tile(name, dash, trusted=True, window="all").columns == [*tile.dimensions, *tile.measures]
    assert tiles.kpi_totals(dash, trusted=True, window="all").count() == 1


def test_ratings(spark):
    df = spark.createDataFrame([(1, 3.0, 0.0, 31.0, "marginal"), (2, None, 1.0, 91.0, "other")],
                               "i int, roas double, profit double, payback double, health string")
    got = with_ratings(df, {"roas": "roas", "profit": "profit", "payback": "payback", "health": "acquisition_health"})
    assert rows_of(got, "i", "roas_rating", "profit_rating", "payback_rating", "health_rating") == [
        (1, "good", "bad", "warn", "warn"), (2, None, "good", "bad", "bad")]


def test_mean_line(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "channel string, total_spend double")
    assert {r.mean_total_spend for r in tiles.with_mean(df, "total_spend").collect()} == {1.5}
