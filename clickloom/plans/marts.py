"""The three reporting tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions import (
    band,
    clamp,
    conversion_rate,
    cpa,
    cpc,
    ctr,
    elapsed,
    exact_sum,
    exact_units,
    roas,
    round_half_away,
    safe_divide,
    units_to_double,
)
from clickloom.operators import first_by, skew_safe_left_join
from clickloom.plans.campaigns import int_campaign_performance, type_counts

DAY_KEYS = ["date", "channel", "platform"]
# The date ranges that the channel report offers.
RANGES = ("30", "90", "180", "all")


def rpt_marketing_dashboard(impressions: DataFrame, clicks: DataFrame, conversions: DataFrame,
                            keep_unmatched: bool = False) -> DataFrame:
    """Daily performance by channel and platform.

    Days are driven by impressions: clicks and conversions of a (date, channel, platform)
    without impressions are left out, unless ``keep_unmatched``.
    """
    shown = impressions.groupBy(F.col("impression_date").alias("date"), "channel", "platform").agg(
        F.count(F.lit(1)).alias("n_imp"), exact_sum("cost_euros").alias("spend"))
    clicked = clicks.groupBy(F.col("click_date").alias("date"), "channel", "platform").agg(
        F.count(F.lit(1)).alias("n_clk"))
    converted = conversions.groupBy(F.col("conversion_date").alias("date"), "channel", "platform").agg(
        F.count(F.lit(1)).alias("n_cv"), exact_sum("revenue_euros").alias("revenue"), *type_counts())

    how = "full" if keep_unmatched else "left"
    joined = shown.join(clicked, DAY_KEYS, how).join(converted, DAY_KEYS, how)
    zero = F.lit(0)
    return joined.select(
        *DAY_KEYS,
        F.coalesce("n_imp", zero).alias("impressions"),
        F.coalesce("n_clk", zero).alias("clicks"),
        F.coalesce("n_cv", zero).alias("conversions"),
        round_half_away(F.coalesce("spend", F.lit(0.0)), 2).alias("spend_euros"),
        round_half_away(F.coalesce("revenue", F.lit(0.0)), 2).alias("revenue_euros"),
        round_half_away(ctr("n_clk", "n_imp") * 100, 2).alias("ctr_pct"),
        round_half_away(cpc("spend", "n_clk"), 2).alias("cpc_eur"),
        round_half_away(cpa("spend", "n_cv"), 2).alias("cpa_eur"),
        round_half_away(roas("revenue", "spend"), 2).alias("roas"),
        round_half_away(conversion_rate("n_cv", "n_clk") * 100, 2).alias("conversion_rate_pct"),
        F.coalesce("purchases", zero).alias("purchases"),
        F.coalesce("signups", zero).alias("signups"),
        F.coalesce("leads", zero).alias("leads"),
        round_half_away(safe_divide("spend", "revenue") * 100, 2).alias("cost_of_revenue_pct"),
    )


def health_score(roas_value: Column, ctr_value: Column, cvr_value: Column, roas_weight: float = 40.0,
                 ctr_weight: float = 30.0, cvr_weight: float = 30.0) -> Column:
    """Channel score in 0..100 from return on spend and the two rates; NULL if any is unknown."""
    raw = roas_value * roas_weight + ctr_value * 100 * ctr_weight + cvr_value * 100 * cvr_weight
    return clamp(round_half_away(raw, 0), 0.0, 100.0)


def _campaign_pick(best: bool) -> Column:
    """Best or worst campaign with spend, by return on spend; unknown returns rank last."""
    value = F.col("roas")
    return first_by(
        ["campaign_name", value.alias("roas")],
        [value.isNull(), -value if best else value, F.col("campaign_id")],
        where=F.col("total_cost_euros") > 0,
    )


def best_worst_campaign(performance: DataFrame) -> DataFrame:
    """Best and worst campaign of each channel by return on spend."""
    picked = performance.groupBy("channel").agg(
        _campaign_pick(best=True).alias("best"), _campaign_pick(best=False).alias("worst"))
    return picked.select(
        "channel",
        F.col("best.pick.campaign_name").alias("best_campaign_name"),
        round_half_away("best.pick.roas", 2).alias("best_campaign_roas"),
        F.col("worst.pick.campaign_name").alias("worst_campaign_name"),
        round_half_away("worst.pick.roas", 2).alias("worst_campaign_roas"),
    )


def channel_roi_in_range(campaigns: DataFrame, impressions: DataFrame, clicks: DataFrame, conversions: DataFrame,
                         days: int | str = 90, as_of: dt.date | None = None) -> DataFrame:
    """Channel return over the events of the last ``days`` days, ``as_of`` (default: today) included, or of ``"all"``.

    Each feed is narrowed by its own date before it shrinks to campaigns, so only that range is read where
    the feeds are stored by day.  Choices are those of the report's date range.
    """
    if str(days) not in RANGES:
        raise ValueError(f"days must be one of {RANGES}")
    feeds = {"impression_date": impressions, "click_date": clicks, "conversion_date": conversions}
    if str(days) != "all":
        last = F.current_date() if as_of is None else F.lit(as_of)
        feeds = {day: feed.filter(F.col(day).between(F.date_sub(last, int(days) - 1), last)) for day, feed in feeds.items()}
    return rpt_channel_roi(int_campaign_performance(campaigns, *feeds.values()))


def rpt_channel_roi(performance: DataFrame) -> DataFrame:
    """Return on investment by channel, with its best and worst campaign and a health score.

    One aggregation: the campaign picks are aggregates beside the sums, so there is no
    ranking and no join back.
    """
    by_channel = performance.groupBy("channel").agg(
        F.sum("total_impressions").alias("total_impressions"),
        F.sum("total_clicks").alias("total_clicks"),
        F.sum("total_conversions").alias("total_conversions"),
        exact_sum("total_cost_euros").alias("spend"),
        exact_sum("total_revenue_euros").alias("revenue"),
        _campaign_pick(best=True).alias("best"),
        _campaign_pick(best=False).alias("worst"),
    )
    profit = F.col("revenue") - F.col("spend")
    rate_ctr = ctr("total_clicks", "total_impressions")
    rate_cvr = conversion_rate("total_conversions", "total_clicks")
    rate_roas = roas("revenue", "spend")
    return by_channel.select(
        "channel", "total_impressions", "total_clicks", "total_conversions",
        round_half_away("spend", 2).alias("total_spend_euros"),
        round_half_away("revenue", 2).alias("total_revenue_euros"),
        round_half_away(profit, 2).alias("profit_euros"),
        round_half_away(safe_divide(profit, "spend") * 100, 2).alias("roi_pct"),
        round_half_away(cpa("spend", "total_conversions"), 2).alias("avg_cpa_eur"),
        round_half_away(rate_roas, 2).alias("avg_roas"),
        round_half_away(rate_ctr * 100, 2).alias("ctr_pct"),
        round_half_away(rate_cvr * 100, 2).alias("conversion_rate_pct"),
        F.col("best.pick.campaign_name").alias("best_campaign_name"),
        round_half_away("best.pick.roas", 2).alias("best_campaign_roas"),
        F.col("worst.pick.campaign_name").alias("worst_campaign_name"),
        round_half_away("worst.pick.roas", 2).alias("worst_campaign_roas"),
        health_score(rate_roas, rate_ctr, rate_cvr).alias("channel_health_score"),
    )


def with_first_conversion(conversions: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Conversions with the time of their customer's first one.

    ``hot`` are the hot customers (``hot_keys``), best found in the raw feed, if conversions are no stored table.

    The minimum is aggregated and joined back with hot customers spread out, rather than
    taken in a window that would hold all conversions of a customer in one task.
    """
    first = conversions.groupBy("customer_id").agg(
        F.min("conversion_timestamp").alias("first_conversion_timestamp"))
    return skew_safe_left_join(conversions, first, ["customer_id"], ["conversion_id"], hot=hot)


def first_conversions(conversions: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """The acquisition event of each customer; conversions tied on the first instant all stay."""
    tagged = with_first_conversion(conversions, hot)
    return tagged.filter(F.col("conversion_timestamp") == F.col("first_conversion_timestamp")).select(
        "customer_id",
        F.col("channel").alias("acquisition_channel"),
        F.col("platform").alias("acquisition_platform"),
        F.col("campaign_id").alias("acquisition_campaign_id"),
        F.col("conversion_timestamp").alias("acquisition_timestamp"),
        F.date_trunc("month", "conversion_timestamp").alias("acquisition_month"),
    )


def _ltv_units(days: dict[str, int | None]) -> list[Column]:
    """Revenue within each number of days of the first conversion, in exact units."""
    since = elapsed("DAY", "first_conversion_timestamp", "conversion_timestamp")
    return [exact_units("revenue_euros", None if limit is None else since <= limit).alias(name)
            for name, limit in days.items()]


LTV_WINDOWS = {"ltv_30d": 30, "ltv_90d": 90, "ltv_total": None}


def customer_ltv(conversions: DataFrame, windows: dict[str, int | None] | None = None,
                 hot: DataFrame | None = None) -> DataFrame:
    """Revenue per customer within days of the first conversion, in total, and conversion count."""
    windows = windows or LTV_WINDOWS
    totals = with_first_conversion(conversions, hot).groupBy("customer_id").agg(
        *_ltv_units(windows), F.count(F.lit(1)).alias("total_conversions"))
    return totals.select("customer_id", *[units_to_double(w).alias(w) for w in windows], "total_conversions")


def rpt_customer_acquisition(conversions: DataFrame, performance: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """New customers, acquisition cost and lifetime value by acquisition channel and month.

    Conversions shrink to one row per (customer, channel) in a single aggregation; the
    customer's totals are then spread over those few rows, and the acquisition rows are
    the ones with a conversion at the first instant.  A customer whose first instant holds
    several conversions weighs in once per conversion, but is counted once.
    """
    tagged = with_first_conversion(conversions, hot)
    at_first = F.col("conversion_timestamp") == F.col("first_conversion_timestamp")
    per_channel = tagged.groupBy("customer_id", "channel").agg(
        F.min("first_conversion_timestamp").alias("first_ts"),
        F.sum(F.when(at_first, 1).otherwise(0)).alias("acquired"),
        *_ltv_units({"ltv_30d": 30, "ltv_90d": 90}),
        F.count(F.lit(1)).alias("n"),
    )
    # One row per customer holding an array with an entry per channel: channels are few, so
    # the array is small whatever the number of conversions.
    per_customer = per_channel.groupBy("customer_id").agg(
        F.sum("ltv_30d").alias("ltv_30d"), F.sum("ltv_90d").alias("ltv_90d"), F.sum("n").alias("n"),
        F.min("first_ts").alias("first_ts"),
        F.collect_list(F.when(F.col("acquired") > 0, F.struct("channel", "acquired"))).alias("via"),
    )
    acquired = per_customer.select(
        F.date_trunc("month", "first_ts").alias("acquisition_month"),
        F.inline("via"), "ltv_30d", "ltv_90d", "n",
    )
    cohorts = acquired.groupBy("channel", "acquisition_month").agg(
        F.count(F.lit(1)).alias("new_customers"),
        F.sum("acquired").alias("events"),
        F.sum(F.col("ltv_30d") * F.col("acquired")).alias("sum_30"),
        F.sum(F.col("ltv_90d") * F.col("acquired")).alias("sum_90"),
        F.sum(F.col("n") * F.col("acquired")).alias("sum_n"),
    )
    spend = performance.groupBy("channel").agg(exact_sum("total_cost_euros").alias("spend"))

    cac = safe_divide("spend", "new_customers")
    avg_30 = units_to_double("sum_30") / F.col("events")
    avg_90 = units_to_double("sum_90") / F.col("events")
    ratio = safe_divide(avg_90, cac)
    return cohorts.join(spend, "channel", "left").select(
        "channel", "acquisition_month", "new_customers",
        round_half_away(cac, 2).alias("cac_eur"),
        round_half_away(avg_30, 2).alias("avg_first_order_value"),
        round_half_away(avg_30, 2).alias("avg_ltv_30d"),
        round_half_away(avg_90, 2).alias("avg_ltv_90d"),
        round_half_away(safe_divide(cac, safe_divide(avg_90, F.lit(90))), 0).alias("payback_period_days"),
        round_half_away(ratio, 2).alias("ltv_90d_to_cac_ratio"),
        band(ratio, [(3.0, "healthy"), (1.0, "marginal")], "unhealthy").alias("acquisition_health"),
        round_half_away(safe_divide("sum_n", "events"), 1).alias("avg_conversions_per_customer"),
    )
