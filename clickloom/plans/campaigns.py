"""Campaign performance: funnel totals and ratios for each campaign."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions import conversion_rate, count_where, cpa, cpc, ctr, exact_sum, roas

TYPE_COUNTS = {"purchases": "purchase", "signups": "signup", "leads": "lead"}


def type_counts(prefix: str = "") -> list:
    """Conditional counts by conversion type."""
    return [count_where(F.col("conversion_type") == kind).alias(prefix + name)
            for name, kind in TYPE_COUNTS.items()]


def int_campaign_performance(campaigns: DataFrame, impressions: DataFrame, clicks: DataFrame,
                             conversions: DataFrame, grain: str = "impression_channel") -> DataFrame:
    """Totals and ratios by campaign.

    With the default grain a campaign has one row per (channel, platform) its impressions
    were served on: impressions and spend are split among those rows, while clicks,
    conversions and revenue repeat on each.  ``grain='campaign'`` gives one row per campaign.
    Channel and platform are the campaign's own.  Spend is impression spend.
    """
    if grain == "impression_channel":
        served = ["campaign_id", "channel", "platform"]
    elif grain == "campaign":
        served = ["campaign_id"]
    else:
        raise ValueError(f"unknown grain {grain!r}")

    # Each feed shrinks to a row per campaign before any join; the distinct customer count
    # is planned as a two-level aggregation, so a dominant campaign is no hot spot.
    shown = (
        impressions.groupBy(*served)
        .agg(F.count(F.lit(1)).alias("n_imp"), exact_sum("cost_euros").alias("spend"))
        .select("campaign_id", "n_imp", "spend")
    )
    clicked = clicks.groupBy("campaign_id").agg(F.count(F.lit(1)).alias("n_clk"))
    converted = conversions.groupBy("campaign_id").agg(
        F.count(F.lit(1)).alias("n_cv"), exact_sum("revenue_euros").alias("revenue"),
        *type_counts("n_"), F.countDistinct("customer_id").alias("n_cust"),
    )
    joined = (campaigns.join(shown, "campaign_id", "left")
              .join(clicked, "campaign_id", "left")
              .join(converted, "campaign_id", "left"))

    def total(source: str, name: str, zero=0):
        return F.coalesce(source, F.lit(zero)).alias(name)

    return joined.select(
        "campaign_id", "campaign_name", "channel", "platform", "objective", "budget_euros", "budget_tier",
        "channel_group", "campaign_duration_days", "start_date", "end_date",
        total("n_imp", "total_impressions"),
        total("n_clk", "total_clicks"),
        total("n_cv", "total_conversions"),
        total("spend", "total_cost_euros", 0.0),
        total("revenue", "total_revenue_euros", 0.0),
        total("n_purchases", "total_purchases"),
        total("n_signups", "total_signups"),
        total("n_leads", "total_leads"),
        total("n_cust", "unique_customers"),
        ctr("n_clk", "n_imp").alias("ctr"),
        cpc("spend", "n_clk").alias("cpc_euros"),
        cpa("spend", "n_cv").alias("cpa_euros"),
        roas("revenue", "spend").alias("roas"),
        conversion_rate("n_cv", "n_clk").alias("conversion_rate"),
    )


def click_engagement(clicks: DataFrame) -> DataFrame:
    """Clicks, click spend and mean seconds from impression to click, by campaign."""
    timed = F.col("seconds_to_click")
    return clicks.groupBy("campaign_id").agg(
        F.count(F.lit(1)).alias("total_clicks"),
        exact_sum("cost_euros").alias("click_spend_euros"),
        (F.sum(timed).cast("double") / F.nullif(F.count(timed), F.lit(0))).alias("avg_seconds_to_click"),
    )


# Sketches of 2**LG_K registers; their estimates have a standard error of 1.04 / sqrt(2**LG_K).
LG_K = 14


def customer_sketches(conversions: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """A sketch of the customers of each campaign and day, to be kept as a table and merged for any span.

    Days are summed up once; a distinct count over months or over campaigns then reads sketches and no conversions.
    A sketch has at most some 2**lg_k bytes, and fewer for few customers.
    """
    return conversions.groupBy("campaign_id", "conversion_date").agg(
        F.hll_sketch_agg("customer_id", F.lit(lg_k)).alias("customers"))


def estimated_customers(sketches: DataFrame, by: Sequence[str] = ("campaign_id",), start: dt.date | None = None,
                        end: dt.date | None = None) -> DataFrame:
    """Distinct customers by ``by`` (none: in all) from ``start`` up to and including ``end``, from merged sketches.

    The exact count of ``int_campaign_performance`` stays the default; this one is within ``sketch_error``.
    """
    if start is not None:
        sketches = sketches.filter(F.col("conversion_date") >= F.lit(start))
    if end is not None:
        sketches = sketches.filter(F.col("conversion_date") <= F.lit(end))
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("customers")).alias("estimated_customers"))


def sketch_error(lg_k: int = LG_K, sigmas: float = 3.0) -> float:
    """The relative error that an estimate stays within, at three standard errors in 997 of 1,000 cases."""
    return sigmas * 1.04 / 2 ** (lg_k / 2)
