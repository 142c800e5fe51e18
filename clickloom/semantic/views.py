"""The views over the three reporting tables."""

from __future__ import annotations

from clickloom.functions import conversion_rate, cpa, cpc, ctr, roas
from clickloom.semantic.view import Dimension, Measure, RecentWindow, SemanticView

MARKETING_DASHBOARD = SemanticView(
    name="marketing_dashboard",
    table="rpt_marketing_dashboard",
    dimensions={
        "date": Dimension("date", "date"),
        "week": Dimension("date", "week"),
        "month": Dimension("date", "month"),
        "channel": Dimension("channel"),
        "platform": Dimension("platform"),
    },
    measures={
        "total_impressions": Measure.sum("impressions"),
        "total_clicks": Measure.sum("clicks"),
        "total_conversions": Measure.sum("conversions"),
        "total_spend": Measure.money("spend_euros"),
        "total_revenue": Measure.money("revenue_euros"),
        "total_purchases": Measure.sum("purchases"),
        "total_signups": Measure.sum("signups"),
        "total_leads": Measure.sum("leads"),
        "count_days": Measure.count_distinct("date"),
        "total_profit": Measure.of("total_revenue", "total_spend", formula=lambda r, s: r - s),
        "avg_ctr": Measure.of("total_clicks", "total_impressions", formula=lambda c, i: ctr(c, i) * 100),
        "avg_cpc": Measure.of("total_spend", "total_clicks", formula=cpc),
        "avg_cpa": Measure.of("total_spend", "total_conversions", formula=cpa),
        "overall_roas": Measure.of("total_revenue", "total_spend", formula=roas),
        "avg_conversion_rate": Measure.of("total_conversions", "total_clicks",
                                          formula=lambda v, c: conversion_rate(v, c) * 100),
    },
    recent=RecentWindow("date", "day", 90),
    access=("channel", "allowed_channels"),
)

# The table has no date, so the date range a user may choose does not narrow it.
CHANNEL_ROI = SemanticView(
    name="channel_roi",
    table="rpt_channel_roi",
    dimensions={name: Dimension(name) for name in ("channel", "best_campaign_name", "worst_campaign_name")},
    measures={
        "total_impressions": Measure.sum("total_impressions"),
        "total_clicks": Measure.sum("total_clicks"),
        "total_conversions": Measure.sum("total_conversions"),
        "total_spend": Measure.money("total_spend_euros"),
        "total_revenue": Measure.money("total_revenue_euros"),
        "total_profit": Measure.money("profit_euros"),
        "avg_roi": Measure.avg("roi_pct"),
        "avg_cpa": Measure.avg("avg_cpa_eur"),
        "avg_roas": Measure.avg("avg_roas"),
        "avg_ctr": Measure.avg("ctr_pct"),
        "avg_conversion_rate": Measure.avg("conversion_rate_pct"),
        "channel_health_score": Measure.avg("channel_health_score"),
        "best_campaign_roas": Measure.max("best_campaign_roas"),
        "worst_campaign_roas": Measure.min("worst_campaign_roas"),
        "channel_count": Measure.count(),
    },
    window_choices=("30", "90", "180", "all"),
)

CUSTOMER_ACQUISITION = SemanticView(
    name="customer_acquisition",
    table="rpt_customer_acquisition",
    dimensions={
        "channel": Dimension("channel"),
        "acquisition_month": Dimension("acquisition_month", "month"),
        "acquisition_health": Dimension("acquisition_health"),
    },
    measures={
        "total_new_customers": Measure.sum("new_customers"),
        "avg_cac": Measure.weighted_avg("cac_eur", "new_customers"),
        "avg_first_order_value": Measure.avg("avg_first_order_value"),
        "avg_ltv_30d": Measure.avg("avg_ltv_30d"),
        "avg_ltv_90d": Measure.avg("avg_ltv_90d"),
        "avg_payback_period": Measure.avg("payback_period_days"),
        "avg_ltv_cac_ratio": Measure.avg("ltv_90d_to_cac_ratio"),
        "avg_conversions_per_customer": Measure.avg("avg_conversions_per_customer"),
        "channel_count": Measure.count(),
    },
    recent=RecentWindow("acquisition_month", "month", 12),
)

VIEWS = {v.name: v for v in (MARKETING_DASHBOARD, CHANNEL_ROI, CUSTOMER_ACQUISITION)}
