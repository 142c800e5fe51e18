"""Preset queries of the overview, and the reports built on them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.functions import limbs, safe_divide, units_of, units_to_double
from clickloom.semantic.views import MARKETING_DASHBOARD, VIEWS


@dataclass(frozen=True)
class Tile:
    view: str
    dimensions: tuple[str, ...] = ()
    measures: tuple[str, ...] = ()
    sort: tuple[str, ...] = ()


TILES = {
    "kpi_total_spend": Tile("marketing_dashboard", (), ("total_spend",)),
    "kpi_total_revenue": Tile("marketing_dashboard", (), ("total_revenue",)),
    "kpi_overall_roas": Tile("marketing_dashboard", (), ("overall_roas",)),
    "kpi_total_conversions": Tile("marketing_dashboard", (), ("total_conversions",)),
    "kpi_avg_ctr": Tile("marketing_dashboard", (), ("avg_ctr",)),
    "kpi_total_profit": Tile("marketing_dashboard", (), ("total_profit",)),
    "spend_by_channel": Tile("marketing_dashboard", ("channel",), ("total_spend",), ("total_spend desc",)),
    "roas_trend": Tile("marketing_dashboard", ("date",), ("overall_roas",), ("date",)),
    "conversion_funnel": Tile("marketing_dashboard", (),
                              ("total_impressions", "total_clicks", "total_conversions")),
    "channel_roi_table": Tile(
        "channel_roi", ("channel", "best_campaign_name"),
        ("total_spend", "total_revenue", "avg_roi", "avg_roas", "total_conversions", "channel_health_score"),
        ("avg_roi desc",)),
    "cac_by_channel": Tile("customer_acquisition", ("channel",), ("avg_cac",), ("avg_cac desc",)),
    "revenue_vs_spend": Tile("channel_roi", ("channel",), ("total_spend", "total_revenue")),
    "new_customers_by_channel": Tile("customer_acquisition", ("channel",), ("total_new_customers",),
                                     ("total_new_customers desc",)),
    "ltv_cac_by_channel": Tile("customer_acquisition", ("channel",), ("avg_ltv_cac_ratio",),
                               ("avg_ltv_cac_ratio desc",)),
}
KPI_TILES = [name for name in TILES if name.startswith("kpi_")]


def run_tile(name: str, table: DataFrame, **restrictions) -> DataFrame:
    """Run a preset over the table its view reads; restrictions as in ``SemanticView.restrict``."""
    tile = TILES[name]
    return VIEWS[tile.view].query(table, tile.dimensions, tile.measures, tile.sort, **restrictions)


def kpi_totals(table: DataFrame, **restrictions) -> DataFrame:
    """The six headline figures in one row, from one aggregation."""
    measures = [TILES[name].measures[0] for name in KPI_TILES]
    return MARKETING_DASHBOARD.query(table, (), measures, **restrictions)


def with_mean(df: DataFrame, column: str) -> DataFrame:
    """Add the mean of a column over a tile, for a reference line.  Only for tile results,
    which hold a row per channel."""
    tile = Window.partitionBy()
    total = units_to_double(units_of([F.sum(part).over(tile) for part in limbs(column)]))
    return df.withColumn(f"mean_{column}", safe_divide(total, F.count(column).over(tile)))


FUNNEL_STEPS = ("impressions", "clicks", "conversions")


def funnel(table: DataFrame, **restrictions) -> DataFrame:
    """Impressions, clicks and conversions, each with its rate against the step before and the first."""
    totals = run_tile("conversion_funnel", table, **restrictions)
    count = {step: F.col(f"total_{step}") for step in FUNNEL_STEPS}
    steps = []
    for i, step in enumerate(FUNNEL_STEPS):
        before = count[FUNNEL_STEPS[i - 1]] if i else None
        steps.append(F.struct(
            F.lit(i + 1).cast("bigint").alias("step_no"),
            F.lit(step).alias("step"),
            count[step].alias("events"),
            (safe_divide(count[step], before) * 100 if i else F.lit(None).cast("double")).alias("step_rate_pct"),
            (safe_divide(count[step], count[FUNNEL_STEPS[0]]) * 100).alias("overall_rate_pct"),
        ))
    return totals.select(F.inline(F.array(*steps)))


# Columns of the trend table: name -> measure.
TREND = {"spend": "total_spend", "revenue": "total_revenue", "conversions": "total_conversions",
         "impressions": "total_impressions"}


def daily_channel_trend(table: DataFrame, **restrictions) -> DataFrame:
    """Spend, revenue, conversions and impressions by date and channel."""
    days = MARKETING_DASHBOARD.query(table, ("date", "channel"), list(TREND.values()), **restrictions)
    return days.select("date", "channel", *[F.col(m).alias(name) for name, m in TREND.items()])


def week_over_week(table: DataFrame, days: int = 7, **restrictions) -> DataFrame:
    """The daily trend beside the same channel a week earlier, with the change in percent.

    The earlier day is found by a range of days and not of rows, so gaps in the history do not shift it.  A
    window over a channel's days holds one row per day, however much traffic the days had.
    """
    now = daily_channel_trend(table, **restrictions)
    earlier = Window.partitionBy("channel").orderBy(F.unix_date("date")).rangeBetween(-days, -days)
    joined = now.withColumns({f"{name}_before": F.first(name).over(earlier) for name in TREND})
    changes: Mapping = {
        f"{name}_change_pct": safe_divide(F.col(name) - F.col(f"{name}_before"), F.col(f"{name}_before")) * 100
        for name in ("spend", "revenue")
    }
    return joined.withColumns(changes)
