"""The funnel ratios.  Each is NULL when its base is zero or unknown."""

from __future__ import annotations

from pyspark.sql import Column

from clickloom.functions.scalar import safe_divide


def ctr(clicks: Column | str, impressions: Column | str) -> Column:
    """Click-through rate, as a fraction."""
    return safe_divide(clicks, impressions)


def cpc(spend: Column | str, clicks: Column | str) -> Column:
    """Cost per click."""
    return safe_divide(spend, clicks)


def cpa(spend: Column | str, conversions: Column | str) -> Column:
    """Cost per acquisition."""
    return safe_divide(spend, conversions)


def roas(revenue: Column | str, spend: Column | str) -> Column:
    """Return on ad spend."""
    return safe_divide(revenue, spend)


def conversion_rate(conversions: Column | str, clicks: Column | str) -> Column:
    """Conversions per click, as a fraction."""
    return safe_divide(conversions, clicks)
