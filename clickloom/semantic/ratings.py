"""Good / warn / bad bands for the headline measures."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions import band


@dataclass(frozen=True)
class Rating:
    good: float
    warn: float | None = None
    low_is_good: bool = False
    strict: bool = False  # the bound itself does not qualify


# The bounds of each band.
RATINGS = {
    "roas": Rating(3.0, 1.0),
    "roi": Rating(100.0, 0.0),
    "health": Rating(70.0, 40.0),
    "payback": Rating(30.0, 90.0, low_is_good=True),
    "ltv_cac": Rating(3.0, 1.0),
    "profit": Rating(0.0, strict=True),
}
ACQUISITION_HEALTH = {"healthy": "good", "marginal": "warn"}


def rate(value: Column | str, rating: str) -> Column:
    """Band of a value; NULL stays NULL."""
    value = F.col(value) if isinstance(value, str) else value
    if rating == "acquisition_health":
        label = F.lit("bad")
        for name, grade in ACQUISITION_HEALTH.items():
            label = F.when(value == name, grade).otherwise(label)
    else:
        r = RATINGS[rating]
        bounds = [(r.good, "good")] + ([] if r.warn is None else [(r.warn, "warn")])
        label = band(value, bounds, "bad", ceilings=r.low_is_good, strict=r.strict)
    return F.when(value.isNotNull(), label)


def with_ratings(df: DataFrame, ratings: Mapping[str, str]) -> DataFrame:
    """Add ``<column>_rating`` for each column named, using the rating it maps to."""
    return df.withColumns({f"{column}_rating": rate(column, name) for column, name in ratings.items()})
