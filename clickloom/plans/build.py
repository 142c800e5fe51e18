"""Building the warehouse: setup, load, staging, intermediate and marts, in that order.

Every table is written once and later steps read what was written, so no lineage is
computed twice and a lost executor costs at most the tasks of the step it ran.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from clickloom.plans import attribution, campaigns, marts, staging
from clickloom.schemas import DERIVED_TABLES, RAW_TABLES
from clickloom.session import configure
from clickloom.sources.csv import read_raw_csv
from clickloom.sources.tables import Warehouse

# Each derived table with the step that builds it, the tables it reads, and its plan.
STEPS: dict[str, tuple[tuple[str, tuple[str, ...], Callable[..., DataFrame]], ...]] = {
    "staging": (
        ("stg_ad_impressions", ("raw_ad_impressions",), staging.stg_ad_impressions),
        ("stg_campaigns", ("raw_campaigns",), staging.stg_campaigns),
        ("stg_clicks", ("raw_clicks", "stg_ad_impressions"),
         lambda raw, imp: staging.stg_clicks(raw, imp, impressions_unique=True)),
        ("stg_conversions", ("raw_conversions", "stg_clicks"), staging.stg_conversions),
    ),
    "intermediate": (
        ("int_campaign_performance", ("stg_campaigns", "stg_ad_impressions", "stg_clicks", "stg_conversions"),
         campaigns.int_campaign_performance),
        ("int_attribution", ("stg_conversions", "stg_clicks"), attribution.int_attribution),
    ),
    "marts": (
        ("rpt_marketing_dashboard", ("stg_ad_impressions", "stg_clicks", "stg_conversions"),
         marts.rpt_marketing_dashboard),
        ("rpt_channel_roi", ("int_campaign_performance",), marts.rpt_channel_roi),
        ("rpt_customer_acquisition", ("stg_conversions", "int_campaign_performance"),
         marts.rpt_customer_acquisition),
    ),
}
ALL_STEPS = ("setup", "load", *STEPS)


@dataclass
class Build:
    """Runs steps against a warehouse and keeps the seconds each table took."""

    warehouse: Warehouse
    seconds: dict[str, float] = field(default_factory=dict)

    def __post_init__(self) -> None:
        configure(self.warehouse.spark)

    def table(self, name: str) -> DataFrame:
        return self.warehouse.read({**RAW_TABLES, **DERIVED_TABLES}[name])

    def setup(self) -> None:
        self.warehouse.create_layers()
        self.warehouse.create_raw_tables()

    def load(self, sources: dict[str, DataFrame | str],
             max_bad_records: int = 0) -> None:
        """Replace raw tables from frames or CSV paths; a feed with more bad records than the bound fails."""
        for name, source in sources.items():
            df = source if isinstance(source, DataFrame) else read_raw_csv(
                self.warehouse.spark, source, name, max_bad_records)
            self.warehouse.replace(df, RAW_TABLES[name])

    def run_step(self, step: str) -> None:
        """Build the tables of one step; the first failure stops it."""
        for name, inputs, plan in STEPS[step]:
            start = time.time()
            self.warehouse.replace(plan(*[self.table(i) for i in inputs]), DERIVED_TABLES[name])
            self.seconds[name] = time.time() - start

    def run(self, sources: dict[str, DataFrame | str]) -> DataFrame:
        """All steps from the given feeds; returns the row counts of the derived tables."""
        self.setup()
        self.load(sources)
        for step in STEPS:
            self.run_step(step)
        return self.counts()

    def counts(self, raw: bool = False) -> DataFrame:
        """Rows of the tables as written: the derived ones, and the raw ones if asked."""
        return self.warehouse.table_counts([*(RAW_TABLES.values() if raw else ()), *DERIVED_TABLES.values()])
