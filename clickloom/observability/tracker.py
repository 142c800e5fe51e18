"""Keeps validation runs and metrics in two append-only logs and reads them back."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.observability import metrics as M
from clickloom.observability import runs as R
from clickloom.quality import Suite, observe_suite, validate
from clickloom.session import write_down
from clickloom.sources.logs import append_metrics, append_runs, drop_old_runs, read_metrics, read_runs

HEALTH_TREND_DAYS = 30
HEALTH_FAILURES = 50


def _utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


class QualityTracker:
    """Runs suites and records what they and the data looked like."""

    def __init__(self, spark: SparkSession, runs_dir: str, metrics_dir: str) -> None:
        self.spark = spark
        self.runs_dir = runs_dir
        self.metrics_dir = metrics_dir

    @property
    def runs(self) -> DataFrame:
        return read_runs(self.spark, self.runs_dir)

    @property
    def metrics(self) -> DataFrame:
        return read_metrics(self.spark, self.metrics_dir)

    def _history(self, dataset: str, kind: str, columns: list[str]) -> DataFrame:
        return self.metrics.filter((F.col("dataset") == dataset) & (F.col("metric") == kind)).select(*columns)

    def track(self, df: DataFrame, suite: Suite, results: DataFrame | None = None,
              now: dt.datetime | None = None, lag: int = 1, sampled: bool = False,
              references: Mapping[str, DataFrame] | None = None) -> DataFrame:
        """Validate a table (unless results are given) and record the run and its metrics.

        Volume is always recorded; freshness when the table has a time column; null rates
        when it has rows; the schema always.  ``lag`` is how many records back a record is
        compared with.  Checks, nulls and freshness come from one scan of the table, whose
        counts are written down before they are read; only reference checks add scans.
        """
        now = now or _utc_now()
        at = F.lit(now).cast("timestamp")
        dataset = suite.dataset
        time = M.time_column(df)
        seen = write_down(observe_suite(df, suite, sampled=sampled, nulls_of=df.columns, latest_of=time))
        if results is None:
            results = validate(df, suite, references=references, sampled=sampled, observed=seen)
        append_runs(R.run_records(results, suite, at), self.runs_dir)

        record = M.evaluate_nulls(M.rates_of(seen.withColumnRenamed("row_count", "total_rows"), dataset), at)
        rows = seen.select(F.lit(dataset).alias("dataset"), at.alias("timestamp"), "row_count")
        new = F.col("timestamp") == at
        volume = self._history(dataset, "volume", ["dataset", "timestamp", "row_count"]).unionByName(rows)
        schema = self._history(dataset, "schema", ["dataset", "timestamp", "schema_columns"]).unionByName(
            M.schema_observation(df, dataset, now))
        records = [
            M.metric_records(M.evaluate_volume(volume, lag=lag).filter(new), "volume"),
            M.metric_records(M.evaluate_schema(schema, lag=lag).filter(new), "schema"),
            M.metric_records(record.filter("total_rows > 0"), "null_rates"),
        ]
        if time is not None:
            known = seen.filter("latest_data_timestamp is not null").withColumn("dataset", F.lit(dataset))
            records.append(M.metric_records(M.freshness_metric(known, now), "freshness"))
        append_metrics(reduce(DataFrame.unionByName, records), self.metrics_dir)
        return self.metrics.filter(new & (F.col("dataset") == dataset))

    def health_bundle(self, now: dt.datetime | None = None) -> dict[str, DataFrame]:
        """Everything an overview of data health shows."""
        runs = self.runs
        return {
            "health_summary": M.health_summary(self.metrics),
            "latest_runs": R.latest_by_suite(runs),
            "pass_rate_trend": R.pass_rate_trend(runs, now or _utc_now(), days=HEALTH_TREND_DAYS),
            "recent_failures": R.failure_details(runs, limit=HEALTH_FAILURES),
        }

    def cleanup(self, keep_days: int = R.KEEP_DAYS, now: dt.datetime | None = None) -> int:
        """Drop runs older than ``keep_days``; returns the number of runs removed."""
        return drop_old_runs(self.spark, self.runs_dir, (now or _utc_now()) - dt.timedelta(days=keep_days))
