"""Validation runs over time: one record per suite, batch and moment."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions import band, count_where, round_half_away, safe_divide
from clickloom.quality import Suite

EXPECTATION = T.StructType([
    T.StructField("expectation_type", T.StringType()),
    T.StructField("success", T.BooleanType()),
    T.StructField("kwargs", T.MapType(T.StringType(), T.StringType())),
    T.StructField("result", T.MapType(T.StringType(), T.StringType())),
])
RUN = T.StructType([
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("suite_name", T.StringType()),
    T.StructField("dataset", T.StringType()),
    T.StructField("success", T.BooleanType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("total_expectations", T.LongType()),
    T.StructField("passed", T.LongType()),
    T.StructField("failed", T.LongType()),
    T.StructField("expectations", T.ArrayType(EXPECTATION)),
    T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
])
DEFAULT_RUNS = 100
DEFAULT_FAILURES = 20
KEEP_DAYS = 90
TARGET_PCT = 95.0


def run_records(results: DataFrame, suite: Suite, at: Column, by: Sequence[str] = (),
                metadata: Column | None = None) -> DataFrame:
    """Turn results of ``validate`` into run records, one per batch.

    The gathered list has one entry per check of the suite, whatever the size of the data.
    ``at`` may use the batch columns.
    """
    kwargs = F.create_map(*[
        x for i, e in enumerate(suite.expectations, 1)
        for x in (F.lit(i).cast("bigint"),
                  F.create_map(*[F.lit(y) for kv in e.kwargs.items() for y in kv]) if e.kwargs
                  else F.expr("cast(map() as map<string,string>)"))
    ])
    outcome = ["element_count", "missing_count", "unexpected_count", "unexpected_percent"]
    result = F.map_filter(
        F.create_map(*[x for c in outcome for x in (F.lit(c), F.col(c).cast("string"))]),
        lambda _, v: v.isNotNull())
    entry = F.struct("check_no", "expectation_type", "success",
                     F.element_at(kwargs, F.col("check_no")).alias("kwargs"), result.alias("result"))
    grouped = results.groupBy(*by, "suite_name", "dataset").agg(
        F.min("success").alias("success"),
        F.max("element_count").alias("row_count"),
        F.count(F.lit(1)).alias("total_expectations"),
        count_where(F.col("success")).alias("passed"),
        count_where(~F.col("success")).alias("failed"),
        F.collect_list(entry).alias("entries"),
    )
    # Maps cannot be ordered, so put the checks in order by their number alone.
    in_order = F.array_sort("entries", lambda a, b: (a["check_no"] - b["check_no"]).cast("int"))
    listed = F.transform(in_order, lambda e: F.struct(*[e[n].alias(n) for n in EXPECTATION.names]))
    return grouped.select(
        at.cast("timestamp").alias("timestamp"), "suite_name", "dataset", "success", "row_count",
        "total_expectations", "passed", "failed", listed.alias("expectations"),
        (F.expr("cast(map() as map<string,string>)") if metadata is None else metadata).alias("metadata"),
    )


def _newest_first(runs: DataFrame) -> list[Column]:
    return [F.col("timestamp").desc(), F.col("suite_name").asc(), F.col("dataset").asc()]


def get_runs(runs: DataFrame, suite_name: str | None = None, since: dt.datetime | None = None,
             limit: int | None = DEFAULT_RUNS) -> DataFrame:
    """Newest runs, optionally of one suite and from a moment on."""
    if suite_name is not None:
        runs = runs.filter(F.col("suite_name") == suite_name)
    if since is not None:
        runs = runs.filter(F.col("timestamp") >= F.lit(since))
    if limit is None:
        return runs
    return runs.orderBy(*_newest_first(runs)).limit(limit)


def pass_rate_trend(runs: DataFrame, now: dt.datetime, suite_name: str | None = None,
                    days: int = 30) -> DataFrame:
    """Share of successful runs by day over the last ``days`` days."""
    recent = get_runs(runs, suite_name, now - dt.timedelta(days=days), limit=None)
    passed, total = count_where(F.col("success")), F.count(F.lit(1))
    return recent.groupBy(F.to_date("timestamp").alias("date")).agg(
        round_half_away(safe_divide(passed * 100, total), 1).alias("pass_rate"),
        total.alias("total_runs"), passed.alias("passed"), (total - passed).alias("failed"),
    )


def pass_rate_target(trend: DataFrame, target: float = TARGET_PCT) -> DataFrame:
    """The trend with whether each day met the target."""
    return trend.withColumn("target_status", band("pass_rate", [(target, "met")], "missed"))


def latest_by_suite(runs: DataFrame) -> DataFrame:
    """Newest run of each suite, from a partially aggregated maximum rather than a ranking."""
    plain = [c for c in RUN.names if c not in ("expectations", "metadata", "suite_name", "timestamp")]
    newest = F.max_by(F.struct(*plain, "expectations", "metadata"), F.struct("timestamp", *plain))
    return runs.groupBy("suite_name").agg(F.max("timestamp").alias("timestamp"), newest.alias("run")).select(
        *[F.col(c) if c in ("suite_name", "timestamp") else F.col(f"run.{c}") for c in RUN.names])


def failure_details(runs: DataFrame, suite_name: str | None = None, limit: int = DEFAULT_FAILURES) -> DataFrame:
    """Failed checks of the newest runs: at most ``limit`` runs are read and ``limit`` checks listed."""
    newest = get_runs(runs, suite_name, limit=limit)
    listed = newest.select("timestamp", "suite_name", "dataset", F.posexplode("expectations").alias("pos", "e"))
    failed = listed.filter(~F.col("e.success")).orderBy(*_newest_first(listed), "pos").limit(limit)
    return failed.select(
        "timestamp", F.col("suite_name").alias("suite"), "dataset",
        F.col("e.expectation_type").alias("expectation"),
        F.coalesce(F.col("e.kwargs")["column"], F.lit("")).alias("column"),
        F.col("e.result").alias("details"),
    )
