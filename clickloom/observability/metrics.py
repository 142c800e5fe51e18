"""Volume, freshness, schema and null-rate metrics, and the health they add up to."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions import band, count_where, round_half_away, safe_divide
from clickloom.operators import first_by

# The bounds of each status.
ANOMALY_PCT = 50.0
FRESH_INTERVALS, STALE_INTERVALS = 1.5, 3.0
DEFAULT_INTERVAL_MINUTES = 60
NULL_THRESHOLD_PCT = 5.0
WARNINGS = ("stale", "drifted", "warning")
METRIC_KINDS = {"freshness": "freshness", "volume": "volume", "schema": "schema", "nulls": "null_rates"}

_NULL_RATE = T.StructType([T.StructField("null_count", T.LongType()), T.StructField("null_rate_pct", T.DoubleType())])
_DRIFT = T.StructType([
    T.StructField("added", T.ArrayType(T.StringType())),
    T.StructField("removed", T.ArrayType(T.StringType())),
    T.StructField("type_changed", T.ArrayType(T.StringType())),
    T.StructField("has_drift", T.BooleanType()),
])
# One schema holds the records of every kind; each kind fills its own fields.
METRIC = T.StructType([
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("dataset", T.StringType()),
    T.StructField("metric", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("expected_min", T.LongType()),
    T.StructField("expected_max", T.LongType()),
    T.StructField("change_from_previous_pct", T.DoubleType()),
    T.StructField("anomaly_detected", T.BooleanType()),
    T.StructField("latest_data_timestamp", T.TimestampType()),
    T.StructField("staleness_minutes", T.DoubleType()),
    T.StructField("expected_interval_minutes", T.LongType()),
    T.StructField("column_count", T.LongType()),
    T.StructField("schema_columns", T.MapType(T.StringType(), T.StringType())),
    T.StructField("drift", _DRIFT),
    T.StructField("total_rows", T.LongType()),
    T.StructField("threshold_pct", T.DoubleType()),
    T.StructField("null_columns", T.MapType(T.StringType(), _NULL_RATE)),
    T.StructField("flagged_columns", T.ArrayType(T.StringType())),
])


def metric_records(df: DataFrame, kind: str) -> DataFrame:
    """Bring records of one kind to the shared schema."""
    filled = df.withColumn("metric", F.lit(kind))
    return filled.select(*[
        (F.col(f.name) if f.name in filled.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in METRIC.fields
    ])


# ------------------------------------------------------------------------------- volume


def row_counts(tables: Mapping[str, DataFrame], at: Column | None = None) -> DataFrame:
    """Row count of each table, in one action."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("dataset"), "row_count")
        for name, df in tables.items()
    ]
    counts = reduce(DataFrame.unionByName, counted)
    return counts if at is None else counts.withColumn("timestamp", at.cast("timestamp"))


def _history(lag: int) -> tuple:
    """The window of a dataset's earlier records: a log holds one record per run."""
    return Window.partitionBy("dataset").orderBy("timestamp"), lag


def evaluate_volume(history: DataFrame, expected_min: int = 0, expected_max: int | None = None,
                    lag: int = 1) -> DataFrame:
    """Change against the ``lag``-th record before, anomaly flag, and status by bounds.

    ``history`` holds (dataset, timestamp, row_count).  A maximum of zero means no maximum.
    An anomaly does not change the status.
    """
    w, back = _history(lag)
    before = F.lag("row_count", back).over(w)
    change = F.when(before > 0, round_half_away(safe_divide((F.col("row_count") - before) * 100, before), 1))
    within = F.col("row_count") >= expected_min
    if expected_max:
        within = within & (F.col("row_count") <= expected_max)
    return history.select(
        "dataset", "timestamp", "row_count",
        F.lit(expected_min).cast("bigint").alias("expected_min"),
        F.lit(expected_max).cast("bigint").alias("expected_max"),
        change.alias("change_from_previous_pct"),
        F.coalesce(F.abs(change) > ANOMALY_PCT, F.lit(False)).alias("anomaly_detected"),
        F.when(within, "ok").otherwise("warning").alias("status"),
    )


def volume_anomalies(volumes: DataFrame) -> DataFrame:
    """Records flagged as anomalous."""
    return volumes.filter("anomaly_detected")


# ---------------------------------------------------------------------------- freshness


def time_column(df: DataFrame) -> str | None:
    """The first column whose name speaks of a timestamp or date."""
    return next((c for c in df.columns if "timestamp" in c.lower() or "date" in c.lower()), None)


def latest_timestamp(df: DataFrame) -> DataFrame | None:
    """Greatest value of the column that tells the time of a row."""
    name = time_column(df)
    return None if name is None else df.agg(F.max(name).cast("timestamp").alias("latest_data_timestamp"))


def freshness_metric(latest: DataFrame, now: dt.datetime,
                     expected_interval_minutes: int = DEFAULT_INTERVAL_MINUTES) -> DataFrame:
    """Minutes since the latest data of each dataset, and a status against the expected interval.

    ``latest`` holds (dataset, latest_data_timestamp).
    """
    moment = F.lit(now).cast("timestamp")
    micros = F.unix_micros(moment) - F.unix_micros("latest_data_timestamp")
    minutes = micros.cast("double") / 6e7
    status = band(minutes, [(FRESH_INTERVALS * expected_interval_minutes, "fresh"),
                            (STALE_INTERVALS * expected_interval_minutes, "stale")], "critical", ceilings=True)
    return latest.select(
        "dataset", moment.alias("timestamp"), "latest_data_timestamp",
        round_half_away(minutes, 1).alias("staleness_minutes"),
        F.lit(expected_interval_minutes).cast("bigint").alias("expected_interval_minutes"),
        status.alias("status"),
    )


# ------------------------------------------------------------------------------- schema


def schema_observation(df: DataFrame, dataset: str, at: dt.datetime) -> DataFrame:
    """Columns and types of a frame as one record."""
    columns = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    shape = T.StructType([T.StructField("dataset", T.StringType()), T.StructField("timestamp", T.TimestampType()),
                          T.StructField("schema_columns", T.MapType(T.StringType(), T.StringType()))])
    return df.sparkSession.createDataFrame([(dataset, at, columns)], shape)


def batch_schemas(df: DataFrame, dataset: str, batch: str) -> DataFrame:
    """What the batches of a feed hold, one schema record for each value of column ``batch``.

    A column without any value in a batch is absent from its record, and a double that
    holds whole numbers only counts as bigint.
    """
    def entry(f: T.StructField) -> Column:
        kind = F.lit(f.dataType.simpleString())
        if isinstance(f.dataType, T.DoubleType):
            kind = F.when(F.bool_or(F.col(f.name) % 1 != 0), kind).otherwise("bigint")
        return F.when(F.count(f.name) > 0, F.struct(F.lit(f.name).alias("key"), kind.alias("value")))

    entries = F.array(*[entry(f) for f in df.schema.fields if f.name != batch])
    held = df.groupBy(F.col(batch).cast("timestamp").alias("timestamp")).agg(entries.alias("_entries"))
    return held.select(F.lit(dataset).alias("dataset"), "timestamp",
                       F.map_from_entries(F.array_compact("_entries")).alias("schema_columns"))


def evaluate_schema(history: DataFrame, lag: int = 1) -> DataFrame:
    """Columns added, removed and changed against the ``lag``-th record before."""
    w, back = _history(lag)
    now, before = F.col("schema_columns"), F.lag("schema_columns", back).over(w)
    with_before = history.withColumn("_before", before)
    known = F.col("_before").isNotNull()
    none = F.array().cast("array<string>")

    def when_known(names: Column) -> Column:
        return F.when(known, F.array_sort(names)).otherwise(none)

    names, names_before = F.map_keys(now), F.map_keys("_before")
    changed = F.filter(F.array_intersect(names, names_before), lambda c: now[c] != F.col("_before")[c])
    drift = with_before.withColumns({
        "_added": when_known(F.array_except(names, names_before)),
        "_removed": when_known(F.array_except(names_before, names)),
        "_changed": when_known(changed),
    })
    drifted = (F.size("_added") + F.size("_removed") + F.size("_changed")) > 0
    return drift.select(
        "dataset", "timestamp", F.size("schema_columns").cast("bigint").alias("column_count"), "schema_columns",
        F.struct(F.col("_added").alias("added"), F.col("_removed").alias("removed"),
                 F.col("_changed").alias("type_changed"), drifted.alias("has_drift")).alias("drift"),
        F.when(drifted, "drifted").otherwise("ok").alias("status"),
    )


# --------------------------------------------------------------------------- null rates


def null_rates(df: DataFrame, dataset: str, by: Sequence[str] = (),
               threshold_pct: float = NULL_THRESHOLD_PCT) -> DataFrame:
    """Null count and rate of every column (per batch), from one scan."""
    columns = [c for c in df.columns if c not in by]
    counts = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[count_where(F.col(c).isNull()).alias(f"_null_{i}") for i, c in enumerate(columns)])
    listed = F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"_null_{i}").alias("null_count")) for i, c in enumerate(columns)])
    return rates_of(counts.select(*by, "total_rows", listed.alias("null_counts")), dataset, by, threshold_pct)


def rates_of(counts: DataFrame, dataset: str, by: Sequence[str] = (),
             threshold_pct: float = NULL_THRESHOLD_PCT) -> DataFrame:
    """Null rates from counted nulls: (*by, total_rows, null_counts), a list of (column, null_count)."""
    rows = counts.select(*by, "total_rows", F.inline("null_counts"))
    rate = round_half_away(F.coalesce(safe_divide(F.col("null_count") * 100, "total_rows"), F.lit(0.0)), 2)
    return rows.select(F.lit(dataset).alias("dataset"), *by, "column", "total_rows", "null_count",
                       rate.alias("null_rate_pct"), (rate > threshold_pct).alias("flagged"))


def evaluate_nulls(rates: DataFrame, at: Column, by: Sequence[str] = (),
                   threshold_pct: float = NULL_THRESHOLD_PCT) -> DataFrame:
    """One record per dataset (and batch) from its null rates; lists have an entry per column."""
    entry = F.struct("column", F.struct("null_count", "null_rate_pct").alias("rate"))
    flagged = F.array_sort(F.collect_list(F.when(F.col("flagged"), F.col("column"))))
    records = rates.groupBy("dataset", *by).agg(
        F.max("total_rows").alias("total_rows"),
        F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("null_columns"),
        flagged.alias("flagged_columns"))
    return records.select(
        "dataset", at.cast("timestamp").alias("timestamp"), "total_rows",
        F.lit(threshold_pct).alias("threshold_pct"), "null_columns", "flagged_columns",
        F.when(F.size("flagged_columns") > 0, "warning").otherwise("ok").alias("status"),
    )


def completeness(rates: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Share of the cells of a dataset (and batch) that hold a value, in percent, from its null rates.

    NULL for a dataset without rows.  ``worst_column`` is the column with most nulls, the first by name of equal ones.
    """
    worst = F.min(F.struct(-F.col("null_count"), "column")).getField("column")
    cells = rates.groupBy("dataset", *by).agg(
        F.sum("total_rows").alias("cells"), F.sum("null_count").alias("null_cells"), worst.alias("_worst"))
    score = round_half_away(safe_divide((F.col("cells") - F.col("null_cells")) * 100, "cells"), 4)
    return cells.select("dataset", *by, "cells", "null_cells", score.alias("completeness_pct"),
                        F.when(F.col("null_cells") > 0, F.col("_worst")).alias("worst_column"))


# ------------------------------------------------------------------------------- health


def health_summary(metrics: DataFrame) -> DataFrame:
    """Latest status of each kind by dataset, and the worst of them.

    ``metrics`` holds (dataset, metric, timestamp, status).  A kind never recorded is
    unknown and does not count.
    """
    def latest(kind: str) -> Column:
        newest = first_by(["status"], [-F.unix_micros("timestamp"), F.col("status")],
                          where=F.col("metric") == kind)
        return newest.getField("pick").getField("status")

    found = metrics.groupBy("dataset").agg(*[latest(kind).alias(name) for name, kind in METRIC_KINDS.items()])
    statuses = F.array(*METRIC_KINDS)
    overall = (F.when(F.array_contains(F.array_compact(statuses), "critical"), "critical")
               .when(F.arrays_overlap(F.array_compact(statuses), F.array(*map(F.lit, WARNINGS))), "warning")
               .otherwise("healthy"))
    return found.select("dataset", overall.alias("overall"),
                        *[F.coalesce(name, F.lit("unknown")).alias(name) for name in METRIC_KINDS])
