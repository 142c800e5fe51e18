"""Append-only JSON logs of validation runs and metrics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.session import write_down

_DAY = "run_date"


def _path(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def _read(spark: SparkSession, path: str, schema: T.StructType, partitions: list[T.StructField]) -> DataFrame:
    """Records of a log, malformed lines left out; an absent log is empty."""
    fs, root = _path(spark, path)
    if not fs.exists(root):
        return spark.createDataFrame([], schema)
    whole = T.StructType([f for f in schema.fields if f.name not in {p.name for p in partitions}] + partitions)
    # A line that is not JSON, or that lacks its timestamp, is no record.
    read = spark.read.schema(whole).option("mode", "DROPMALFORMED").json(path)
    return read.filter(F.col("timestamp").isNotNull()).select(*schema.names)


def append_metrics(records: DataFrame, path: str) -> None:
    """Add metric records to the log, laid out by kind and dataset."""
    # One file per kind and dataset, unless one of them is large.
    records.hint("rebalance", "metric", "dataset").write.mode("append").partitionBy("metric", "dataset").json(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    from clickloom.observability.metrics import METRIC

    return _read(spark, path, METRIC, [T.StructField("metric", T.StringType()), T.StructField("dataset", T.StringType())])


def append_runs(records: DataFrame, path: str) -> None:
    """Add run records to the log, laid out by day."""
    records.withColumn(_DAY, F.to_date("timestamp")).hint("rebalance", _DAY).write.mode("append").partitionBy(_DAY).json(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    from clickloom.observability.runs import RUN

    return _read(spark, path, RUN, [T.StructField(_DAY, T.DateType())])


def drop_old_runs(spark: SparkSession, path: str, before: dt.datetime) -> int:
    """Remove the runs before a moment; returns how many.

    Days that lie wholly before it lose their folder.  What stays of the day it falls on is
    written anew before the old files go, so a failure in between leaves runs twice, never none.
    """
    fs, root = _path(spark, path)
    if not fs.exists(root):
        return 0
    removed = read_runs(spark, path).filter(F.col("timestamp") < before).count()
    if not removed:
        return 0
    days = {}
    for status in fs.listStatus(root):  # one entry per day
        name = status.getPath().getName()
        if name.startswith(f"{_DAY}="):
            days[dt.date.fromisoformat(name.split("=")[1])] = status.getPath()
    broken = days.get(before.date())
    if broken is not None:
        old = [status.getPath() for status in fs.listStatus(broken)]
        today = read_runs(spark, path).filter(F.to_date("timestamp") == before.date())
        append_runs(write_down(today.filter(F.col("timestamp") >= before)), path)
        for file in old:
            fs.delete(file, True)
    for day, folder in days.items():
        if day < before.date():
            fs.delete(folder, True)
    return removed
