"""Writing tables, and a warehouse of layered tables in the session catalog."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from clickloom.schemas import RAW_TABLES, TableSpec

# The database of each layer.
LAYERS = {"raw": "raw_marketing", "staging": "staging_marketing", "analytics": "analytics_marketing"}


def arrange(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Lay rows out for writing: together by partition, sorted by the clustering columns.

    Rebalancing lets the adaptive planner split a partition that holds much of the data
    over several tasks and merge small ones, which a plain repartition by day would not.
    """
    if spec.partition_expr is not None:
        df = df.withColumn(spec.partition_by, F.expr(spec.partition_expr))
    if spec.partition_by is None:
        return df.sortWithinPartitions(*spec.cluster_by) if spec.cluster_by else df
    return df.hint("rebalance", F.col(spec.partition_by)).sortWithinPartitions(spec.partition_by, *spec.cluster_by)


def _writer(df: DataFrame, spec: TableSpec, mode: str) -> DataFrameWriter:
    writer = arrange(df, spec).write.mode(mode).format("parquet")
    return writer.partitionBy(spec.partition_by) if spec.partition_by else writer


def write_table(df: DataFrame, spec: TableSpec, path: str, mode: str = "overwrite") -> None:
    """Write a table as Parquet under a path, replacing its contents by default."""
    _writer(df, spec, mode).save(path)


def between(table: DataFrame, spec: TableSpec, start: dt.datetime | None = None, end: dt.datetime | None = None,
            column: str = "timestamp") -> DataFrame:
    """Rows of a stored table with ``column`` from ``start`` up to, but without, ``end``, read from their partitions only.

    ``partition_expr`` of the table must not decrease with ``column`` (to_date, trunc and date_trunc do not): the same
    expression of the bounds then bounds the partitions, and files outside are never listed.
    """
    if spec.partition_by is None or spec.partition_expr is None or not re.search(rf"\b{column}\b", spec.partition_expr):
        raise ValueError(f"{spec.name} is not partitioned by {column}")
    for bound, inside in ((start, ">="), (end, "<")):
        if bound is not None:
            instant = f"TIMESTAMP '{bound:%Y-%m-%d %H:%M:%S.%f}'"
            place = re.sub(rf"\b{column}\b", instant, spec.partition_expr)
            table = table.filter(F.expr(f"{spec.partition_by} {inside[0]}= {place}")).filter(F.expr(f"{column} {inside} {instant}"))
    return table


@dataclass
class Warehouse:
    """The three layers as catalog databases, optionally prefixed and placed under a folder.

    Tables are partitioned by day as declared; ``grain="month"`` lays the same tables out by month, for feeds
    whose days are too small to be files.
    """

    spark: SparkSession
    prefix: str = ""
    location: str | None = None
    layers: Mapping[str, str] = field(default_factory=lambda: dict(LAYERS))
    grain: str = "day"

    def layout(self, spec: TableSpec) -> TableSpec:
        """A table's declaration at the grain of this warehouse."""
        if self.grain == "day" or spec.partition_by is None:
            return spec
        if self.grain != "month":
            raise ValueError(f"unknown grain {self.grain!r}")
        of = "timestamp" if spec.partition_expr else spec.partition_by
        return replace(spec, partition_by="event_month", partition_expr=f"trunc({of}, 'MM')")

    def database(self, layer: str) -> str:
        return self.prefix + self.layers[layer]

    def name(self, spec: TableSpec) -> str:
        return f"{self.database(spec.layer)}.{spec.name}"

    def create_layers(self) -> None:
        """Create the databases that do not exist yet."""
        for layer in self.layers:
            where = f" LOCATION '{self.location}/{self.database(layer)}'" if self.location else ""
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database(layer)}{where}")

    def create_raw_tables(self) -> None:
        """Create the raw tables, empty, with their declared columns."""
        for spec in RAW_TABLES.values():
            self.replace(self.spark.createDataFrame([], spec.schema), spec)

    def replace(self, df: DataFrame, spec: TableSpec) -> DataFrame:
        """Replace a table by the rows of a frame, and return the table as written."""
        _writer(df, self.layout(spec), "overwrite").saveAsTable(self.name(spec))
        properties = {"comment": spec.description, **{f"label.{k}": v for k, v in spec.labels.items()}}
        listed = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items() if v)
        if listed:
            self.spark.sql(f"ALTER TABLE {self.name(spec)} SET TBLPROPERTIES ({listed})")
        return self.read(spec)

    def drop(self) -> None:
        """Drop the databases with all their tables."""
        for layer in self.layers:
            self.spark.sql(f"DROP DATABASE IF EXISTS {self.database(layer)} CASCADE")

    def read(self, spec: TableSpec, start: dt.datetime | None = None, end: dt.datetime | None = None) -> DataFrame:
        """A table without the partition column that writing derived, from ``start`` up to ``end`` if they are given."""
        table, spec = self.spark.table(self.name(spec)), self.layout(spec)
        if start is not None or end is not None:
            table = between(table, spec, start, end)
        return table.drop(spec.partition_by) if spec.partition_expr is not None else table

    def table_counts(self, specs: list[TableSpec]) -> DataFrame:
        """Row counts of the tables that exist, in one action."""
        counted = [
            self.spark.table(self.name(s)).agg(F.count(F.lit(1)).alias("row_count"))
            .select(F.lit(self.database(s.layer)).alias("layer"), F.lit(s.name).alias("table"), "row_count")
            for s in specs if self.spark.catalog.tableExists(self.name(s))
        ]
        return reduce(DataFrame.unionByName, counted)
