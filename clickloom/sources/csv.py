"""CSV feeds with a declared schema, a bound on bad records, and the rejected ones kept."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.schemas import RAW_TABLES
from clickloom.session import scratch_path

# Fixed value: what the bulk load of the warehouse tolerates when it is asked to be lenient.
BULK_MAX_BAD_RECORDS = 100
_LINE, _REASON, _REJECTED = "malformed_line", "reason", "rejected"


class BadRecords(ValueError):
    """More malformed records than the load allows."""


@dataclass(frozen=True)
class Load:
    """What a bounded load gives: the kept rows, the rejected records as text with the reason, and their numbers."""

    rows: DataFrame
    rejects: DataFrame
    kept: int
    rejected: int


def _lines(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, Column]:
    """Every record as text, with the line itself if its number of fields is wrong; and why a record is bad, or NULL.

    Every column is read as text and judged here, so that what counts as bad does not depend on which columns
    a later query happens to use.
    """
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields]
                           + [T.StructField(_LINE, T.StringType())])
    lines = (
        spark.read.schema(as_text)
        .option("header", True).option("encoding", "UTF-8").option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _LINE)
        # The number of fields is only checked when whole lines are parsed.
        .option("columnPruning", False)
        .csv(path)
    )
    whole = F.col(_LINE).isNull()
    faults = [F.when(~whole, F.lit("wrong number of fields"))]
    faults += [F.when(whole & F.col(f.name).isNull(), F.lit(f"no {f.name}")) for f in schema.fields if not f.nullable]
    faults += [F.when(whole & F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(), F.lit(f"{f.name} is no {f.dataType.simpleString()}"))
               for f in schema.fields if not isinstance(f.dataType, T.StringType)]
    bad = reduce(or_, [fault.isNotNull() for fault in faults])
    return lines, F.when(bad, F.concat_ws("; ", *faults))


def load_csv(spark: SparkSession, path: str, table: str, max_bad_records: int | None = None,
             max_bad_share: float | None = None, quarantine: str | None = None) -> Load:
    """Read a feed with a header line into the declared schema of ``table``, in one pass over its files.

    A record is bad if it has the wrong number of fields, a value that its column's type cannot hold, or no value in
    a required column.  The pass writes good rows and bad records apart under ``quarantine`` (default: the checkpoint
    folder) and counts both on the way.  The load fails if more than ``max_bad_records`` records, or more than
    ``max_bad_share`` of all, are bad; without either bound it fails on any.  The bad records of a failed
    load stay under ``quarantine`` and are named in the error.
    """
    if max_bad_records is None and max_bad_share is None:
        max_bad_records = 0
    schema = RAW_TABLES[table].schema
    lines, reason = _lines(spark, path, schema)
    text = [f.name for f in schema.fields] + [_LINE]
    judged = lines.withColumn(_REASON, reason)
    seen = Observation()
    target = quarantine or scratch_path(spark)
    (judged.observe(seen, F.count(F.lit(1)).alias("records"), F.count(_REASON).alias("bad"))
     .select(
        F.when(F.col(_REASON).isNull(), F.struct(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])).alias("row"),
        F.when(F.col(_REASON).isNotNull(), F.struct(*text, _REASON)).alias("reject"),
        F.col(_REASON).isNotNull().alias(_REJECTED))
     .write.partitionBy(_REJECTED).mode("overwrite").parquet(target))
    records, bad = seen.get["records"], seen.get["bad"]
    over = (max_bad_records is not None and bad > max_bad_records) or (max_bad_share is not None and bad > max_bad_share * records)
    if over:
        bounds = [str(max_bad_records)] if max_bad_records is not None else []
        bounds += [f"{max_bad_share:.2%}"] if max_bad_share is not None else []
        raise BadRecords(f"{bad} of {records} records in {path} are bad, at most {' and '.join(bounds)} allowed; "
                         f"they are kept in {target}/{_REJECTED}=true")
    said = T.StructType([T.StructField(c, T.StringType()) for c in [*text, _REASON]])
    stored = spark.read.schema(T.StructType([T.StructField("row", schema), T.StructField("reject", said),
                                             T.StructField(_REJECTED, T.BooleanType())])).parquet(target)
    return Load(stored.filter(~F.col(_REJECTED)).select("row.*"), stored.filter(F.col(_REJECTED)).select("reject.*"),
                records - bad, bad)


def read_raw_csv(spark: SparkSession, path: str, table: str, max_bad_records: int = 0) -> DataFrame:
    """The rows of a feed in the declared schema of ``table``.

    By default the load is strict and lazy: the job that reads the feed fails on the first bad record.  With
    a bound it is the rows of ``load_csv``, which also keeps what was rejected.
    """
    if max_bad_records:
        return load_csv(spark, path, table, max_bad_records).rows
    schema = RAW_TABLES[table].schema
    lines, reason = _lines(spark, path, schema)
    first = F.concat(F.lit(f"malformed record in {path}: "), reason, F.lit(": "), F.to_json(F.struct(*schema.names, _LINE)))
    kept = lines.filter(F.when(reason.isNotNull(), F.raise_error(first).cast("boolean")).otherwise(F.lit(True)))
    return kept.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])
