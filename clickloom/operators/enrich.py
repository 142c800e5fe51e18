"""Joins that stay balanced when a few key values hold much of the data."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A key is hot from the share of rows of one shuffle partition, but within these bounds: below its share a key at most
# doubles a partition, and at most 1 / LEAST_SHARE keys can reach the lower bound, which bounds what is broadcast.
HOT_SHARE, LEAST_SHARE = 0.005, 1 / 20_000
# Counters per sketch, and per key that can be hot.  Counts are off by at most 3.5 / counters of the rows, under half
# of the share; a sketch takes some 64 KB, or 3 MB at the lower bound.
SKETCH_ITEMS, ITEMS_PER_KEY = 4096, 8
SKETCHES_PER_MERGE = 256


def place_of(keys: Sequence[str]) -> Column:
    """Stands for the key in the sketch; a collision only spreads one key more."""
    return F.xxhash64(*keys)


def _missing(keys: Sequence[str]) -> Column:
    return reduce(or_, [F.col(k).isNull() for k in keys])


def hot_share(spark: SparkSession) -> float:
    """The share of one shuffle partition in the rows, within the bounds above."""
    return max(LEAST_SHARE, min(HOT_SHARE, 1 / int(spark.conf.get("spark.sql.shuffle.partitions"))))


def hot_keys(df: DataFrame, keys: Sequence[str], min_share: float | None = None) -> DataFrame:
    """Hashes (``_place``) of the keys that hold at least ``min_share`` of the rows (default: those of one partition).

    One scan of the key columns with a frequent-items sketch per task: no key is shuffled,
    and the result has at most ``1 / min_share`` rows.  Sketches are merged in two levels,
    so that no task receives the sketches of all others.  The sketch never misses a key
    well above the share; callers use it to place rows, never to choose them.
    """
    min_share = hot_share(df.sparkSession) if min_share is None else min_share
    limit = max(1, round(1 / min_share))
    tracked = max(SKETCH_ITEMS, ITEMS_PER_KEY * limit)
    one = F.count(F.lit(1))
    sketches = (
        df.filter(~_missing(keys))
        .select(place_of(keys).alias("_p"), F.floor(F.spark_partition_id() / SKETCHES_PER_MERGE).alias("_g"))
        .groupBy("_g").agg(F.expr(f"approx_top_k_accumulate(_p, {tracked})").alias("_s"), one.alias("_n"))
    )
    # Grouped by a constant because the merge cannot start from an empty task.
    merged = sketches.groupBy(F.lit(True)).agg(
        F.expr(f"approx_top_k_combine(_s, {tracked})").alias("_s"), F.sum("_n").alias("_n"))
    return (
        merged.select(F.explode(F.expr(f"approx_top_k_estimate(_s, {limit})")).alias("t"), "_n")
        .filter(F.col("t.count") >= F.col("_n") * F.lit(min_share))
        .select(F.col("t.item").alias("_place"))
    )


# How to make a value of a key column out of a hash, by type.
_SCATTER = {
    T.StringType: lambda h: h.cast("string"),
    T.LongType: lambda h: h,
    T.IntegerType: lambda h: F.pmod(h, F.lit(2**31 - 1)).cast("int"),
    T.ShortType: lambda h: F.pmod(h, F.lit(2**15 - 1)).cast("short"),
    T.DoubleType: lambda h: h.cast("double"),
    T.FloatType: lambda h: h.cast("float"),
    T.DateType: lambda h: F.date_from_unix_date(F.pmod(h, F.lit(2**20)).cast("int")),
    T.TimestampNTZType: lambda h: F.timestamp_seconds(F.pmod(h, F.lit(2**32))).cast("timestamp_ntz"),
    T.BinaryType: lambda h: h.cast("string").cast("binary"),
    T.TimestampType: lambda h: F.timestamp_seconds(F.pmod(h, F.lit(2**32))),
}


def _scattered_key(left: DataFrame, on: Sequence[str]):
    """A key column that can hold a hash, and how to put one into it."""
    for c in on:
        kind = left.schema[c].dataType
        if type(kind) in _SCATTER:
            return c, _SCATTER[type(kind)]
        if isinstance(kind, T.DecimalType):
            whole = 10 ** min(18, kind.precision - kind.scale)
            return c, lambda h: F.pmod(h, F.lit(whole)).cast(kind)
    raise TypeError(f"no key of {[left.schema[c].dataType.simpleString() for c in on]} can be spread over tasks")


def skew_safe_left_join(left: DataFrame, right: DataFrame, on: Sequence[str], spread_by: Sequence[str],
                        hot: DataFrame | None = None) -> DataFrame:
    """Look up the columns of ``right`` by key, with hot keys of ``left`` spread over all tasks.

    ``right`` must hold one row per key.  The result has the rows of ``left LEFT JOIN
    right``: the columns of ``left``, then the others of ``right``.

    Left rows with a hot key find their match in a broadcast of the right rows of the hot
    keys, one row for each of at most ``1 / min_share`` keys.  In the shuffled join that
    serves the rest, these rows, and those without a key, carry a hash of ``spread_by``
    (columns that vary within a key) in place of their key, so they go everywhere; what
    they may meet there is ignored.  The right side is neither copied nor repartitioned.
    The hash is no random number, so recomputing a lost task gives the same rows.  ``hot``
    defaults to a sketch of ``left``.

    Where no column of ``right`` is read and its key is known to be unique, the optimizer
    drops the lookup altogether.
    """
    on = list(on)
    payload = [c for c in right.columns if c not in on]
    hot = hot_keys(left, on) if hot is None else hot
    flags = F.broadcast(hot.select("_place").distinct().withColumn("_hot", F.lit(True)))
    known = right.filter(~_missing(on))

    # Grouping by the key bounds the broadcast by the number of hot keys.
    few = (known.withColumn("_place", place_of(on)).join(flags, "_place", "left_semi")
           .groupBy(*on).agg(F.any_value(F.struct(*payload)).alias("_few"), F.count(F.lit(1)).alias("_n"))
           .select(*on, F.when(F.col("_n") == 1, F.col("_few")).otherwise(
               F.raise_error(F.lit("the looked-up side has several rows of a key"))).alias("_few")))
    marked = (left.withColumn("_place", place_of(on)).join(flags, "_place", "left")
              .join(F.broadcast(few), on, "left"))

    anchor, scatter = _scattered_key(left, on)
    apart = F.coalesce("_hot", F.lit(False)) | _missing(on)
    scattered = F.when(apart, scatter(F.xxhash64(*spread_by))).otherwise(F.col(anchor))
    keyed = marked.select(
        *left.columns, "_few", apart.alias("_apart"),
        *[(scattered if c == anchor else F.col(c)).alias(f"_left_{c}") for c in on])
    rest = known.select(*[F.col(c).alias(f"_right_{c}") for c in on], *[F.col(c).alias(f"_rest_{c}") for c in payload])
    joined = keyed.join(rest, [F.col(f"_left_{c}") == F.col(f"_right_{c}") for c in on], "left")
    return joined.select(
        *left.columns,
        *[F.when(F.col("_apart"), F.col(f"_few.{c}")).otherwise(F.col(f"_rest_{c}")).alias(c) for c in payload])


def orphan_keys(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child key values with their row count ``n`` and whether the parent has them (``found``).

    Both sides collapse to distinct keys before they meet, so no key value, however
    frequent, brings more than one row per task to the join.
    """
    counted = child.groupBy(F.col(child_key).alias("_key")).agg(F.count(F.lit(1)).alias("n"))
    known = parent.select(F.col(parent_key).alias("_key")).distinct().withColumn("_found", F.lit(True))
    return counted.join(known, "_key", "left").select(
        F.col("_key").alias(child_key), "n", F.coalesce("_found", F.lit(False)).alias("found")
    )
