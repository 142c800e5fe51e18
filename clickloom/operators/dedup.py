"""One row per key, by partial aggregation rather than by ranking whole groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dedup_latest(df: DataFrame, keys: Sequence[str], order_col: str,
                 tiebreak: Sequence[str] = ()) -> DataFrame:
    """Keep the row with the greatest ``order_col`` for each key.

    Rows equal on the key and on ``order_col`` are told apart by ``tiebreak`` and then by
    every other column (greatest wins, NULL last), so the winner never depends on
    partitioning.

    This is a maximum over a struct of the row, so each task reduces a key to one row
    before the shuffle and a key with very many copies is no bottleneck.  Being an
    aggregate it also tells the optimizer that the key is unique, which lets it drop
    left joins to the result whose columns nobody reads.
    """
    lead = [order_col, *tiebreak]
    rest = [c for c in df.columns if c not in keys and c not in lead]
    latest = df.groupBy(*keys).agg(F.max(F.struct(*lead, *rest)).alias("_row"))
    return latest.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def dedup_latest_rare(df: DataFrame, keys: Sequence[str], order_col: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """The rows of ``dedup_latest``, for wide feeds in which most keys stand once.

    A first phase looks only at the keys: a hash aggregate, combined in each task before the shuffle, that finds the
    keys with several rows.  Rows of other keys pass through unsorted and uncompared; those of repeated keys reach the
    comparison of whole rows.  The wide rows are shuffled once, as both branches read the same exchange; a key with
    very many rows is split by the adaptive planner, as its side of the join is the streamed one.

    Unlike the single aggregate, this does not tell the optimizer that keys are unique.
    """
    seen = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    seen = seen.select(*[F.col(c).alias(f"_key_{c}") for c in keys], "_n").hint("shuffle_hash")
    match = [F.col(c).eqNullSafe(F.col(f"_key_{c}")) for c in keys]
    marked = df.join(seen, match, "left")
    once = marked.filter(F.col("_n").isNull()).select(*df.columns)
    again = marked.filter(F.col("_n").isNotNull()).select(*df.columns)
    return once.unionByName(dedup_latest(again, keys, order_col, tiebreak))


def first_by(payload: Sequence[Column | str], order: Sequence[Column], where: Column | None = None) -> Column:
    """Aggregate: the payload of the row that sorts first by ``order`` (NULLs first).

    ``order`` should identify the row.  Read the payload from field ``pick`` of the result,
    which is NULL when no row satisfies ``where``.
    """
    keys = [o.alias(f"o{i}") for i, o in enumerate(order)]
    row = F.struct(*keys, F.struct(*payload).alias("pick"))
    return F.min(row if where is None else F.when(where, row))


def pick_per_group(df: DataFrame, group: Sequence[str], payload: Sequence[Column | str],
                   order: Sequence[Column], where: Column | None = None) -> DataFrame:
    """Top-1 per group: one row for each group that has a qualifying row."""
    source = df if where is None else df.filter(where)
    return (source.groupBy(*group).agg(first_by(payload, order).alias("_first"))
            .select(*group, "_first.pick.*"))
