"""As-of join: for every row of one feed the last row of another feed at or before its instant."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.session import write_down

DIRECTIONS = ("backward", "forward")


def asof_join(left: DataFrame, right: DataFrame, left_time: str, right_time: str, by: Sequence[str] = (),
              ties: Sequence[str] | None = None, direction: str = "backward", strict: bool = False,
              within: str | None = None) -> DataFrame:
    """The rows of ``left`` with the columns of the row of ``right`` that was current at their instant.

    ``backward`` takes the last right row at or before ``left_time``, ``forward`` the first at or after it;
    with ``strict`` an equal instant does not count.  ``by`` names key columns that must be equal.  Of right
    rows at one instant the greatest in ``ties`` (default: all its other columns) is taken backward, the least
    forward.  A match further away than ``within`` (an interval such as ``'30 days'``) is no match.  Left rows without
    match, instant or key keep NULLs.

    Both feeds become one stream, range-sorted by (``by``, instant) over any number of tasks and written down with
    the number of the range.  Inside a range the last right row is a running value; what a range inherits is one
    row per range and key.  So neither the axis, nor one key, nor one crowded instant needs a single task, and no
    pairs of rows are built.
    """
    if direction not in DIRECTIONS:
        raise ValueError(f"unknown direction {direction!r}, expected one of {DIRECTIONS}")
    by = list(by)
    payload = [c for c in right.columns if c not in by]
    clash = sorted(set(payload) & set(left.columns))
    if clash:
        raise ValueError(f"both sides have the columns {clash}")
    back = direction == "backward"
    ties = [c for c in payload if c != right_time] if ties is None else list(ties)
    kinds = {f.name: f.dataType for f in right.schema.fields}

    # On the way along the axis, right rows come before left rows of their instant unless the match is strict.
    known = right.filter(F.col(right_time).isNotNull())
    for c in by:
        known = known.filter(F.col(c).isNotNull())
    events = known.select(
        *by, F.col(right_time).alias("_at"), F.lit(strict).alias("_last"), *[F.col(c).alias(f"_tie_{c}") for c in ties],
        F.lit(0).cast("bigint").alias("_place"), F.struct(*payload).alias("_right"),
        F.lit(None).cast(left.schema).alias("_left"))
    asking = left.select(
        *by, F.col(left_time).alias("_at"), F.lit(not strict).alias("_last"), *[F.lit(None).cast(kinds[c]).alias(f"_tie_{c}") for c in ties],
        F.xxhash64(*left.columns).alias("_place"), F.lit(None).cast(right.select(*payload).schema).alias("_right"),
        F.struct(*left.columns).alias("_left"))

    def along(name: str) -> Column:
        return F.col(name).asc_nulls_first() if back or name == "_last" else F.col(name).desc_nulls_first()

    order = [along(c) for c in ("_at", "_last", *(f"_tie_{c}" for c in ties), "_place")]
    stream = events.unionByName(asking)
    ranged = write_down(stream.repartitionByRange(*[F.col(c).asc() for c in by], *order).withColumn("_range", F.spark_partition_id()))

    latest = F.struct("_at", *[f"_tie_{c}" for c in ties], "_right")
    shown = F.when(F.col("_right").isNotNull(), latest)
    ends = ranged.groupBy(*by, "_range").agg((F.max if back else F.min)(shown).getField("_right").alias("_end"))
    before = (Window.partitionBy(*by) if by else Window).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*by, "_range", F.last("_end", ignorenulls=True).over(before).alias("_carried"))

    inside = Window.partitionBy(*by, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = ranged.withColumn("_held", F.last("_right", ignorenulls=True).over(inside)).filter(F.col("_left").isNotNull())
    found = held.join(carried, [*by, "_range"], "left").select("_left", F.coalesce("_held", "_carried").alias("_match"))
    if within is not None:
        near, far = (F.col(f"_match.{right_time}"), F.col(f"_left.{left_time}"))
        if not back:
            near, far = far, near
        found = found.withColumn("_match", F.when(near + F.expr(f"INTERVAL {within}") >= far, F.col("_match")))
    return found.select("_left.*", *[F.col(f"_match.{c}").alias(c) for c in payload])
