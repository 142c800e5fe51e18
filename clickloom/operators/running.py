"""Running values along the time axis, without a task that sees the whole axis."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.session import write_down


def running_by_time(df: DataFrame, time_col: str, sums: Mapping[str, str] | None = None,
                    firsts: Mapping[str, str] | None = None, lasts: Mapping[str, str] | None = None,
                    by: Sequence[str] = (), descending: bool = False) -> DataFrame:
    """Add running sums and running first or last non-NULL values along ``time_col``.

    ``df`` must hold one row per (``by``, instant); aggregate to instants first.  The
    mappings go from new column name to input column.  Each new column covers the rows up
    to and including the current instant, walking the axis forwards, or backwards with
    ``descending``.

    The axis is cut into minutes and days.  A window runs inside each minute, another over
    the minutes of each day and a third over the days, and the three parts are combined.
    So no window sees more than a minute of instants, 1440 minutes, or the days of the
    history, whatever the data volume and however uneven the traffic.
    """
    sums, firsts, lasts = dict(sums or {}), dict(firsts or {}), dict(lasts or {})
    inputs = {**sums, **firsts, **lasts}
    by = list(by)

    def walk(order: str, part: Sequence[str], end: int):
        w = Window.partitionBy(*part) if part else Window
        ordered = F.col(order).desc() if descending else F.col(order).asc()
        return w.orderBy(ordered).rowsBetween(Window.unboundedPreceding, end)

    def running(window, column_of, prefix: str) -> list[Column]:
        def pick(name: str) -> Column:
            source = F.col(column_of(name))
            if name in sums:
                return F.sum(source)
            return (F.first if name in firsts else F.last)(source, ignorenulls=True)
        return [pick(name).over(window).alias(prefix + name) for name in inputs]

    def totals(frame: DataFrame, group: Sequence[str], order: str, column_of) -> DataFrame:
        def total(name: str) -> Column:
            source = F.col(column_of(name))
            if name in sums:
                return F.sum(source)
            earliest = (name in firsts) != descending
            known = F.when(source.isNotNull(), F.struct(F.col(order).alias("at"), source.alias("v")))
            return (F.min if earliest else F.max)(known).getField("v")
        return frame.groupBy(*group).agg(*[total(name).alias(f"_t_{name}") for name in inputs])

    base = df.select("*", F.date_trunc("minute", time_col).alias("_minute"), F.to_date(time_col).alias("_day"))
    minute_key, day_key = [*by, "_day", "_minute"], [*by, "_day"]

    minutes = totals(base, minute_key, time_col, inputs.get)
    days = totals(minutes, day_key, "_minute", "_t_{}".format)

    # Values of the earlier minutes of the day, and of the earlier days.  Without ``by``
    # the last window runs in one task over one row per day of history.
    earlier_minutes = minutes.select(
        *minute_key, *running(walk("_minute", day_key, -1), "_t_{}".format, "_mi_"))
    earlier_days = days.select(*day_key, *running(walk("_day", by, -1), "_t_{}".format, "_da_"))
    offsets = earlier_minutes.join(earlier_days, day_key)

    here = base.select("*", *running(walk(time_col, minute_key, Window.currentRow), inputs.get, "_in_"))
    joined = here.join(offsets, minute_key)

    def combined(name: str) -> Column:
        parts = [F.col(f"{p}{name}") for p in ("_da_", "_mi_", "_in_")]
        if name in sums:
            return sum((F.coalesce(p, F.lit(0)) for p in parts[1:]), F.coalesce(parts[0], F.lit(0)))
        return F.coalesce(*(parts if name in firsts else reversed(parts)))

    return joined.select(*df.columns, *[combined(name).alias(name) for name in inputs])


def positions(df: DataFrame, order: Sequence[str], name: str = "position", by: Sequence[str] = ()) -> DataFrame:
    """Add the 1-based place of each row in its group, in ascending order of unique columns.

    Rows are range-sorted by (``by``, ``order``) and written down with their range; places
    within a range start from the row counts of the ranges before it.  So a group, or an
    instant, with most of the rows is spread over tasks; only one row per range and group
    is summed in one place.
    """
    by = list(by)
    ranged = write_down(df.repartitionByRange(*by, *order).withColumn("_range", F.spark_partition_id()))
    before = (Window.partitionBy(*by) if by else Window).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy(*by, "_range").agg(F.count(F.lit(1)).alias("_rows")).select(
        *[F.col(c).alias(f"_g_{c}") for c in by], F.col("_range").alias("_r"), F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    inside = F.row_number().over(Window.partitionBy(*by, "_range").orderBy(*order))
    match = F.col("_range") == F.col("_r")
    for c in by:
        match &= F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    return ranged.withColumn("_place", inside).join(offsets, match).select(
        *df.columns, (F.col("_offset") + F.col("_place")).alias(name))
