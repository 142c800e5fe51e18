"""Conversion credit by first touch, last touch and equal shares.

A touch is a click at or before the conversion.  In ``global`` mode every earlier click by
anyone is a touch, which is what the pipeline's SQL says once its always-true customer
predicate is removed.  In ``customer`` mode the touches of a customer are the clicks that
the customer's own conversions name.

No plan here joins conversions with their touches: that product grows with the square of
the history.  Touch counts, first and last touches come from running values per instant,
and the equal-share credit is summed per touch group by walking the axis backwards.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions import exact_sum, limbs, safe_divide, units_of, units_to_double
from clickloom.operators import asof_join, positions, running_by_time, skew_safe_left_join
from clickloom.operators.enrich import hot_share, place_of
from clickloom.session import write_down

MODES = ("global", "customer")
GROUP = ["attributed_channel", "attributed_platform", "attributed_campaign_id"]


def _by(mode: str) -> list[str]:
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}, expected one of {MODES}")
    return ["customer_id"] if mode == "customer" else []


def touches(conversions: DataFrame, clicks: DataFrame, mode: str = "global") -> DataFrame:
    """The clicks that can be touches, with ``customer_id`` in customer mode."""
    by = _by(mode)
    columns = [F.col("click_id"), F.col("click_timestamp").alias("at"),
               F.col("channel").alias(GROUP[0]), F.col("platform").alias(GROUP[1]),
               F.col("campaign_id").alias(GROUP[2])]
    clicks = clicks.select(*columns)
    if not by:
        return clicks
    named = conversions.select("customer_id", "click_id").distinct()
    return skew_safe_left_join(named, clicks, ["click_id"], ["customer_id"]).filter(F.col("at").isNotNull())


def touch_instants(conversions: DataFrame, touch: DataFrame, by: list[str]) -> DataFrame:
    """One row per instant (of a customer): clicks, first and last click, conversions.

    Both feeds are reduced to instants before they meet, so an instant or customer with
    very many events is one row per task.  The result feeds several branches and is
    written down.
    """
    shown = F.struct("click_id", *GROUP)
    clicked = touch.groupBy(*by, "at").agg(
        F.count(F.lit(1)).alias("clicks"), F.min(shown).alias("head"), F.max(shown).alias("tail"))
    converted = conversions.groupBy(*by, F.col("conversion_timestamp").alias("at")).agg(
        F.count(F.lit(1)).alias("conversions"))
    return write_down(clicked.join(converted, [*by, "at"], "full"))


@dataclass(frozen=True)
class Journey:
    """Conversions, the clicks that can be touches, and the instants of both."""

    conversions: DataFrame
    touch: DataFrame
    instants: DataFrame
    by: list[str]

    @staticmethod
    def of(conversions: DataFrame, clicks: DataFrame, mode: str = "global") -> Journey:
        by = _by(mode)
        touch = touches(conversions, clicks, mode)
        return Journey(conversions, touch, touch_instants(conversions, touch, by), by)

    def ledger(self) -> DataFrame:
        """For each conversion instant: number of touches so far, and the first and last of them.

        Clicks tied on an instant are ordered by click_id.
        """
        run = running_by_time(self.instants, "at", sums={"total_touches": "clicks"},
                              firsts={"first_touch": "head"}, lasts={"last_touch": "tail"}, by=self.by)
        return run.filter(F.col("conversions") > 0).select(
            *self.by, F.col("at").alias("conversion_timestamp"), "total_touches", "first_touch", "last_touch")

    def crowded(self) -> DataFrame:
        """The instants that hold much of the conversions, as ``hot_keys`` would name them."""
        total = self.instants.agg(F.sum("conversions")).first()[0] or 0
        full = self.instants.filter(F.col("conversions") >= max(1.0, hot_share(self.instants.sparkSession) * total))
        return full.select(place_of([*self.by, "at"]).alias("_place"))

    def touched(self) -> DataFrame:
        """Conversions that have a touch, each with its touch count and first and last touch."""
        kept = self.conversions.select("conversion_id", "customer_id", "conversion_timestamp", "revenue_euros",
                                       "conversion_type")
        joined = skew_safe_left_join(kept, self.ledger(), [*self.by, "conversion_timestamp"], ["conversion_id"],
                                     hot=self.crowded())
        return joined.filter(F.col("total_touches") > 0)

    def single(self) -> DataFrame:
        """Full credit to the first touch and, as a second row, to the last touch of each conversion."""
        credits = F.array(*[
            F.struct(F.col(touch).alias("touch"), F.lit(touch).alias("model"))
            for touch in ("first_touch", "last_touch")
        ])
        rows = self.touched().withColumn("credit", F.explode(credits))
        return rows.select(
            "conversion_id", "customer_id", "revenue_euros", "conversion_type",
            *[F.col(f"credit.touch.{g}").alias(g) for g in GROUP],
            F.col("revenue_euros").alias("attributed_revenue"),
            F.lit(1.0).alias("attribution_weight"),
            F.col("credit.model").alias("attribution_model"),
        )

    def linear(self) -> DataFrame:
        """Equal-share credit summed by touch group, with the number of (conversion, touch) pairs.

        The order of summation is swapped: a click earns the shares of all later conversions, which is a
        running sum walked backwards, so the pairs themselves are never built.  Shares are summed as
        limbs, so the credit is the exact sum of the shares of all pairs, whatever the order.
        """
        by = self.by
        forward = write_down(running_by_time(self.instants, "at", sums={"total_touches": "clicks"}, by=by)
                             .select(*by, "at", "conversions", "total_touches"))
        # Conversions of an instant with the same revenue have the same share: an instant is as many rows as revenues.
        valued = self.conversions.groupBy(*by, F.col("conversion_timestamp").alias("at"), "revenue_euros").agg(
            F.count(F.lit(1)).alias("n"))
        shares = {"weight": safe_divide(F.lit(1.0), "total_touches"), "revenue": safe_divide("revenue_euros", "total_touches")}
        parts = {f"{name}_{i}": part for name, share in shares.items() for i, part in enumerate(limbs(share))}
        none = F.lit(0).cast("bigint")
        earning = valued.join(forward, [*by, "at"]).select(
            *by, "at", none.alias("touched"), *[(F.coalesce(part, none) * F.col("n")).alias(name) for name, part in parts.items()])
        every = forward.select(*by, "at", F.coalesce("conversions", none).alias("touched"), *[none.alias(name) for name in parts])
        instants = write_down(earning.unionByName(every).groupBy(*by, "at").agg(
            *[F.sum(c).alias(c) for c in ("touched", *parts)]))
        earned = running_by_time(instants, "at", by=by, descending=True,
                                 sums={f"later_{c}": c for c in ("touched", *parts)}).filter(F.col("later_touched") > 0)
        grouped = self.touch.groupBy(*by, "at", *GROUP).agg(F.count(F.lit(1)).alias("clicks"))
        paid = grouped.join(earned.select(*by, "at", *[f"later_{c}" for c in ("touched", *parts)]), [*by, "at"])
        wide = "decimal(19,0)"

        def credit(name: str) -> Column:
            sums = [F.sum(F.col("clicks").cast(wide) * F.col(f"later_{name}_{i}").cast(wide)) for i in range(4)]
            return units_to_double(units_of(sums))

        return (
            paid.groupBy(*GROUP)
            .agg(F.sum(F.col("clicks") * F.col("later_touched")).alias("touches"),
                 credit("revenue").alias("attributed_revenue"), credit("weight").alias("attribution_weight"))
            .withColumn("attribution_model", F.lit("linear"))
        )


def touch_ledger(conversions: DataFrame, clicks: DataFrame, mode: str = "global") -> DataFrame:
    """Touches so far, and the first and last of them, at each conversion instant."""
    return Journey.of(conversions, clicks, mode).ledger()


def conversion_touches(conversions: DataFrame, clicks: DataFrame, mode: str = "global") -> DataFrame:
    """Conversions that have a touch, each with its touch count and first and last touch."""
    return Journey.of(conversions, clicks, mode).touched()


def single_touch_attribution(conversions: DataFrame, clicks: DataFrame, mode: str = "global") -> DataFrame:
    """First-touch and last-touch credit, one row each per conversion."""
    return Journey.of(conversions, clicks, mode).single()


def linear_credit(conversions: DataFrame, clicks: DataFrame, mode: str = "global") -> DataFrame:
    """What each touch of a conversion earns: the same share of revenue and weight for all of them."""
    return conversion_touches(conversions, clicks, mode).select(
        "conversion_id", "customer_id", "revenue_euros", "conversion_type", "total_touches",
        safe_divide("revenue_euros", "total_touches").alias("attributed_revenue"),
        safe_divide(F.lit(1.0), "total_touches").alias("attribution_weight"),
    )


def linear_credit_by(conversions: DataFrame, clicks: DataFrame, mode: str = "global", column: str = GROUP[0],
                     most: int = 64) -> DataFrame:
    """Equal-share credit of each conversion by channel: one row per conversion and value of ``column`` among its touches.

    Each instant has a running count of the clicks of every value; a conversion reads the counts that were current
    at its own instant by an as-of join.  ``column`` may have up to ``most`` values, as each is a counter in the row;
    a column with more values is refused.
    """
    by = _by(mode)
    counted = write_down(touches(conversions, clicks, mode).groupBy(*by, "at", F.col(column).alias("value"))
                         .agg(F.count(F.lit(1)).alias("clicks")))
    values = sorted((r[0] for r in counted.select("value").distinct().limit(most + 1).collect()), key=lambda v: (v is None, v))
    if len(values) > most:
        raise ValueError(f"{column} has more than {most} values")
    counters = [f"clicks_{i}" for i in range(len(values))]
    kept = conversions.select("conversion_id", "customer_id", "conversion_timestamp", "revenue_euros", "conversion_type")
    if not values:
        counters, values = ["clicks_0"], [None]
    instants = counted.groupBy(*by, "at").agg(*[
        F.sum(F.when(F.col("value").eqNullSafe(F.lit(v)), F.col("clicks")).otherwise(0)).alias(f"here_{i}")
        for i, v in enumerate(values)])
    running = running_by_time(instants, "at", sums={c: f"here_{i}" for i, c in enumerate(counters)}, by=by)
    current = asof_join(kept, running.select(*by, "at", *counters), "conversion_timestamp", "at", by, ties=[])
    total = sum((F.col(c) for c in counters[1:]), F.col(counters[0]))
    kind = counted.schema["value"].dataType
    shares = F.explode(F.array(*[F.struct(F.lit(v).cast(kind).alias(column), F.col(c).alias("touches"))
                                 for v, c in zip(values, counters, strict=True)]))
    return (current.select("conversion_id", "customer_id", "revenue_euros", "conversion_type", total.alias("total_touches"),
                           shares.alias("share"))
            .filter(F.col("share.touches") > 0)
            .select("conversion_id", "customer_id", "revenue_euros", "conversion_type", f"share.{column}", "share.touches", "total_touches",
                    safe_divide(F.col("revenue_euros") * F.col("share.touches"), "total_touches").alias("attributed_revenue"),
                    safe_divide("share.touches", "total_touches").alias("attribution_weight")))


def linear_attribution(conversions: DataFrame, clicks: DataFrame, mode: str = "global") -> DataFrame:
    """Equal-share credit by touch group."""
    return Journey.of(conversions, clicks, mode).linear()


def touch_positions(conversions: DataFrame, clicks: DataFrame, mode: str = "global") -> DataFrame:
    """Place of each click among the touches, and whether it is the first or last touch of any conversion.

    The touches of a conversion are the clicks up to its instant, so the place of a click is the same for
    every conversion: one row per click (and customer, in customer mode) stands for all pairs.
    """
    journey = Journey.of(conversions, clicks, mode)
    by = journey.by
    placed = positions(journey.touch.select(*by, "click_id", "at", *GROUP), ["at", "click_id"], "touch_sequence", by)
    ends = journey.ledger().filter(F.col("total_touches") > 0).select(*by, F.explode(F.array(
        F.struct(F.col("first_touch.click_id").alias("click_id"), F.lit(True).alias("first")),
        F.struct(F.col("last_touch.click_id").alias("click_id"), F.lit(False).alias("first")),
    )).alias("end")).groupBy(*by, F.col("end.click_id").alias("click_id")).agg(
        F.bool_or("end.first").alias("is_first_touch"), F.bool_or(~F.col("end.first")).alias("is_last_touch"))
    return placed.join(ends, [*by, "click_id"], "left").select(
        *by, "click_id", F.col("at").alias("click_timestamp"), *GROUP, "touch_sequence",
        *[F.coalesce(flag, F.lit(False)).alias(flag) for flag in ("is_first_touch", "is_last_touch")])


def int_attribution(conversions: DataFrame, clicks: DataFrame, mode: str = "global") -> DataFrame:
    """Credit of all three models in one table.

    First and last touch give one row per conversion.  Linear credit is held per touch
    group, with NULL conversion columns: its rows per (conversion, touch) would number the
    conversions times the clicks.  ``touches`` is the number of touches a row stands for.
    """
    journey = Journey.of(conversions, clicks, mode)
    single = journey.single().withColumn("touches", F.lit(1).cast("bigint"))
    return single.unionByName(journey.linear(), allowMissingColumns=True)


def attribution_summary(conversions: DataFrame, clicks: DataFrame, mode: str = "global") -> DataFrame:
    """Credit by model and touch group."""
    return int_attribution(conversions, clicks, mode).groupBy("attribution_model", *GROUP).agg(
        F.sum("touches").alias("touches"),
        exact_sum("attributed_revenue").alias("attributed_revenue"),
        exact_sum("attribution_weight").alias("attribution_weight"),
    )
