import datetime as dt
import math
import random
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickloom import functions as fn
from tests.rows import ts


def column(spark, values, kind, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in df.select("i", expr(F.col("v")).alias("x")).orderBy("i").collect()]


def test_safe_divide(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0), (2, 1.0, 0.0), (3, None, 1.0), (4, 1.0, None), (5, 6.0, 4.0)],
                               "i int, a double, b double")
    got = df.select(fn.safe_divide("a", "b"), fn.safe_divide("a", "b", on_zero=0)).collect()
    assert [r[0] for r in got] == [None, None, None, None, 1.5]
    assert [r[1] for r in got] == [0.0, 0.0, 0.0, 0.0, 1.5]


def test_round_half_away(spark):
    values = [0.125, -0.125, 2.5, -2.5, None, 0.0, -0.001, float("inf"), 1e18, float("nan")]
    two = column(spark, values, "double", lambda v: fn.round_half_away(v, 2))
    assert two[:2] == [0.13, -0.13]
    assert two[4:9] == [None, 0.0, 0.0, float("inf"), 1e18]
    assert two[9] != two[9]
    assert str(two[6]) == "0.0"  # no negative zero
    assert column(spark, values[2:4], "double", lambda v: fn.round_half_away(v, 0)) == [3.0, -3.0]


def test_micros_to_euros_rounds_ties_away(spark):
    values = [12350, 12349, 50, 49, 0, -50, -49, None, 500000]
    got = column(spark, values, "bigint", fn.micros_to_euros)
    assert got == [0.0124, 0.0123, 0.0001, 0.0, 0.0, -0.0001, 0.0, None, 0.5]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(0, 1_000_000), min_size=1, max_size=200))
def test_micros_to_euros_equals_decimal_rounding(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    bad = df.filter(fn.micros_to_euros("v") != F.expr("cast(round(cast(v as decimal(20,6)) / 1000000, 4) as double)"))
    assert bad.count() == 0


def test_exact_sum_loses_no_digit_whatever_the_order(spark):
    rnd = random.Random(3)
    cases = [[0.1] * 10 + [1e9, 0.0001, -1e9], [1e-7] * 1000, [-0.00005, 0.00005, -2.5], [2.0**40, 2.0**-60, -(2.0**40)], [-1e-12, -0.3],
             [rnd.uniform(-1e6, 1e6) for _ in range(500)], [rnd.uniform(-1, 1) * 10.0 ** rnd.randrange(-3, 7) for _ in range(500)], [0.0], [-0.0]]
    for amounts in cases:
        want = float(sum(map(Fraction, amounts)))
        rnd.shuffle(amounts)
        df = spark.createDataFrame([(a,) for a in amounts], "a double").repartition(3)
        got = df.agg(fn.exact_sum("a"), fn.exact_sum("a", F.col("a") > 0)).first()
        # Digits below 2**-66 of an amount are cut; whole part and fraction are rounded one after the other.
        assert abs(got[0] - want) <= math.ulp(want) + len(amounts) * 2.0**-66 and (got[0] == want or len(amounts) > 100)
        assert (got[1] or 0) == pytest.approx(sum(a for a in amounts if a > 0), rel=1e-15)
    assert spark.createDataFrame([(None,)], "a double").agg(fn.exact_sum("a")).first()[0] is None
    plan = df.groupBy((F.col("a") > 0).alias("k")).agg(fn.exact_sum("a"))._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_budget_tiers_share_their_bounds(spark):
    got = column(spark, [1999.99, 2000.0, 7000.0, 7000.01, 10000.0, 10000.01, None], "double", fn.budget_tier)
    assert got == ["small", "medium", "medium", "large", "large", "enterprise", "enterprise"]


def test_revenue_tiers(spark):
    got = column(spark, [0.0, 49.99, 50.0, 200.0, 200.01, 500.0, 500.01, -1.0], "double", fn.revenue_tier)
    assert got == ["no_value", "low", "medium", "medium", "high", "high", "premium", "low"]


def test_labels(spark):
    assert column(spark, [" \tGoogle_Ads \n", None], "string", fn.normalize_label) == ["GOOGLE_ADS", None]
    assert column(spark, ["  Meta "], "string", lambda v: fn.normalize_label(v, "lower")) == ["meta"]
    assert column(spark, ["SEO", "TIKTOK_ADS", "RADIO", None], "string", fn.channel_group) == [
        "Organic", "Paid Social", "Other", "Other"]
    assert column(spark, ["lead", "call"], "string", fn.conversion_label) == ["Lead", "Other"]
    with pytest.raises(ValueError):
        fn.normalize_label("x", "title")


def test_calendar(spark):
    moments = [ts("2024-01-07 23:59:59"), ts("2024-01-08 00:00:00")]  # Sunday, Monday
    assert column(spark, moments, "timestamp", fn.week_start) == [ts("2024-01-01"), ts("2024-01-08")]
    ends = [ts("2024-01-31 23:59:59"), ts("2024-02-01 00:00:00")]
    assert column(spark, ends, "timestamp", fn.month_start) == [dt.date(2024, 1, 1), dt.date(2024, 2, 1)]


def test_elapsed_counts_whole_spans(spark):
    start = F.lit(ts("2024-01-01 12:00:00"))
    spans = [dt.timedelta(hours=23, minutes=59, seconds=59), dt.timedelta(hours=24), dt.timedelta(days=30),
             dt.timedelta(days=30, seconds=1), dt.timedelta(days=31), dt.timedelta(seconds=-1)]
    moments = [ts("2024-01-01 12:00:00") + s for s in spans]
    days = column(spark, moments, "timestamp", lambda v: fn.elapsed("DAY", start, v))
    assert days == [0, 1, 30, 30, 31, 0]
    minutes = column(spark, [ts("2024-01-01 12:01:01")], "timestamp",
                     lambda v: fn.elapsed("MINUTE", F.lit(ts("2024-01-01 12:00:59")), v))
    assert minutes == [0]


def test_clamp_keeps_null(spark):
    assert column(spark, [None, -5.0, 50.0, 150.0], "double", lambda v: fn.clamp(v, 0.0, 100.0)) == [
        None, 0.0, 50.0, 100.0]


def test_band(spark):
    got = column(spark, [3.0, 2.9, 0.9, None], "double",
                 lambda v: fn.band(v, [(3.0, "good"), (1.0, "warn")], "bad"))
    assert got == ["good", "warn", "bad", "bad"]
    got = column(spark, [30.0, 90.0, 90.5], "double",
                 lambda v: fn.band(v, [(30.0, "good"), (90.0, "warn")], "bad", ceilings=True))
    assert got == ["good", "warn", "bad"]
