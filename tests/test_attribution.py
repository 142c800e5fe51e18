import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from clickloom.plans import attribution as A
from clickloom.plans import staging
from tests.rows import rows_of, ts

CLICK = "click_id string, campaign_id string, channel string, platform string, click_timestamp timestamp"
CONVERSION = ("conversion_id string, click_id string, customer_id string, conversion_timestamp timestamp, "
              "revenue_euros double, conversion_type string")


def journey(seed, n_clicks=60, n_conversions=40):
    """Clicks and conversions with ties, one customer who holds a third of them, and orphans."""
    rnd = random.Random(seed)
    start = ts("2024-03-01 00:00:00")

    def at():
        return start + dt.timedelta(days=rnd.choice([0, 0, 1, 9]), seconds=rnd.randrange(90))

    clicks = [(f"k{i:02}", f"C{rnd.randrange(3)}", rnd.choice(["SEO", "EMAIL"]), "p", at()) for i in range(n_clicks)]
    conversions = []
    for i in range(n_conversions):
        click = rnd.choice(clicks)[0] if rnd.random() < 0.9 else "gone"
        customer = "hot" if rnd.random() < 0.33 else f"u{rnd.randrange(6)}"
        conversions.append((f"v{i:02}", click, customer, at(), float(rnd.randrange(1000)) / 4, "lead"))
    return clicks, conversions


def brute_force(clicks, conversions, mode):
    """Touches of each conversion in order, from the literal definition."""
    own = defaultdict(set)
    for _, click, customer, *_ in conversions:
        own[customer].add(click)
    return {
        v: sorted((c for c in clicks if c[4] <= v[3] and (mode == "global" or c[0] in own[v[2]])),
                  key=lambda c: (c[4], c[0]))
        for v in conversions
    }


def frames(spark, clicks, conversions):
    return spark.createDataFrame(conversions, CONVERSION), spark.createDataFrame(clicks, CLICK)


@pytest.mark.parametrize("mode", A.MODES)
@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, mode, seed):
    clicks, conversions = journey(seed)
    cv, clk = frames(spark, clicks, conversions)
    expected = brute_force(clicks, conversions, mode)

    single = A.single_touch_attribution(cv, clk, mode)
    want = []
    for v, touch in expected.items():
        for pick, model in ((0, "first_touch"), (-1, "last_touch")):
            if touch:
                t = touch[pick]
                want.append((v[0], v[2], t[2], t[3], t[1], v[4], 1.0, model))
    assert rows_of(single, "conversion_id", "customer_id", *A.GROUP, "attributed_revenue", "attribution_weight",
                   "attribution_model") == sorted(want, key=repr)

    credit = defaultdict(lambda: [0, 0.0, 0.0])
    for v, touch in expected.items():
        for t in touch:
            c = credit[(t[2], t[3], t[1])]
            c[0] += 1
            c[1] += v[4] / len(touch)
            c[2] += 1 / len(touch)
    linear = {tuple(r[g] for g in A.GROUP): r for r in A.linear_attribution(cv, clk, mode).collect()}
    assert set(linear) == set(credit)
    for group, (n, revenue, weight) in credit.items():
        row = linear[group]
        assert row.touches == n
        assert row.attributed_revenue == pytest.approx(revenue, abs=1e-9)
        assert row.attribution_weight == pytest.approx(weight, abs=1e-9)

    shares = rows_of(A.linear_credit(cv, clk, mode), "conversion_id", "total_touches", "attribution_weight")
    assert shares == sorted((v[0], len(t), 1 / len(t)) for v, t in expected.items() if t)


def test_click_at_the_moment_of_conversion_counts_and_later_ones_do_not(spark):
    noon = ts("2024-01-01 12:00:00")
    clicks = [("k2", "C1", "SEO", "p", noon), ("k1", "C2", "EMAIL", "p", noon),
              ("k3", "C3", "META", "p", noon + dt.timedelta(microseconds=1))]
    conversions = [("v1", "k1", "u", noon, 8.0, "lead"),
                   ("v0", "k1", "u", noon - dt.timedelta(seconds=1), 8.0, "lead")]
    cv, clk = frames(spark, clicks, conversions)
    got = rows_of(A.single_touch_attribution(cv, clk), "conversion_id", "attributed_campaign_id", "attribution_model")
    # Tied clicks are ordered by click_id; the conversion before every click has no credit.
    assert got == [("v1", "C1", "last_touch"), ("v1", "C2", "first_touch")]


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        A.touches(None, None, "household")


@pytest.mark.parametrize("mode", A.MODES)
def test_credit_adds_up(feeds, mode):
    cv, clk = staging.clean_conversions(feeds.conversions), staging.clean_clicks(feeds.clicks)
    touched = A.conversion_touches(cv, clk, mode).agg(F.count("*"), F.sum("revenue_euros")).first()
    by_model = {r.attribution_model: r for r in A.attribution_summary(cv, clk, mode).groupBy("attribution_model").agg(
        F.sum("attribution_weight").alias("w"), F.sum("attributed_revenue").alias("r")).collect()}
    assert set(by_model) == {"first_touch", "last_touch", "linear"}
    for row in by_model.values():
        assert row.w == pytest.approx(touched[0], abs=1e-6)
        assert row.r == pytest.approx(touched[1], abs=1e-4)
