import datetime as dt
import random

import pytest

from clickloom.operators import asof_join
from clickloom.plans import attribution as A
from tests.rows import ts
from tests.test_attribution import brute_force, frames, journey

LEFT = "id int, k string, at timestamp"
RIGHT = "k string, since timestamp, price int"


def feeds(seed):
    """Ties, one key and one instant with a third of the rows, missing keys and instants, repeated rows."""
    rnd = random.Random(seed)
    start = ts("2024-03-01 00:00:00")

    def row():
        k = "hot" if rnd.random() < 0.4 else rnd.choice(["a", "b", "lonely", None])
        at = start if rnd.random() < 0.3 else start + dt.timedelta(seconds=rnd.randrange(40))
        return k, None if rnd.random() < 0.05 else at

    left = [(i, *row()) for i in range(120)]
    right = [(*row(), rnd.randrange(9)) for _ in range(60)]
    return left + left[:3], [r for r in right + right[:3] if r[0] != "lonely"]


@pytest.mark.parametrize("direction", ["backward", "forward"])
@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("by", [["k"], []])
def test_against_brute_force(spark, direction, strict, by):
    left, right = feeds(7)
    back, want = direction == "backward", []
    for i, k, at in left:
        seen = [r for r in right if r[1] is not None and at is not None and (not by or r[0] is not None and r[0] == k)
                and ((r[1] < at if back else r[1] > at) or r[1] == at and not strict)]
        best = (max if back else min)(seen, key=lambda r: (r[1], r[2]), default=(None, None, None))
        if best[1] is not None and abs((best[1] - at).total_seconds()) > 5:
            best = (None, None, None)
        want.append((i, k, at, best[1], best[2]))
    r = spark.createDataFrame(right, RIGHT)
    got = asof_join(spark.createDataFrame(left, LEFT).repartition(3), r if by else r.drop("k"), "at", "since", by, direction=direction,
                    strict=strict, within="5 seconds")
    assert got.columns == ["id", "k", "at", "since", "price"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_empty_sides_and_clashing_names(spark):
    left, right = feeds(1)
    empty = spark.createDataFrame([], RIGHT)
    assert {r.since for r in asof_join(spark.createDataFrame(left, LEFT), empty, "at", "since", ["k"]).collect()} == {None}
    assert asof_join(spark.createDataFrame([], LEFT), spark.createDataFrame(right, RIGHT), "at", "since", ["k"]).count() == 0
    with pytest.raises(ValueError, match="both sides"):
        asof_join(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), "at", "since")


@pytest.mark.parametrize("mode", A.MODES)
def test_credit_by_channel_against_all_pairs(spark, mode):
    clicks, conversions = journey(3)
    cv, clk = frames(spark, clicks, conversions)
    want = []
    for v, touch in brute_force(clicks, conversions, mode).items():
        for channel in {t[2] for t in touch}:
            n = sum(t[2] == channel for t in touch)
            want.append((v[0], channel, n, len(touch), v[4] * n / len(touch), n / len(touch)))
    got = A.linear_credit_by(cv, clk, mode).select("conversion_id", A.GROUP[0], "touches", "total_touches", "attributed_revenue",
                                                   "attribution_weight").collect()
    assert sorted(map(tuple, got)) == sorted(want)
    with pytest.raises(ValueError, match="more than 1"):
        A.linear_credit_by(cv, clk, mode, most=1)
    assert A.linear_credit_by(cv, clk.limit(0), mode).count() == 0


def test_no_task_holds_the_axis_and_no_pairs_are_built(spark):
    left, right = feeds(2)
    plan = asof_join(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT).drop("k"), "at", "since")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    # The only window without a key runs over one row per range.
    held = [line for line in text.splitlines() if "Window [last(_right" in line]
    assert held and all("[_range" in line for line in held)
