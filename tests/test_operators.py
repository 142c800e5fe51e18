import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from clickloom.operators import (
    dedup_latest,
    hot_keys,
    orphan_keys,
    pick_per_group,
    positions,
    running_by_time,
    skew_safe_left_join,
)
from tests.rows import rows_of, ts


def test_dedup_keeps_latest_and_breaks_ties_by_the_other_columns(spark):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "m"), ("a", 2, "z"), ("a", 2, None), ("b", None, "q"), (None, 5, "n"), (None, 6, "o")],
        "k string, t int, v string")
    assert rows_of(dedup_latest(df, ["k"], "t"), "k", "t", "v") == [
        ("a", 2, "z"), ("b", None, "q"), (None, 6, "o")]
    # Column order is kept whichever column orders the rows.
    assert dedup_latest(df, ["k"], "t").columns == ["k", "t", "v"]


def test_dedup_result_does_not_depend_on_partitioning(spark):
    df = spark.range(5000).select((F.col("id") % 97).alias("k"), (F.col("id") % 7).alias("t"), F.hash("id").alias("v"))
    assert rows_of(dedup_latest(df.repartition(1), ["k"], "t"), "*") == rows_of(
        dedup_latest(df.repartition(13, "v"), ["k"], "t"), "*")


def test_pick_per_group(spark):
    df = spark.createDataFrame([("a", 1, "p"), ("a", 1, "o"), ("a", 0, "z"), ("b", 0, "w")], "g string, s int, n string")
    best = pick_per_group(df, ["g"], ["n"], [-F.col("s"), F.col("n")], where=F.col("s") > 0)
    assert rows_of(best, "g", "n") == [("a", "o")]


def skewed(spark, n=3000):
    """A third of the rows on one key, a tenth without key, the rest spread."""
    i = F.col("id")
    key = F.when(i % 3 == 0, "hot").when(i % 10 == 1, F.lit(None)).otherwise((i % 500).cast("string"))
    return spark.range(n).select(key.alias("k"), i.alias("row"))


def test_hot_keys_finds_the_dominant_key(spark):
    found = hot_keys(skewed(spark), ["k"], min_share=0.05).collect()
    expected = spark.range(1).select(F.xxhash64(F.lit("hot"))).first()[0]
    assert [r[0] for r in found] == [expected]


def test_a_key_is_hot_from_the_share_of_a_partition(spark):
    """Two keys of 0.4 % and 0.12 % of the rows, far below the fixed bound, among keys of one row each."""
    i = F.col("id")
    key = F.when(i % 250 == 0, "some").when(i % 833 == 1, "few").otherwise(i.cast("string"))
    df = spark.range(100_000).select(key.alias("k"), i.alias("row"))
    places = {k: spark.range(1).select(F.xxhash64(F.lit(k))).first()[0] for k in ("some", "few")}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions, expected in (("8", set()), ("400", {"some"}), ("1000", {"some", "few"})):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            hot = hot_keys(df, ["k"])
            spark.conf.set("spark.sql.shuffle.partitions", before)
            assert {r[0] for r in hot.collect()} == set(map(places.get, expected))
        # A key between the two bounds is split by the join.
        spark.conf.set("spark.sql.shuffle.partitions", "400")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        joined = skew_safe_left_join(df, spark.createDataFrame([("some", 1)], "k string, v int"), ["k"], ["row"])
        tasks = joined.filter("k = 'some'").select("v", F.spark_partition_id().alias("task")).collect()
        assert len(tasks) == 400 and {r.v for r in tasks} == {1} and len({r.task for r in tasks}) > 200
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("broadcast", ["-1", "10485760"])
def test_skew_safe_join_gives_the_rows_of_the_plain_join(spark, broadcast):
    left = skewed(spark)
    right = spark.createDataFrame([("hot", 1), ("7", 3), ("missing", 4), (None, 5)], "k string, v int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        got = rows_of(skew_safe_left_join(left, right, ["k"], ["row"]), "k", "row", "v")
        assert got == rows_of(left.join(right, "k", "left"), "k", "row", "v")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("partner", ["hot", "other"])
def test_skew_safe_join_spreads_the_hot_key(spark, partner):
    """Whether the hot key has a partner or dangles, and likewise the rows without a key."""
    right = spark.createDataFrame([(partner, 1)], "k string, v int")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for name, value in conf.items():
        spark.conf.set(name, value)
    try:
        joined = skew_safe_left_join(skewed(spark), right, ["k"], ["row"]).withColumn("task", F.spark_partition_id())
        for rows, expected in (("k = 'hot'", 1000), ("k is null", 200)):
            sizes = [r["count"] for r in joined.filter(rows).groupBy("task").count().collect()]
            assert sum(sizes) == expected
            assert len(sizes) > 1 and max(sizes) < 0.6 * expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_skew_safe_join_by_time(spark):
    at = ts("2024-01-01")
    left = spark.createDataFrame([(at, i) for i in range(50)] + [(ts("2024-01-02"), 50), (None, 51)], "at timestamp, row int")
    right = spark.createDataFrame([(at, "x"), (ts("2024-01-02"), "y"), (None, "z")], "at timestamp, v string")
    got = {r.row: r.v for r in skew_safe_left_join(left, right, ["at"], ["row"]).collect()}
    assert got == {**{i: "x" for i in range(50)}, 50: "y", 51: None}


def test_skew_safe_join_on_several_columns(spark):
    left = spark.createDataFrame([(1, "a", 1), (1, "a", 2), (1, None, 3), (2, "a", 4)], "x int, y string, row int")
    right = spark.createDataFrame([(1, "a", "u"), (2, "b", "v"), (1, None, "w")], "x int, y string, z string")
    got = skew_safe_left_join(left, right, ["x", "y"], ["row"])
    assert rows_of(got, "row", "z") == [(1, "u"), (2, "u"), (3, None), (4, None)]


def test_orphan_keys(spark):
    child = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "fk string")
    parent = spark.createDataFrame([("a",), ("a",), ("c",)], "id string")
    assert rows_of(orphan_keys(child, "fk", parent, "id"), "fk", "n", "found") == [
        ("a", 2, True), ("b", 1, False), (None, 1, False)]


def random_instants(seed, keys):
    rnd = random.Random(seed)
    start = ts("2024-02-27 22:00:00")
    rows = {}
    for _ in range(400):
        # Dense minutes, gaps of days, and sub-second instants.
        at = start + dt.timedelta(days=rnd.choice([0, 0, 0, 1, 5]), seconds=rnd.randrange(300),
                                  microseconds=rnd.choice([0, 0, 1, 500_000]))
        rows[(rnd.choice(keys), at)] = (rnd.randrange(5), rnd.choice([None, None, f"v{rnd.randrange(100)}"]))
    return [(k, at, n, v) for (k, at), (n, v) in rows.items()]


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("by", [[], ["k"]])
def test_running_by_time_against_brute_force(spark, by, descending):
    rows = random_instants(11, ["a", "b"] if by else ["a"])
    df = spark.createDataFrame(rows, "k string, at timestamp, n int, v string")
    out = running_by_time(df, "at", sums={"total": "n"}, firsts={"head": "v"}, lasts={"tail": "v"}, by=by,
                          descending=descending)
    expected = []
    for k, at, n, v in rows:
        seen = sorted((r for r in rows if (not by or r[0] == k) and (r[1] >= at if descending else r[1] <= at)),
                      key=lambda r: r[1], reverse=descending)
        known = [r[3] for r in seen if r[3] is not None]
        expected.append((k, at, sum(r[2] for r in seen), known[0] if known else None, known[-1] if known else None))
    assert rows_of(out, "k", "at", "total", "head", "tail") == sorted(expected, key=repr)


def test_running_by_time_windows_stay_small(spark):
    """No window runs unpartitioned over the instants themselves."""
    df = spark.createDataFrame(random_instants(3, ["a"]), "k string, at timestamp, n int, v string")
    plan = running_by_time(df, "at", sums={"total": "n"})._jdf.queryExecution().optimizedPlan().toString()
    unpartitioned = [line for line in plan.splitlines() if "Window [" in line and ", [_minute" not in line
                     and "[_day" not in line and "_day#" not in line.split("], [")[1]]
    assert len([line for line in plan.splitlines() if "Window [" in line]) == 3
    assert len(unpartitioned) <= 1  # the one over the days


@pytest.mark.parametrize("kind", ["int", "bigint", "smallint", "string", "date", "decimal(12,2)", "double", "timestamp"])
def test_hot_keys_of_any_type_are_found(spark, kind):
    day = "date_add(date'2024-01-01', k)" if kind in ("date", "timestamp") else "k"
    left = spark.range(400).selectExpr("id", "cast(if(id < 300, 7, id % 50) as int) as k").selectExpr("id", f"cast({day} as {kind}) as k")
    right = spark.range(50).selectExpr("cast(id as int) as k").selectExpr(f"cast({day} as {kind}) as k", "k as v")
    got = skew_safe_left_join(left, right, ["k"], ["id"]).collect()
    assert {r.id: r.v for r in got} == {i: 7 if i < 300 else i % 50 for i in range(400)}


def test_hot_key_with_several_matches_fails(spark):
    left = spark.range(400).selectExpr("id", "cast(1 as bigint) as k")
    right = spark.createDataFrame([(1, "a"), (1, "b")], "k bigint, v string")
    with pytest.raises(Exception, match="several rows of a key"):
        skew_safe_left_join(left, right, ["k"], ["id"]).collect()


def test_key_that_cannot_be_spread_is_named(spark):
    left = spark.range(4).selectExpr("id", "array(id) as k")
    with pytest.raises(TypeError, match="array"):
        skew_safe_left_join(left, left.select("k", "id"), ["k"], ["id"])


def test_positions_number_rows_of_every_group_whatever_the_partitioning(spark):
    rows = [("x", i // 50, i) for i in range(300)] + [("y", 0, 1), (None, 2, 2), (None, 1, 3)]
    df = spark.createDataFrame(rows, "k string, at int, id int").repartition(5)
    got = {(r.k, r.id): r.n for r in positions(df, ["at", "id"], "n", ["k"]).collect()}
    assert got == {("x", i): i + 1 for i in range(300)} | {("y", 1): 1, (None, 3): 1, (None, 2): 2}
    assert [r.n for r in positions(df.where("k = 'x'"), ["at", "id"], "n").orderBy("id").collect()] == list(range(1, 301))
    assert positions(df.limit(0), ["at", "id"]).count() == 0


def test_comparing_only_repeated_keys_gives_the_same_rows(spark):
    import random

    from clickloom.operators import dedup_latest, dedup_latest_rare

    rnd = random.Random(5)
    rows = [(rnd.choice(["hot", None, *[f"k{i}" for i in range(60)]]), rnd.choice([1, 2]), rnd.choice([None, 1, 2, 3]), rnd.choice("xyz"))
            for _ in range(150)]
    rows += [("hot", 1, 3, rnd.choice("xyz")) for _ in range(80)] + [("late", 1, None, "x"), ("late", 1, None, "y")]
    df = spark.createDataFrame(rows, "k string, part int, at int, v string").repartition(5)
    for keys in (["k"], ["k", "part"]):
        want = sorted(map(tuple, dedup_latest(df, keys, "at").collect()), key=repr)
        assert sorted(map(tuple, dedup_latest_rare(df, keys, "at").collect()), key=repr) == want
    assert dedup_latest_rare(df.limit(0), ["k"], "at").count() == 0


def test_unique_keys_are_neither_sorted_nor_compared(spark, feeds):
    from clickloom.plans.staging import stg_ad_impressions

    staged = stg_ad_impressions(feeds.impressions)
    staged.collect()
    plan = staged._jdf.queryExecution().executedPlan()
    final = plan.toString().split("== Initial Plan ==")[0]
    once, again = final[final.index("Union"):].split("isnull(_n", 1)[0], final
    # The branch of unique keys holds no aggregate of rows; that of repeated ones has the only two.
    assert "SortAggregate" not in once and again.count("SortAggregate") == 2
    # Wide rows are shuffled once for both branches.
    assert "ReusedExchange" in final
