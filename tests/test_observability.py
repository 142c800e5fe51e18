import datetime as dt

import pytest
from pyspark.sql import functions as F

from clickloom import observability as O
from clickloom.quality import check, validate
from clickloom.quality.expectations import suite
from tests.rows import rows_of, ts

NOW = dt.datetime(2024, 5, 1, 12)


def run_rows(spark):
    """Runs of two suites over several days, from real validations."""
    s1 = suite("s1", "d1", check.rows_above(1), check.unique("k"))
    s2 = suite("s2", "d2", check.rows_above(1))
    df = spark.createDataFrame([
        ("2024-04-30", "a"), ("2024-04-30", "b"), ("2024-04-29", "a"), ("2024-04-29", "a"), ("2024-03-01", "z"),
    ], "day string, k string")
    at = F.col("day").cast("timestamp")
    return O.run_records(validate(df, s1, by=["day"]), s1, at, by=["day"]).unionByName(
        O.run_records(validate(df, s2, by=["day"]), s2, at, by=["day"]))


def test_run_records(spark):
    first = run_rows(spark).filter("suite_name = 's1' and timestamp = '2024-04-29'").first()
    assert (first.success, first.row_count, first.total_expectations, first.passed, first.failed) == (False, 2, 2, 1, 1)
    assert [e.expectation_type for e in first.expectations] == [
        "expect_table_row_count_to_be_greater_than", "expect_column_values_to_be_unique"]
    assert first.expectations[1].kwargs == {"column": "k"}
    assert first.expectations[1].result["unexpected_count"] == "2"


def test_get_runs(spark):
    runs = run_rows(spark)
    assert [(r.suite_name, r.timestamp.day) for r in O.get_runs(runs, limit=3).collect()] == [
        ("s1", 30), ("s2", 30), ("s1", 29)]
    assert O.get_runs(runs, "s1", since=dt.datetime(2024, 4, 1)).count() == 2
    assert O.get_runs(runs).count() == 6


def test_pass_rate_trend_and_target(spark):
    trend = O.pass_rate_trend(run_rows(spark), NOW, days=30)
    assert rows_of(O.pass_rate_target(trend), "date", "pass_rate", "total_runs", "passed", "failed", "target_status") == [
        (dt.date(2024, 4, 29), 50.0, 2, 1, 1, "missed"), (dt.date(2024, 4, 30), 100.0, 2, 2, 0, "met")]


def test_latest_by_suite(spark):
    assert rows_of(O.latest_by_suite(run_rows(spark)), "suite_name", "timestamp", "success") == [
        ("s1", ts("2024-04-30"), True), ("s2", ts("2024-04-30"), True)]


def test_failure_details(spark):
    got = [(r.timestamp.day, r.suite, r.expectation[-9:], r.column) for r in O.failure_details(run_rows(spark)).collect()]
    assert got == [(29, "s1", "be_unique", "k"), (1, "s1", "ater_than", ""), (1, "s2", "ater_than", "")]
    assert O.failure_details(run_rows(spark), limit=2).count() == 0  # the two newest runs passed
    assert O.failure_details(run_rows(spark), "s2").count() == 1


def volumes(spark, counts, **kw):
    rows = [("d", dt.datetime(2024, 1, i + 1), c) for i, c in enumerate(counts)]
    history = spark.createDataFrame(rows, "dataset string, timestamp timestamp, row_count bigint")
    return [tuple(r) for r in O.evaluate_volume(history, **kw).orderBy("timestamp").select(
        "change_from_previous_pct", "anomaly_detected", "status").collect()]


def test_volume(spark):
    assert volumes(spark, [0, 1000, 1500, 2252]) == [
        (None, False, "ok"), (None, False, "ok"), (50.0, False, "ok"), (50.1, True, "ok")]
    assert volumes(spark, [1000, 400], expected_min=500)[1] == (-60.0, True, "warning")
    assert volumes(spark, [10, 20], expected_max=15)[1][2] == "warning"
    assert volumes(spark, [10, 20], expected_max=0)[1][2] == "ok"  # zero means no maximum
    assert volumes(spark, [10, 20, 10], lag=2)[2][0] == 0.0


def test_freshness_bounds(spark):
    ages = [90.0, 90.1, 180.0, 180.1]
    rows = [(str(a), NOW - dt.timedelta(minutes=a)) for a in ages]
    latest = spark.createDataFrame(rows, "dataset string, latest_data_timestamp timestamp")
    got = rows_of(O.freshness_metric(latest, NOW), "dataset", "staleness_minutes", "status")
    assert got == [("180.0", 180.0, "stale"), ("180.1", 180.1, "critical"), ("90.0", 90.0, "fresh"),
                   ("90.1", 90.1, "stale")]


def test_latest_timestamp(spark):
    df = spark.createDataFrame([(1, dt.date(2024, 1, 2), ts("2024-05-01")), (2, dt.date(2024, 1, 3), ts("2024-04-01"))],
                               "id int, start_date date, timestamp timestamp")
    assert O.latest_timestamp(df).first()[0] == ts("2024-01-03")  # the first such column
    assert O.latest_timestamp(df.select("id")) is None


def test_schema_drift(spark):
    history = spark.createDataFrame([
        ("d", ts("2024-01-01"), {"a": "int", "b": "int", "c": "int"}),
        ("d", ts("2024-01-02"), {"a": "int", "b": "string", "e": "int"}),
        ("d", ts("2024-01-03"), {"a": "int", "b": "string", "e": "int"}),
    ], "dataset string, timestamp timestamp, schema_columns map<string,string>")
    got = [(r.column_count, tuple(r.drift), r.status) for r in O.evaluate_schema(history).orderBy("timestamp").collect()]
    assert got == [(3, ([], [], [], False), "ok"), (3, (["e"], ["c"], ["b"], True), "drifted"),
                   (3, ([], [], [], False), "ok")]
    assert O.evaluate_schema(history, lag=2).orderBy(F.desc("timestamp")).first().status == "drifted"


def test_null_rates(spark):
    df = spark.range(10000).select(F.when(F.col("id") >= 500, 1).alias("at"), F.when(F.col("id") >= 501, 1).alias("over"))
    rates = O.null_rates(df, "d")
    assert rows_of(rates, "column", "null_count", "null_rate_pct", "flagged") == [
        ("at", 500, 5.0, False), ("over", 501, 5.01, True)]
    record = O.evaluate_nulls(rates, F.lit(NOW)).first()
    assert (record.total_rows, record.flagged_columns, record.status) == (10000, ["over"], "warning")
    assert record.null_columns["at"].null_count == 500
    assert O.evaluate_nulls(O.null_rates(df.filter("false"), "d"), F.lit(NOW)).first().status == "ok"


def test_health_summary(spark):
    rows = [
        ("a", "freshness", ts("2024-01-01"), "critical"), ("a", "freshness", ts("2024-01-02"), "fresh"),
        ("a", "volume", ts("2024-01-01"), "ok"),
        ("b", "schema", ts("2024-01-01"), "drifted"), ("b", "null_rates", ts("2024-01-01"), "ok"),
        ("c", "freshness", ts("2024-01-01"), "critical"), ("c", "volume", ts("2024-01-01"), "warning"),
    ]
    metrics = spark.createDataFrame(rows, "dataset string, metric string, timestamp timestamp, status string")
    assert rows_of(O.health_summary(metrics), "dataset", "overall", "freshness", "volume", "schema", "nulls") == [
        ("a", "healthy", "fresh", "ok", "unknown", "unknown"),
        ("b", "warning", "unknown", "unknown", "drifted", "ok"),
        ("c", "critical", "critical", "warning", "unknown", "unknown")]


@pytest.fixture()
def tracker(spark, tmp_path):
    return O.QualityTracker(spark, str(tmp_path / "runs"), str(tmp_path / "metrics"))


def test_tracker_round_trip(spark, tracker, tmp_path):
    assert tracker.health_bundle(now=NOW)["health_summary"].count() == 0
    s = suite("s", "d", check.rows_above(1), check.unique("k"))
    first = spark.createDataFrame([("a", ts("2024-05-01 11:00:00")), ("b", None)], "k string, timestamp timestamp")
    got = tracker.track(first, s, now=NOW)
    assert rows_of(got, "metric", "status") == [
        ("freshness", "fresh"), ("null_rates", "warning"), ("schema", "ok"), ("volume", "ok")]
    second = spark.createDataFrame([("a", 1)] * 5, "k string, extra int")
    got = tracker.track(second, s, now=NOW + dt.timedelta(hours=1))
    assert rows_of(got, "metric", "status", "change_from_previous_pct", "anomaly_detected") == [
        ("null_rates", "ok", None, None), ("schema", "drifted", None, None), ("volume", "ok", 150.0, True)]
    assert got.filter("metric = 'schema'").first().drift.removed == ["timestamp"]

    bundle = tracker.health_bundle(now=NOW + dt.timedelta(days=1))
    health = bundle["health_summary"].first()
    assert (health.overall, health.freshness, health.schema) == ("warning", "fresh", "drifted")
    assert bundle["latest_runs"].first().success is False
    assert rows_of(bundle["pass_rate_trend"], "pass_rate", "total_runs") == [(50.0, 2)]
    assert bundle["recent_failures"].first().column == "k"

    # A malformed line is no record.
    (tmp_path / "metrics" / "metric=volume" / "dataset=d" / "broken.json").write_text("{not json\n")
    assert tracker.metrics.filter("metric = 'volume'").count() == 2


def test_cleanup_drops_old_days(spark, tracker):
    s = suite("s", "d", check.rows_above(0))
    df = spark.createDataFrame([("a",)], "k string")
    for days in (100, 91, 89, 0):
        tracker.track(df, s, now=NOW - dt.timedelta(days=days))
    assert tracker.cleanup(now=NOW) == 2
    assert tracker.runs.count() == 2
    assert O.QualityTracker(spark, "/tmp/no-such-runs-folder", "/tmp/no-such").cleanup() == 0


def test_cleanup_compares_instants_within_the_day(spark, tracker):
    s = suite("s", "d", check.rows_above(0))
    df = spark.createDataFrame([("a",)], "k string")
    for hours in (-30, -1, 0, 1):
        tracker.track(df, s, now=NOW - dt.timedelta(days=90) + dt.timedelta(hours=hours))
    assert tracker.cleanup(now=NOW) == 2
    assert tracker.runs.count() == 2
    assert tracker.cleanup(now=NOW) == 0


def test_batch_schemas_follow_the_values(spark):
    rows = [(1, "a", 1.0), (1, "b", 2.0), (2, "a", 1.5), (3, None, None)]
    df = spark.createDataFrame(rows, "day int, k string, v double").selectExpr(
        "timestamp_seconds(day * 86400) as batch", "k", "v")
    got = [r["drift"].asDict() for r in O.evaluate_schema(O.batch_schemas(df, "d", "batch")).orderBy("timestamp").collect()]
    assert [(d["added"], d["removed"], d["type_changed"]) for d in got] == [
        ([], [], []), ([], [], ["v"]), ([], ["k", "v"], [])]


def test_completeness(spark):
    from clickloom.observability import completeness, null_rates

    df = spark.createDataFrame([(1, None, None), (2, None, 3.0), (None, None, 4.0)], "a int, b string, c double")
    got = completeness(null_rates(df, "d")).first()
    assert (got.cells, got.null_cells, got.completeness_pct, got.worst_column) == (9, 5, 44.4444, "b")
    got = completeness(null_rates(df.limit(0), "d")).first()
    assert (got.cells, got.completeness_pct, got.worst_column) == (0, None, None)


def test_tracking_reads_a_table_once(spark, tracker, tmp_path):
    """Checks with a unique key, nulls, volume and freshness: one scan of the table, counted by its rows read."""
    from clickloom.quality import observe_suite
    from clickloom.quality.suites import RAW_CLICKS_SUITE
    from clickloom.schemas import RAW_CLICKS

    rows = [("a", "i", "c", "SEO", "p", ts("2024-05-01 11:00:00"), "mobile", None, 5)] * 3
    spark.createDataFrame(rows, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RAW_CLICKS.fields)).write.parquet(
        str(tmp_path / "clicks"))
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    stored = spark.read.parquet(str(tmp_path / "clicks"))
    plan = observe_suite(stored, RAW_CLICKS_SUITE, nulls_of=stored.columns, latest_of="timestamp")._jdf.queryExecution()
    assert plan.executedPlan().toString().count("FileScan") == 1
    got = tracker.track(stored.mapInArrow(count, stored.schema), RAW_CLICKS_SUITE, now=NOW)
    assert rows_of(got, "metric", "total_rows") == [("freshness", None), ("null_rates", 3), ("schema", None), ("volume", None)]
    assert read.value == 3
    run = tracker.runs.first()
    assert (run.total_expectations, run.row_count) == (len(RAW_CLICKS_SUITE.expectations), 3)


def test_observing_values_that_are_the_batch_or_missing(spark):
    from clickloom.quality.observe import observe

    df = spark.createDataFrame([(1, "a", None), (1, "a", 2), (1, None, 3), (2, "a", 3), (2, "b", None)], "b int, k string, v int")
    checks = [(1, check.unique("k")), (2, check.unique("v")), (3, check.not_null("v")[0]), (4, check.unique("b"))]
    got = {r.b: r for r in observe(df, checks, by=["b"], nulls_of=["k"], latest_of=None).collect()}
    counts = {b: [(o.element_count, o.missing_count, o.unexpected_count) for o in r.outcomes] for b, r in got.items()}
    assert counts == {1: [(3, 1, 2), (3, 1, 0), (3, 1, 1), (3, 0, 3)], 2: [(2, 0, 0), (2, 1, 0), (2, 1, 1), (2, 0, 2)]}
    assert [got[b].null_counts[0].null_count for b in (1, 2)] == [1, 0]
    whole = observe(df, checks, nulls_of=["v"]).first()
    assert [(o.missing_count, o.unexpected_count) for o in whole.outcomes] == [(1, 3), (2, 2), (2, 2), (0, 5)]
    empty = observe(df.limit(0), checks, nulls_of=["v"]).first()
    assert (empty.row_count, empty.null_counts[0].null_count, empty.outcomes[0].unexpected_count) == (0, 0, 0)
    assert observe(df.limit(0), checks, by=["b"]).count() == 0
