import json

import pytest

from clickloom.quality import (
    CHECKPOINTS,
    SUITES,
    Suite,
    check,
    checkpoint,
    integrity_suites,
    sample_rows,
    suite_statistics,
    totals,
    unexpected_values,
    validate,
)
from clickloom.quality.expectations import CLICKS_HAVE_IMPRESSIONS, suite
from tests.rows import rows_of


@pytest.fixture(scope="module")
def df(spark):
    rows = [("a", 1, "C001"), ("a", 5, "xC0012"), ("b", None, "D1"), (None, 9, None)]
    return spark.createDataFrame(rows, "k string, n int, c string")


def outcome(df, expectation, **kw):
    row = validate(df, suite("s", "d", expectation), **kw).first()
    return row.success, row.missing_count, row.unexpected_count, row.unexpected_percent


@pytest.mark.parametrize("expectation, expected", [
    (check.not_null("n")[0], (False, 1, 1, 25.0)),
    (check.not_null("zero")[0], (False, None, None, None)),
    (check.unique("k"), (False, 1, 2, 66.6667)),
    (check.unique("n"), (True, 1, 0, 0.0)),
    (check.in_set("k", ["a"]), (False, 1, 1, 33.3333)),
    (check.in_set("k", ["a", "b"]), (True, 1, 0, 0.0)),
    (check.between("n", 1, 5), (False, 1, 1, 33.3333)),
    (check.between("n", 1, 5, mostly=0.6), (True, 1, 1, 33.3333)),
    (check.between("n", 1), (True, 1, 0, 0.0)),
    (check.matches("c", r"C\d{3}"), (False, 1, 1, 33.3333)),  # unanchored: xC0012 passes
    (check.positive("n"), (True, 1, 0, 0.0)),
    (check.rows_between(4), (True, None, None, None)),
    (check.rows_between(None, 3), (False, None, None, None)),
    (check.rows_above(4), (False, None, None, None)),
    (check.exist("k")[0], (True, None, None, None)),
    (check.exist("zero")[0], (False, None, None, None)),
])
def test_each_check(df, expectation, expected):
    assert outcome(df, expectation) == expected


def test_positive_rejects_zero(spark):
    assert outcome(spark.createDataFrame([(0,), (1,)], "n int"), check.positive("n"))[:3] == (False, 0, 1)


def test_empty_table_passes_value_checks(spark):
    empty = spark.createDataFrame([], "k string")
    assert outcome(empty, check.unique("k")) == (True, 0, 0, 0.0)
    assert outcome(empty, check.not_null("k")[0]) == (True, 0, 0, 0.0)
    assert outcome(empty, check.rows_above(0))[0] is False


def test_suite_sizes():
    assert [len(s.expectations) for s in SUITES.values()] == [19, 17, 16, 11]
    assert [len(c) for c in CHECKPOINTS.values()] == [3, 1]


def test_clean_rows_pass_and_dirty_rows_fail(spark):
    from tests.rows import raw

    good = raw(spark, "raw_clicks", [{"click_id": "k1", "channel": "SEO"}, {"click_id": "k2", "channel": "Email"}])
    results = validate(good, SUITES["raw_clicks_suite"])
    assert rows_of(results.filter("not success"), "expectation_type") == [("expect_table_row_count_to_be_between",)]
    bad = raw(spark, "raw_clicks", [{"click_id": "k1", "channel": "seo", "cost_micros": -1}] * 2)
    failed = {r.expectation_type for r in validate(bad, SUITES["raw_clicks_suite"]).filter("not success").collect()}
    assert failed == {"expect_table_row_count_to_be_between", "expect_column_values_to_be_unique",
                      "expect_column_values_to_be_in_set", "expect_column_values_to_be_between"}


def test_one_scan_serves_all_fused_checks(spark, feeds):
    from clickloom.quality.suites import MART_DASHBOARD_SUITE

    frame = spark.createDataFrame([], "date date, channel string, spend_euros double, revenue_euros double, "
                                      "ctr_pct double, conversion_rate_pct double")
    plan = validate(frame, MART_DASHBOARD_SUITE)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


def test_batches_are_validated_separately(spark):
    df = spark.createDataFrame([("x", "a"), ("x", "a"), ("y", "a"), ("y", "b")], "batch string, k string")
    got = validate(df, suite("s", "d", check.unique("k"), check.rows_above(1)), by=["batch"])
    assert rows_of(got, "batch", "check_no", "success") == [
        ("x", 1, False), ("x", 2, True), ("y", 1, True), ("y", 2, True)]


def test_references(spark):
    clicks = spark.createDataFrame([("i1", 1), ("i1", 0), ("gone", 2)], "impression_id string, cost_micros bigint")
    tables = {"raw_clicks": clicks, "raw_ad_impressions": spark.createDataFrame([("i1",), ("i1",)], "impression_id string")}
    got = validate(clicks, integrity_suites()[1], references=tables)
    assert rows_of(got, "success", "unexpected_count", "unexpected_percent") == [
        (False, 1, 33.3333), (False, 1, 33.3333)]
    examples = unexpected_values(clicks, check.references(CLICKS_HAVE_IMPRESSIONS), references=tables)
    assert rows_of(examples, "impression_id", "n") == [("gone", 1)]


def test_unexpected_values(df):
    assert rows_of(unexpected_values(df, check.between("n", 0, 4)), "*") == [(5, 1), (9, 1)]
    assert rows_of(unexpected_values(df, check.unique("k")), "*") == [("a", 2)]
    assert unexpected_values(df, check.between("n", 100), limit=2).count() == 2


def test_statistics_and_totals(df):
    suites = [suite("s1", "d", check.rows_above(0), check.unique("k")), suite("s2", "d", check.rows_above(0))]
    results = checkpoint(suites, {"d": df})
    assert rows_of(suite_statistics(results), "suite_name", "evaluated_expectations", "successful_expectations",
                   "unsuccessful_expectations", "success_percent", "success") == [
        ("s1", 2, 1, 1, 50.0, False), ("s2", 1, 1, 0, 100.0, True)]
    assert tuple(totals(results).first()) == (3, 2, 1, False)


def test_sample_is_exact_and_repeatable(spark):
    # A third of the rows are copies of one another; they are drawn like any other rows.
    big = spark.range(30_000).repartition(7).selectExpr("if(id % 3 = 0, 'same', cast(id as string)) as k")
    a = rows_of(sample_rows(big, 300), "k")
    assert len(a) == 300
    assert a == rows_of(sample_rows(big, 300), "k")
    assert rows_of(sample_rows(big, 300, seed=7), "k") != a
    assert sample_rows(big.limit(5), 300).count() == 5
    assert sample_rows(big.limit(500), 300).count() == 300


def test_sample_takes_identical_rows_by_their_share_on_any_partitioning(spark):
    df = spark.range(3000).selectExpr("if(id % 3 = 0, 'same', cast(id as string)) as k", "if(id % 6 = 0, null, 1) as v")
    for seed in (1, 2, 3):
        taken = rows_of(sample_rows(df, 300, seed), "k")
        assert 60 <= sum(r == ("same",) or r == "same" for r in taken) <= 140
        assert taken == rows_of(sample_rows(df.repartition(7), 300, seed), "k")


def test_samples_skip_row_counts(df):
    got = validate(df, suite("s", "d", check.rows_between(1000), check.unique("n")), sampled=True)
    assert rows_of(got, "check_no", "success") == [(2, True)]


def test_suite_from_json(df):
    text = json.dumps({"expectation_suite_name": "j", "expectations": [
        {"expectation_type": "expect_column_values_to_be_between",
         "kwargs": {"column": "n", "min_value": 1, "max_value": None, "mostly": 1.0}},
        {"expectation_type": "expect_table_row_count_to_be_greater_than", "kwargs": {"value": 3}}]})
    loaded = Suite.from_json(text, "d")
    assert rows_of(validate(df, loaded), "suite_name", "success") == [("j", True), ("j", True)]
    assert loaded.expectations[0].kwargs == {"column": "n", "min_value": "1", "mostly": "1.0"}
