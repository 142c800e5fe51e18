"""Every registered query against its check SQL, and the shape of the plans."""

import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as entry_module
from registry.compare import compare, connect
from registry.oracle import oracle_sql
from registry.queries import queries as base_queries
from tests.conftest import ROOT, SF_DIR

QUERIES = base_queries()
SQL = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas",
             "FlatMapGroupsInPandas")


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_check_sql_without_multiplying_rows_or_leaving_the_jvm(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert [operator for operator in FORBIDDEN if operator in plan] == []
    assert compare(df, con, SQL[name]) == "ok"


def test_every_query_has_its_check():
    assert set(SQL) == set(QUERIES)


def test_base_queries_without_the_training_data_operators(tmp_path):
    """A tree without those two folders still gives all other queries and their checks."""
    shutil.copytree(ROOT, tmp_path / "tree", ignore=shutil.ignore_patterns("llm", ".git", "__pycache__"))
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'entry' in dir(e))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "tree", capture_output=True, text=True, timeout=120)
    assert out.stdout.split() == [str(len(QUERIES)), str(len(SQL)), "True"], out.stderr


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


def plan_of(spark, name):
    return QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


def test_scans_read_only_needed_columns(spark):
    plan = plan_of(spark, "quality_raw_conversions")
    assert "o_totalprice" not in plan and "l_extendedprice" not in plan


def test_unread_lookups_are_dropped(spark):
    """Campaign totals need neither the impression of a click nor the click of a conversion."""
    from clickloom.plans import staging
    from registry.queries import Tables

    t = Tables(spark, SF_DIR)
    feeds = t.raw
    for staged, columns in ((t.clicks, ["campaign_id", "cost_euros"]),
                            (t.conversions, ["campaign_id", "customer_id", "conversion_timestamp"])):
        plan = staged.select(*columns)._jdf.queryExecution().optimizedPlan().toString()
        # What is left is the join by which the conversions feed itself is made.
        assert plan.count("Join") == (1 if "customer_id" in columns else 0)
    assert staging.stg_clicks(feeds.clicks, feeds.impressions).count() == t.clean_clicks.count()
