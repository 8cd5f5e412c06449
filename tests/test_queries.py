"""Every query against its SQL on the smallest data, and the shape of its plan."""

import os
import re

import pytest

import __spark_entry__ as entry
import check
from alertloom.queries.catalog import QUERIES
from alertloom.queries.oracle import ORACLE

FOLDER = "/root/testdata/sf0.001"
GENERATED = {
    "generate_text_batch",
    "generate_double_batch",
    "generate_table_batch",
    "alert_analysis_backend",
}
STREAMED = {"stream_new_only", "stream_to_table"}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def connection():
    return check.database(FOLDER)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_same_as_sql(spark, connection, name):
    assert check.compare(spark, connection, FOLDER, name) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - GENERATED - STREAMED))
def test_plan_stays_in_the_jvm_without_cross_joins(spark, name):
    plan = entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Python|MapInPandas|ArrowEval", plan)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_flagship_is_one_pushed_down_scan_without_a_shuffle(spark):
    df = entry.queries()["alert_analysis"](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("FileScan") == 1
    assert "user_id" in plan and "value" not in plan.split("ReadSchema")[1].split(">")[0]


def test_caps_cut_rows_before_the_shuffle(spark):
    for name in ("cap_per_term", "first_wins"):
        plan = entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("WindowGroupLimit") == (4 if name == "cap_per_term" else 2)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
