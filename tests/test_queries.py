"""Every registered query against its SQL oracle, and rules that every plan must keep."""

from __future__ import annotations

import re

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from workload.oracle import ORACLE
from workload.queries import QUERIES
from tests.comparison import compare, duck

FOLDER = "/root/testdata/sf0.001"
# These write files or tables while the query is built; their plans are those of a plain scan.
WRITERS = {
    "places_csv",
    "mapping_table",
    "landed_files",
    "landed_files_by_line",
    "landed_line_breaks",
    "landed_line_breaks_by_line",
    "obs_upsert_table",
    "backfill_by_bucket",
    "first_missing_date_indexed",
    "fetch_ranges_indexed",
    "gap_report_indexed",
    "index_differences",
    "daily_load",
    "load_summary",
    "landed_load",
    "streamed_load",
    "streamed_attempts",
}


@pytest.fixture(scope="module")
def connection():
    with duck(FOLDER) as connection:
        yield connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_oracle(spark, connection, name):
    rows, only_spark, only_oracle = compare(queries()[name](spark, FOLDER), connection, oracle_sql()[name])
    assert rows > 0
    assert not only_spark and not only_oracle, (only_spark.most_common(2), only_oracle.most_common(2))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITERS))
def test_plan_rules(spark, name):
    """No cross or nested-loop join, no Python in a plan, no hinted broadcast, no window over a whole table."""
    execution = queries()[name](spark, FOLDER)._jdf.queryExecution()
    plan = execution.executedPlan().toString()
    for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert banned not in plan
    assert "strategy=broadcast" not in execution.analyzed().toString()


def test_scans_read_only_the_columns_they_need(spark):
    def schemas(name):
        plan = queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        return set(re.findall(r"ReadSchema: struct<([^>]*)>", plan))

    assert schemas("first_missing_date") == {
        "c_custkey:bigint,c_nationkey:int",
        "ts:timestamp_ntz,user_id:bigint",
    }
    assert schemas("dq_coverage") == {"c_custkey:bigint", "user_id:bigint"}


def test_entry(spark):
    flagship = entry(spark)
    assert flagship.count() > 0 and "distance" in flagship.columns
