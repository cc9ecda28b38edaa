"""Registered queries: against SQL, and the shape of their plans."""

from __future__ import annotations

import os
import re

import pytest

import __spark_entry__ as entry_points
from casetally.oracle import ORACLE
from casetally.queries import QUERIES
from compare import differences, duckdb_connection

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    connection = duckdb_connection(SF_DIR)
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_all_are_registered():
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLE) <= set(entry_points.oracle_sql())


def test_building_a_query_runs_no_job(spark):
    tracker, ran = spark.sparkContext.statusTracker(), []
    for name, run in QUERIES.items():
        spark.sparkContext.setJobGroup(f"build-{name}", name)
        run(spark, SF_DIR)
        if tracker.getJobIdsForGroup(f"build-{name}"):
            ran.append(name)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert ran == []


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.count() > 0 and "resol_vencidas" in df.columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_against_sql(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    physical = df._jdf.queryExecution().sparkPlan().toString()
    assert not re.search(r"CartesianProduct|NestedLoopJoin|Python|InPandas|Arrow", physical)
    assert "Join Cross" not in plan
    assert differences(df, con, ORACLE[name]) == []


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield spark
    spark.conf.set(key, old)


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_rulings_read_the_cases_once(no_broadcast):
    df = QUERIES["rulings_monthly"](no_broadcast, SF_DIR)
    physical = df._jdf.queryExecution().sparkPlan().toString()
    assert len(re.findall(r"FileScan.*lineitem\.parquet", physical)) == 1
    scan = next(l for l in physical.splitlines() if "lineitem.parquet" in l)
    assert "GreaterThanOrEqual(l_shipdate" in scan
    assert "l_extendedprice" not in scan and "l_comment" not in scan


def test_cases_are_never_shuffled_by_court(no_broadcast):
    """Without any broadcast the only shuffles of cases are on the order key."""
    df = QUERIES["rulings_range"](no_broadcast, SF_DIR)
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = {i: len(l) - len(l.lstrip(" :+-*")) for i, l in enumerate(lines)}
    at = next(i for i, l in enumerate(lines) if "lineitem.parquet" in l)
    above, level = [], depth[at]
    for i in range(at, -1, -1):
        if depth[i] < level or i == at:
            level = depth[i]
            above.append(lines[i])
            if "partial_count" in lines[i]:
                break
    shuffles = [l for l in above if "Exchange" in l]
    assert len(shuffles) == 1 and "l_orderkey" in shuffles[0]


def test_a_plain_listing_is_one_pass(no_broadcast):
    df = QUERIES["case_listing_some_courts"](no_broadcast, SF_DIR)
    physical = df._jdf.queryExecution().sparkPlan().toString()
    assert len(re.findall(r"FileScan.*lineitem\.parquet", physical)) == 1
    assert "Expand" not in physical and "Union" not in physical


def test_cases_are_not_doubled(spark):
    """Grouping sets stand above the first counts, not above the scan."""
    plan = QUERIES["rulings_monthly"](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    expand = next(i for i, l in enumerate(lines) if "Expand" in l)
    assert any("Aggregate" in l for l in lines[expand + 1 :])


def test_printed_lists_are_neither_aggregated_nor_shuffled_again(no_broadcast):
    df = QUERIES["submission_tracking_parts"](no_broadcast, SF_DIR)
    lines = df._jdf.queryExecution().sparkPlan().toString().splitlines()
    # The union stands right on the aggregate that makes the text.
    assert lines[0].startswith("Union") and "collect_list" in lines[1]
    assert not [l for l in lines if "Expand" in l or "first(" in l]


def test_median_counts_days_first(spark):
    plan = QUERIES["median_duration_monthly"](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    outer, inner = [l for l in plan.splitlines() if "Aggregate" in l][:2]
    assert "percentile(duracion" in outer and "count(1)" in inner and "percentile" not in inner
