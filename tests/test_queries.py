import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as driver  # noqa: E402
from check_oracles import compare, connect  # noqa: E402

from stratamart.plans.queries import QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, small, name):
    same, text = compare(spark, con, name, small)
    assert same, text


def test_entry(spark):
    assert driver.entry(spark).columns == ["pickup_hour", "avg_passengers", "trip_count"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["q2_hourly_mean", "null_profile", "fact_trip", "quarantine_by_reason"])
def test_events_are_scanned_once(spark, small, name):
    assert plan_of(QUERIES[name](spark, small)).count("FileScan parquet") == 1


def test_vendors_need_no_payload(spark, small):
    plan = plan_of(QUERIES["dim_vendor"](spark, small))
    assert "LocalTableScan" in plan and "props" not in plan
