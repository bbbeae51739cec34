from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratamart.operators import profile, rules
from stratamart.operators.rules import (
    REASONS,
    rule_failures,
    split,
    split_summary,
    tag,
    trip_rules,
)
from stratamart.settings import STUDY, StudyRange

SCHEMA = (
    "VendorID long, passenger_count long, total_amount double, "
    "pickup_datetime timestamp, dropoff_datetime timestamp"
)
CLEAN = (6, 5, 0.25, "2023-03-27 12:05:00", "2023-03-27 12:09:30")
NO_COUNT = (7, None, 88.0, "2023-02-11 23:41:07", "2023-02-12 00:19:58")
TOO_EARLY = (2, 3, 7.5, "2022-11-05 06:00:00", "2022-11-05 06:45:00")


def frame(spark, *rows):
    texts = spark.createDataFrame(
        list(rows),
        "VendorID long, passenger_count long, total_amount double, p string, d string",
    )
    return texts.selectExpr(
        "VendorID",
        "passenger_count",
        "total_amount",
        "CAST(p AS TIMESTAMP) AS pickup_datetime",
        "CAST(d AS TIMESTAMP) AS dropoff_datetime",
    )


def broken(spark, row):
    _, rejected = split(frame(spark, row), trip_rules(STUDY))
    return rejected.first()[REASONS]


def test_rows_are_routed(spark):
    clean, rejected = split(frame(spark, CLEAN, NO_COUNT), trip_rules(STUDY))
    assert clean.count() == 1 and rejected.count() == 1
    assert rejected.first()[REASONS] == ["passenger_count_not_null", "passenger_count_positive"]
    assert rejected.first()._quarantined_at is not None


def test_out_of_range_rows_are_named(spark):
    assert broken(spark, TOO_EARLY) == ["pickup_in_study_range"]


def test_bounds_of_the_rules(spark):
    start = (1, 1, 0.0, "2023-01-01 00:00:00", "2023-01-01 00:00:01")
    end = (1, 1, 0.0, "2023-06-01 00:00:00", "2023-06-01 00:00:01")
    instant = (1, 1, 0.0, "2023-05-01 00:00:00", "2023-05-01 00:00:00")
    clean, _ = split(frame(spark, start), trip_rules(STUDY))
    assert clean.count() == 1
    assert broken(spark, end) == ["pickup_in_study_range"]
    assert broken(spark, instant) == ["dropoff_after_pickup"]


def test_an_empty_row_breaks_everything(spark):
    names = [name for name, _ in trip_rules(STUDY)]
    assert broken(spark, (None, None, None, None, None)) == names


times = st.one_of(
    st.none(), st.sampled_from(["2022-12-31 23:59:59", "2023-01-01", "2023-03-01", "2023-06-01"])
)
some_rows = st.lists(
    st.tuples(
        st.one_of(st.none(), st.integers(1, 7)),
        st.one_of(st.none(), st.integers(-1, 2)),
        st.one_of(st.none(), st.sampled_from([-1.0, 0.0, 2.5])),
        times,
        times,
    ),
    min_size=1,
    max_size=20,
)


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(rows=some_rows)
def test_the_split_is_a_partition(spark, rows):
    df, rules = frame(spark, *rows), trip_rules(STUDY)
    clean, rejected = split(df, rules)
    tagged = tag(df, rules)
    assert clean.count() + rejected.count() == len(rows)
    assert clean.exceptAll(tagged.filter(f"size({REASONS}) = 0").drop(REASONS)).isEmpty()
    assert rejected.filter(f"size({REASONS}) = 0").isEmpty()
    back = clean.unionByName(rejected.select(*clean.columns))
    assert back.exceptAll(df).isEmpty() and df.exceptAll(back).isEmpty()


def test_summary_and_failures(spark):
    df = frame(spark, CLEAN, NO_COUNT, TOO_EARLY, CLEAN)
    summary = split_summary(df, trip_rules(STUDY)).first()
    assert (summary.rows_in, summary.rows_clean, summary.rows_quarantine) == (4, 2, 2)
    assert summary.quarantine_pct == 50.0
    assert split_summary(df.limit(0), trip_rules(STUDY)).first().quarantine_pct == 0.0
    failed = {r.rule: r.failed_rows for r in rule_failures(df, trip_rules(STUDY)).collect()}
    assert failed["passenger_count_not_null"] == failed["pickup_in_study_range"] == 1
    assert failed["vendor_not_null"] == 0


def test_the_clean_side_reaches_the_scan(spark, small):
    """Range bounds on a plain column are pushed down to Parquet."""
    df = spark.read.parquet(f"{small}/orders.parquet").selectExpr(
        "CAST(o_orderdate AS TIMESTAMP) AS pickup_datetime"
    )
    rule = [r for r in trip_rules(StudyRange(date(1996, 1, 1), date(1996, 2, 1)))][-1:]
    plan = split(df, rule)[0]._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan


def test_masks_name_the_same_rules(spark):
    tests = [(f"r{i}", F.col("n") != i) for i in range(40)] + [("known", F.col("n").isNotNull())]
    df = spark.createDataFrame([(i,) for i in range(41)] + [(None,)], "n int")
    found = df.select("n", rules.named(rules.mask(tests), tests).alias("names"), rules.reasons(tests).alias("wanted")).collect()
    assert all(r.names == r.wanted for r in found) and [r.names for r in found if r.n == 39] == [["r39"]]
    with pytest.raises(ValueError, match="63 rules"):
        rules.mask(tests * 2)


def test_reasons_travel_as_numbers(spark):
    tests = [("small", F.col("n") < 5), ("even", F.col("n") % 2 == 0)]
    df = spark.range(12).selectExpr("id AS n", "'a' AS taxi_type")
    counted = profile.reason_counts_by_mask(df, tests)
    assert [(r[1], r[2]) for r in counted.collect()] in (
        [(["small", "even"], 4), (["small"], 3), (["even"], 2)],
    )
    plan = counted._jdf.queryExecution().executedPlan().toString()
    exchange = plan[plan.index("hashpartitioning") :]
    assert "array" not in exchange
