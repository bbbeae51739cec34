from datetime import date, datetime, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stratamart.contracts import AGG_HOURLY_DAILY, AGG_MONTHLY_TAXI, DIM_DATE, FACT_TRIP
from stratamart.operators import dims, facts, marts
from stratamart.settings import STUDY, StudyRange

FACT_COLUMNS = (
    "tripsk string, date_key int, vendor_id int, passenger_count int, total_amount decimal(10,2), "
    "pickup_datetime timestamp, dropoff_datetime timestamp, duration_seconds long, "
    "taxi_type string, _ingestion_ts timestamp"
)


def at(month, day, hour, minute=0, year=2023):
    return datetime(year, month, day, hour, minute, tzinfo=timezone.utc)


def two_trips(spark):
    now = at(9, 3, 4, year=2024)
    return spark.createDataFrame(
        [
            ("k-night", 20230314, 7, 3, Decimal("41.30"), at(3, 14, 23, 50), at(3, 15, 0, 31), 2460, "yellow", now),
            ("k-noon", 20230327, 2, 6, Decimal("8.75"), at(3, 27, 12, 5), at(3, 27, 12, 9), 240, "yellow", now),
        ],
        FACT_COLUMNS,
    )


def test_monthly_mart(spark):
    row = marts.monthly(two_trips(spark)).first()
    assert (row.month_key, row.year, row.month, row.taxi_type) == (202303, 2023, 3, "yellow")
    assert (row.trip_count, row.passenger_count_sum) == (2, 9)
    assert row.total_amount_sum == Decimal("50.05")
    assert (row.avg_total_amount, row.avg_passenger_count) == (25.03, 4.5)


def test_marts_have_their_contract_types(spark):
    hourly = marts.hourly_daily(two_trips(spark))
    for df, contract in (
        (hourly, AGG_HOURLY_DAILY),
        (marts.monthly(two_trips(spark)), AGG_MONTHLY_TAXI),
        (marts.monthly_from_hourly(hourly), AGG_MONTHLY_TAXI),
        (dims.study_calendar(spark, STUDY), DIM_DATE),
    ):
        assert [(f.name, f.dataType) for f in df.schema] == [
            (f.name, f.dataType) for f in contract.schema
        ]


def test_rollup_equals_direct_aggregation(spark):
    amounts = ["0.00", "0.01", "1.00", "2.005", "33.33", "-7.77", "99999999.99"]
    rows = spark.range(5000).select(
        F.expr("date_add(DATE '2023-01-01', CAST(id % 120 AS INT))").alias("day"),
        F.element_at(
            F.array(*(F.lit(a) for a in amounts)), (F.col("id") * 7 % 7 + F.col("id") % 5 % 7 + 1).cast("int")
        )
        .cast("decimal(10,2)")
        .alias("total_amount"),
        (F.col("id") % 6).cast("int").alias("passenger_count"),
        F.when(F.col("id") % 3 == 0, "green").otherwise("yellow").alias("taxi_type"),
    )
    fact = rows.select(
        "*",
        F.date_format("day", "yyyyMMdd").cast("int").alias("date_key"),
        F.col("day").cast("timestamp").alias("pickup_datetime"),
    )
    direct = marts.monthly(fact)
    rolled = marts.monthly_from_hourly(marts.hourly_daily(fact))
    assert direct.exceptAll(rolled).isEmpty() and rolled.exceptAll(direct).isEmpty()
    assert direct.count() == 8


@pytest.mark.parametrize("total, n", [("0.05", 10), ("-0.05", 10), ("1.00", 3), ("0.01", 8), ("20.01", 2000000)])
def test_decimal_mean_is_sparks(spark, total, n):
    share = spark.sql(
        f"SELECT CAST(round(CAST(CAST('{total}' AS DECIMAL(28,2)) / {n} AS DECIMAL(14,6)), 2) AS DOUBLE)"
    ).first()[0]
    row = spark.sql(f"SELECT CAST('{total}' AS DECIMAL(18,2)) AS s, CAST({n} AS BIGINT) AS n")
    assert row.select(marts.decimal_mean("s", "n")).first()[0] == share


def test_questions_agree_with_the_fact(spark):
    fact, dates = two_trips(spark), dims.study_calendar(spark, STUDY)
    hourly, monthly = marts.hourly_daily(fact), marts.monthly(fact)
    assert (
        marts.hourly_passengers(hourly, dates, 2023, 3).collect()
        == marts.hourly_passengers_from_fact(fact, dates, 2023, 3).collect()
    )
    assert (
        marts.monthly_mean(monthly, "yellow").collect()
        == marts.monthly_mean_from_fact(fact, dates, "yellow").collect()
    )
    assert marts.monthly_mean(monthly, "green").isEmpty()
    assert marts.hourly_passengers(hourly, dates, 2023, 4).isEmpty()


def test_calendar(spark):
    days = dims.study_calendar(spark, STUDY)
    assert days.count() == STUDY.days == 151
    first = days.orderBy("date_key").first()
    assert (first.date_key, first.full_date) == (20230101, date(2023, 1, 1))
    # A Sunday in the last ISO week of the year before.
    assert (first.day_of_week, first.week_of_year, first.is_weekend) == (1, 52, True)
    assert days.filter("is_weekend").count() == 43


def test_vendors(spark):
    assert [r.vendor_id for r in dims.vendors(spark).orderBy("vendor_id").collect()] == [1, 2, 6, 7]


def silver(spark):
    return spark.createDataFrame(
        [
            (1, 2, Decimal("5.00"), at(1, 1, 0), at(1, 1, 0, 1), "k1", at(1, 1, 0)),
            (1, 2, Decimal("5.00"), at(6, 1, 0), at(6, 1, 1), "k2", at(1, 1, 0)),
        ],
        "VendorID int, passenger_count int, total_amount decimal(10,2), pickup_datetime timestamp, "
        "dropoff_datetime timestamp, tripsk string, _ingestion_ts timestamp",
    )


def test_fact_rows(spark):
    rows = facts.fact_rows(silver(spark), "green", STUDY)
    assert [(f.name, f.dataType) for f in rows.schema] == [
        (f.name, f.dataType) for f in FACT_TRIP.schema
    ]
    (row,) = rows.collect()
    assert (row.tripsk, row.date_key, row.duration_seconds, row.taxi_type) == (
        "k1",
        20230101,
        60,
        "green",
    )


def test_union_needs_a_source_and_prunes_by_name(spark):
    with pytest.raises(ValueError):
        facts.union_facts({}, STUDY)
    study = StudyRange(date(2023, 1, 1), date(2024, 1, 1))
    both = facts.union_facts({"yellow": silver(spark), "green": silver(spark)}, study)
    assert both.count() == 4
    plan = both.filter("taxi_type = 'green'")._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan
