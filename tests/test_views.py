from tests_support import STUDY, land_both

from stratamart.plans import jobs
from stratamart.plans.views import register_views
from stratamart.settings import YELLOW
from stratamart.sources.tables import TableStore


def test_questions_in_sql(spark, tmp_path):
    """The analyses a user runs by hand, as SQL over views and published tables."""
    landings = land_both(spark, tmp_path)
    prefix = f"v_{tmp_path.name.replace('-', '_')}"
    lake = jobs.Lake(TableStore(spark, str(tmp_path / "lake"), prefix), STUDY)
    jobs.run_all(lake, landings)
    assert register_views(lake, landings) == [
        "bronze_union",
        "silver_quarantine_union",
        "fact_trip_view",
        "landing_schema_snapshot",
    ]
    rows = lambda text: [tuple(r) for r in spark.sql(text).collect()]

    assert rows(
        """SELECT taxi_type, count(*), count_if(_rescued_data IS NOT NULL),
             count_if(passenger_count IS NULL), max(trip_distance)
           FROM bronze_union GROUP BY taxi_type ORDER BY taxi_type"""
    ) == [("green", 200, 200, 0, 199.0), ("yellow", 200, 200, 0, 199.0)]
    assert rows(
        """SELECT taxi_type, _rejection_reasons, count(*) AS n FROM silver_quarantine_union
           GROUP BY taxi_type, _rejection_reasons ORDER BY taxi_type, n DESC"""
    ) == [
        (t, [reason], n)
        for t in ("green", "yellow")
        for reason, n in (("passenger_count_positive", 20), ("total_amount_non_negative", 1))
    ]
    assert rows("SELECT DISTINCT taxi_type, year_month FROM landing_schema_snapshot ORDER BY 1") == [
        ("green", "2023-01"),
        ("yellow", "2023-01"),
    ]
    assert rows(
        """SELECT data_type FROM landing_schema_snapshot
           WHERE taxi_type = 'yellow' AND column_name = 'VendorID'"""
    ) == [("bigint",)]
    gold = lake.store.database("gold")
    assert rows(
        f"""SELECT a.year, a.month, a.trip_count, a.avg_total_amount = f.mean
            FROM {gold}.agg_trip_monthly_taxi a JOIN (
              SELECT d.year, d.month, CAST(round(avg(total_amount), 2) AS DOUBLE) AS mean
              FROM fact_trip_view JOIN {gold}.dim_date d USING (date_key)
              WHERE taxi_type = 'yellow' GROUP BY d.year, d.month) f USING (year, month)
            WHERE taxi_type = 'yellow'"""
    ) == [(2023, 1, 179, True)]

    plan = spark.sql(
        "SELECT count(passenger_count) FROM bronze_union WHERE taxi_type = 'green'"
    )._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and YELLOW.bronze.name not in plan
    assert "ReadSchema: struct<passenger_count:int>" in plan
