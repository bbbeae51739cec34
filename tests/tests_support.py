"""Landed files the job tests start from."""

from datetime import date

from pyspark.sql import functions as F

from stratamart.settings import GREEN, YELLOW, StudyRange

STUDY = StudyRange(date(2023, 1, 1), date(2023, 3, 1))


def landed_rows(spark, spec, month, rows=200):
    """Trips of one month; every tenth has no passengers, one amount is too large to store."""
    base = spark.range(rows).select(
        F.element_at(F.array(*(F.lit(v) for v in (1, 2, 6, 7))), (F.col("id") % 4 + 1).cast("int"))
        .cast("bigint")
        .alias("VendorID"),
        F.expr(
            f"TIMESTAMP_NTZ '2023-0{month}-01' + make_dt_interval(CAST(id % 4 AS INT), 0, id)"
        ).alias(spec.pickup_column),
        (F.col("id") % 10).cast("double").alias("passenger_count"),
        F.col("id").cast("double").alias("trip_distance"),
        F.when(F.col("id") == 11, 1e9).otherwise(F.col("id") * 0.5).alias("total_amount"),
    )
    return base.withColumn(
        spec.dropoff_column, F.col(spec.pickup_column) + F.expr("INTERVAL 7 MINUTES")
    )


def land_both(spark, tmp_path):
    places = {s.name: str(tmp_path / "landing" / s.name) for s in (YELLOW, GREEN)}
    for spec in (YELLOW, GREEN):
        landed_rows(spark, spec, 1).write.parquet(f"{places[spec.name]}/year=2023/month=01")
    return places
