"""Dimensions: a generated calendar and a fixed list of vendors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.contracts import DIM_VENDOR, quoted
from stratamart.functions.calendar import day_number
from stratamart.settings import StudyRange

# Known vendors.
VENDORS = [
    (1, "Creative Mobile Technologies, LLC", "CMT"),
    (2, "VeriFone Inc.", "VeriFone"),
    (6, "Myle Technologies Inc", "Myle"),
    (7, "Helix", "Helix"),
]
SUNDAY, SATURDAY = 1, 7


def calendar(bounds: DataFrame) -> DataFrame:
    """One row per day from ``first_day`` to ``last_day``, both included, of a one-row frame.
    The size is that of the period, never of the data the bounds come from."""
    days = bounds.select(F.explode(F.sequence("first_day", "last_day")).alias("full_date"))
    day = F.col("full_date")
    return days.select(
        day_number(day).alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.day(day).alias("day"),
        F.dayofweek(day).alias("day_of_week"),
        F.weekofyear(day).alias("week_of_year"),
        F.dayofweek(day).isin(SUNDAY, SATURDAY).alias("is_weekend"),
    )


def study_calendar(spark: SparkSession, study: StudyRange) -> DataFrame:
    """``study.days`` rows: the end of the period is not part of it."""
    bounds = spark.range(1).select(
        F.lit(study.start).alias("first_day"),
        F.date_sub(F.lit(study.end), 1).alias("last_day"),
    )
    return calendar(bounds)


def vendors(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"({i}, {quoted(name)}, {quoted(short)})" for i, name, short in VENDORS)
    names = ", ".join(DIM_VENDOR.columns)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS known({names})")
