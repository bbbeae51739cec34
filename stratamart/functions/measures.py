"""Aggregate expressions over trips. All of them combine on the map side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY_DIGITS = 2
COUNT_DIGITS = 4


def mean(column: str, digits: int) -> Column:
    """Mean rounded half up to ``digits``, as a double."""
    return F.round(F.avg(column), digits).cast("double")


def trip_measures() -> list[Column]:
    """Count, sums and means of a set of trips. The sums are additive: coarser groups can be
    built from finer ones; the means are for reading."""
    return [
        F.count("*").alias("trip_count"),
        F.sum("total_amount").cast("decimal(18,2)").alias("total_amount_sum"),
        F.sum("passenger_count").cast("bigint").alias("passenger_count_sum"),
        mean("total_amount", MONEY_DIGITS).alias("avg_total_amount"),
        mean("passenger_count", COUNT_DIGITS).alias("avg_passenger_count"),
    ]


def ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """Ratio of two sums; NULL over nothing."""
    return F.round(numerator.cast("double") / F.nullif(denominator, F.lit(0)), digits)


def nulls_in(column: str) -> Column:
    return F.count_if(F.col(column).isNull()).alias(f"{column.lower()}_nulls")
