"""The fact: trips of all sources in one shape."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.contracts import FACT_TRIP
from stratamart.functions.calendar import day_number
from stratamart.operators.rules import within
from stratamart.settings import StudyRange


def fact_rows(silver: DataFrame, source: str | Column, study: StudyRange) -> DataFrame:
    """Trips of the period. The name of a single source is a literal, so a later filter on it drops
    the other sources from a union altogether; rows of several sources come with a column."""
    pickup, dropoff = F.col("pickup_datetime"), F.col("dropoff_datetime")
    return (
        silver.filter(within("pickup_datetime", study))
        .withColumns(
            {
                "date_key": day_number(pickup),
                "vendor_id": F.col("VendorID"),
                "duration_seconds": F.unix_timestamp(dropoff) - F.unix_timestamp(pickup),
                "taxi_type": F.lit(source),
            }
        )
        .select(*FACT_TRIP.columns)
    )


def union_facts(silver: Mapping[str, DataFrame], study: StudyRange) -> DataFrame:
    if not silver:
        raise ValueError("a fact needs at least one source")
    parts = [fact_rows(df, source, study) for source, df in silver.items()]
    return reduce(DataFrame.unionByName, parts)
