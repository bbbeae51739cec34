"""Temporary views for questions in SQL over everything the jobs have stored."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.contracts import FACT_TRIP
from stratamart.operators.profile import bronze_union, labelled_union
from stratamart.plans.jobs import Lake
from stratamart.sources.footers import list_files, read_footers, snapshot


def register_views(
    lake: Lake, landings: Mapping[str, str] | None = None, prefix: str = ""
) -> list[str]:
    """``bronze_union``, ``silver_quarantine_union`` and ``fact_trip_view``; and, given the
    landing folder of each source, ``landing_schema_snapshot``. Returns their names, which ``prefix``
    keeps apart where a session has several lakes.

    The first three stay lazy: a query over one reads the columns and the sources it names.
    """
    store = lake.store
    # The names of the views.
    views = {
        "bronze_union": bronze_union(
            {
                s.name: (store.read("bronze", s.bronze), s.pickup_column, s.dropoff_column)
                for s in lake.sources
            }
        ),
        "silver_quarantine_union": labelled_union(
            {s.name: store.rows("silver", s.quarantine) for s in lake.sources}
        ),
        "fact_trip_view": store.read("gold", FACT_TRIP),
    }
    if landings:
        views["landing_schema_snapshot"] = landing_schemas(lake, landings)
    for name, df in views.items():
        df.createOrReplaceTempView(prefix + name)
    return [prefix + name for name in views]


def landing_schemas(lake: Lake, landings: Mapping[str, str]) -> DataFrame:
    """Columns of the landed files by source and month."""
    parts = []
    for source, root in landings.items():
        seen = snapshot(read_footers(list_files(lake.spark, root)))
        parts.append(
            seen.select(
                F.lit(source).alias("taxi_type"),
                F.col("period").alias("year_month"),
                "column_name",
                "data_type",
                "nullable",
            )
        )
    return reduce(DataFrame.unionByName, parts)
