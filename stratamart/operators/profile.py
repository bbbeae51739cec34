"""Data profiling: what is missing, out of range, extreme or set aside."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.functions.measures import COUNT_DIGITS, mean, nulls_in
from stratamart.operators.conform import RESCUED
from stratamart.operators.quantiles import exact_percentiles, point_name
from stratamart.operators.rules import REASONS, Rule, mask, named

# The columns whose absence matters, and the percentiles looked at.
CRITICAL_COLUMNS = (
    "VendorID",
    "passenger_count",
    "RatecodeID",
    "PULocationID",
    "DOLocationID",
    "payment_type",
)
POINTS = (0.5, 0.95, 0.99)

# The columns both sources have in common.
BRONZE_UNION_COLUMNS = (
    "VendorID",
    "passenger_count",
    "trip_distance",
    "RatecodeID",
    "PULocationID",
    "DOLocationID",
    "payment_type",
    "fare_amount",
    "total_amount",
    "airport_fee",
    "pickup_datetime",
    "dropoff_datetime",
    "_ingestion_ts",
    "_source_file",
    "_batch_id",
    "_rescued_data",
)


def labelled_union(parts: Mapping[str, DataFrame], label: str = "taxi_type") -> DataFrame:
    """All rows of all parts, with the name of the part as a literal column: a filter on it
    leaves the scans of the other parts out of the plan."""
    named = [df.select(F.lit(name).alias(label), "*") for name, df in parts.items()]
    return reduce(DataFrame.unionByName, named)


def bronze_union(parts: Mapping[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """``source -> (rows, pickup column, dropoff column)`` as one relation with common names."""
    common = {}
    for name, (df, pickup, dropoff) in parts.items():
        renamed = df.withColumnsRenamed({pickup: "pickup_datetime", dropoff: "dropoff_datetime"})
        common[name] = renamed.select(*BRONZE_UNION_COLUMNS)
    return labelled_union(common)


def any_null(columns: Sequence[str]) -> Column:
    return reduce(Column.__or__, (F.col(c).isNull() for c in columns))


def null_profile(
    df: DataFrame, by: str = "taxi_type", columns: Sequence[str] = CRITICAL_COLUMNS
) -> DataFrame:
    return df.groupBy(by).agg(
        F.count("*").alias("total_rows"),
        F.count_if(F.col(RESCUED).isNotNull()).alias("rescued_rows"),
        *(nulls_in(c) for c in columns),
    ).orderBy(by)


def null_profile_rescued(
    df: DataFrame, by: str = "taxi_type", columns: Sequence[str] = CRITICAL_COLUMNS
) -> DataFrame:
    """The same over the rows that carry a rescued payload."""
    return (
        df.filter(F.col(RESCUED).isNotNull())
        .groupBy(by)
        .agg(F.count("*").alias("rescued_rows"), *(nulls_in(c) for c in columns))
        .orderBy(by)
    )


def null_attribution(df: DataFrame, column: str, by: str = "taxi_type") -> DataFrame:
    """Rows where ``column`` is missing, and how many of them carry a rescued payload."""
    return (
        df.filter(F.col(column).isNull())
        .groupBy(by)
        .agg(
            F.count("*").alias(f"rows_with_null_{column}"),
            F.count_if(F.col(RESCUED).isNotNull()).alias(f"rescued_rows_with_null_{column}"),
        )
        .orderBy(by)
    )


def rescued_samples(
    df: DataFrame,
    order: Sequence[str],
    limit: int = 50,
    columns: Sequence[str] = CRITICAL_COLUMNS,
) -> DataFrame:
    """First rows that carry a payload and still lack a critical value."""
    return df.filter(F.col(RESCUED).isNotNull() & any_null(columns)).orderBy(*order).limit(limit)


def null_samples(df: DataFrame, column: str, order: Sequence[str], limit: int = 50) -> DataFrame:
    return df.filter(F.col(column).isNull()).orderBy(*order).limit(limit)


def range_outliers(df: DataFrame, start: Column, end: Column, by: str = "taxi_type") -> DataFrame:
    when = F.col("pickup_datetime")
    return (
        df.filter((when < start) | (when >= end))
        .groupBy(by)
        .agg(
            F.count("*").alias("rows_outside_study_range"),
            F.min(when).alias("min_pickup_datetime"),
            F.max(when).alias("max_pickup_datetime"),
        )
        .orderBy(by)
    )


def bounds(df: DataFrame, columns: Sequence[str], by: str = "taxi_type") -> DataFrame:
    """Smallest and largest value of each column."""
    ends = [f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))]
    return df.groupBy(by).agg(*ends).orderBy(by)


def approx_percentiles(
    df: DataFrame,
    column: str,
    by: str = "taxi_type",
    points: Sequence[float] = POINTS,
    accuracy: int = 10_000,
    digits: int | None = None,
) -> DataFrame:
    """Range and approximate percentiles in one pass. The sketches combine map-side and hold
    about ``accuracy`` samples each; a rank is off by at most rows/accuracy."""
    sketch = F.percentile_approx(column, list(points), accuracy)
    found = (
        df.filter(F.col(column).isNotNull())
        .groupBy(by)
        .agg(
            F.min(column).alias(f"min_{column}"),
            F.max(column).alias(f"max_{column}"),
            sketch.alias("_found"),
        )
    )

    def read(i: int) -> Column:
        value = F.col("_found")[i]
        return value if digits is None else F.round(value, digits)

    named = [read(i).alias(f"{point_name(p)}_{column}") for i, p in enumerate(points)]
    return found.select(by, f"min_{column}", *named, f"max_{column}").orderBy(by)


def top_rows(df: DataFrame, order: Sequence[Column], limit: int = 25) -> DataFrame:
    """Each task keeps its best ``limit`` rows; only those are merged."""
    return df.orderBy(*order).limit(limit)


def reason_counts(quarantined: DataFrame, by: str = "taxi_type") -> DataFrame:
    """How often each set of broken rules occurs."""
    return (
        quarantined.groupBy(by, REASONS)
        .agg(F.count("*").alias("rows_in_quarantine"))
        .orderBy(F.asc(by), F.desc("rows_in_quarantine"))
    )


def reason_counts_by_mask(df: DataFrame, rules: Sequence[Rule], by: str = "taxi_type") -> DataFrame:
    """The same straight from the rows that are judged: sets of broken rules are grouped as bits of a number, and named
    once they are counted."""
    judged = df.select(by, mask(rules).alias("_mask")).filter("_mask <> 0")
    counted = judged.groupBy(by, "_mask").agg(F.count("*").alias("rows_in_quarantine"))
    return counted.select(by, named(F.col("_mask"), rules).alias(REASONS), "rows_in_quarantine").orderBy(
        F.asc(by), F.desc("rows_in_quarantine")
    )


def quarantine_bounds(quarantined: DataFrame, by: str = "taxi_type") -> DataFrame:
    return (
        quarantined.groupBy(by)
        .agg(
            F.count("*").alias("quarantine_rows"),
            F.min("pickup_datetime").alias("min_pickup_datetime"),
            F.max("pickup_datetime").alias("max_pickup_datetime"),
        )
        .orderBy(by)
    )


def monthly_trips(fact: DataFrame, by: str = "taxi_type") -> DataFrame:
    month = F.date_format("pickup_datetime", "yyyy-MM").alias("year_month")
    return fact.groupBy(by, month).agg(F.count("*").alias("trips")).orderBy(by, "year_month")


def hourly_trips(fact: DataFrame, start: Column, end: Column) -> DataFrame:
    """Trips and mean passengers per hour of the day, over a half-open period."""
    when = F.col("pickup_datetime")
    return (
        fact.filter((when >= start) & (when < end))
        .groupBy(F.hour(when).alias("pickup_hour"))
        .agg(
            F.count("*").alias("trips"),
            mean("passenger_count", COUNT_DIGITS).alias("avg_passenger_count"),
        )
        .orderBy("pickup_hour")
    )


def schema_listing(snapshot: DataFrame) -> DataFrame:
    return snapshot.orderBy("source", "period", "column_name")


def type_drift(snapshot: DataFrame) -> DataFrame:
    """Columns that change their type between periods, with what was seen when. Files are
    reduced to distinct periods first, so a list has one entry per period and type."""
    seen = snapshot.select("source", "column_name", "period", "data_type").distinct()
    label = F.concat_ws(" -> ", "period", "data_type")
    return (
        seen.groupBy("source", "column_name")
        .agg(
            F.count_distinct("data_type").alias("distinct_types"),
            F.sort_array(F.collect_set(label)).alias("observed_types"),
        )
        .filter("distinct_types > 1")
        .orderBy("source", "column_name")
    )


def table_metrics(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table, metric, value)``: rows of each table, and rescued rows where it has payloads."""
    parts = []
    for name, df in tables.items():
        aggregates = {"rows": F.count("*")}
        if RESCUED in df.columns:
            aggregates["rescued_rows"] = F.count_if(F.col(RESCUED).isNotNull())
        counted = df.agg(*(a.alias(m) for m, a in aggregates.items()))
        pairs = [F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in aggregates]
        parts.append(counted.select(F.lit(name).alias("table"), F.inline(F.array(*pairs))))
    return reduce(DataFrame.unionByName, parts)
