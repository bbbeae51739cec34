"""Trips made from the general test tables, as plain projections: every row of a table becomes
one trip, so work grows with the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.functions.payload import once, parsed


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def plain_columns() -> dict[str, Column]:
    """What a trip has without a look into the event's payload."""
    green = F.col("user_id") % 2 != 0
    vendor = F.element_at(
        F.array(*(F.lit(v) for v in (1, 2, 6, 7))), (F.col("user_id") % 4).cast("int") + 1
    )
    return {
        "event_id": F.col("event_id"),
        "taxi_type": F.when(green, "green").otherwise("yellow"),
        "VendorID": F.when(F.col("user_id") % 75 != 74, vendor),
        "trip_distance": F.col("value"),
    }


def plain_trips(events: DataFrame) -> DataFrame:
    """Trips without what is in the payload, which is not read for them."""
    return events.select(*(c.alias(n) for n, c in plain_columns().items()))


def event_trips(events: DataFrame) -> DataFrame:
    """Trips from an event log, with faults of every kind the rules look for."""
    k = F.col("k")
    plain = plain_columns()
    green = F.col("user_id") % 2 != 0
    start = F.col("ts").cast("timestamp")
    amount = F.when(k % 20 == 19, -F.col("value")).otherwise(F.col("value"))
    return once(events, k=F.try_variant_get(parsed("props"), "$.k", "int")).select(
        "event_id",
        plain["taxi_type"].alias("taxi_type"),
        plain["VendorID"].alias("VendorID"),
        F.when(k % 25 != 24, k % 7).alias("passenger_count"),
        amount.cast("decimal(10,2)").alias("total_amount"),
        F.when(F.col("event_id") % 997 != 0, start).alias("pickup_datetime"),
        F.when(k != 50, start + F.make_dt_interval(mins=k - 2)).alias("dropoff_datetime"),
        plain["trip_distance"].alias("trip_distance"),
        F.when(k % 10 != 9, k % 6 + 1).alias("RatecodeID"),
        F.when(F.col("user_id") % 50 != 49, F.col("user_id") + 1).cast("int").alias("PULocationID"),
        F.when(k % 33 != 32, k + 1).alias("DOLocationID"),
        F.when(F.col("event_type") != "signup", k % 4 + 1).alias("payment_type"),
        F.when(green & (k % 5 != 4), k / 4).alias("ehail_fee"),
        F.when(green & (k % 9 != 8), k % 2 + 1).alias("trip_type"),
        "event_type",
        F.when(F.col("event_type") == "error", F.col("props")).alias("_rescued_data"),
    )


def order_trips(orders: DataFrame) -> DataFrame:
    """Trips over many months: one per order, by status."""
    return orders.select(
        F.col("o_orderkey").alias("trip_id"),
        F.col("o_orderstatus").alias("taxi_type"),
        F.col("o_orderdate").cast("timestamp").alias("pickup_datetime"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("total_amount"),
        (F.col("o_custkey") % 7).cast("int").alias("passenger_count"),
    )


def line_trips(lineitem: DataFrame) -> DataFrame:
    """The largest table: one trip per order line."""
    return lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_returnflag").alias("taxi_type"),
        F.col("l_shipdate").cast("timestamp").alias("pickup_datetime"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("total_amount"),
        F.col("l_quantity").cast("int").alias("passenger_count"),
        F.col("l_suppkey").cast("int").alias("vendor_id"),
    )
