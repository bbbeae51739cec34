"""Every operator, applied to the whole of the general test tables.

Each query takes ``(spark, folder)`` and returns a DataFrame. :mod:`stratamart.plans.oracles`
states the expected result of each in SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StringType, StructField, StructType, TimestampType

from stratamart.contracts import BRONZE_YELLOW, DIM_DATE, FACT_TRIP, SILVER, TableContract
from stratamart.functions.keys import hashed_key, trip_key_of
from stratamart.functions.payload import once, parsed
from stratamart.operators import bucketed, checks, dims, facts, marts, profile, quantiles, rules
from stratamart.operators.conform import conform
from stratamart.operators.layout import append_rows, insert_by_position, stage
from stratamart.operators.rules import REASONS
from stratamart.operators.upsert import merge_rows, upsert
from stratamart.plans.jobs import Lake, bronze_to_silver, land_to_bronze, run_all
from stratamart.plans.views import register_views
from stratamart.session import pin_utc, shared_dir
from stratamart.settings import GREEN, YELLOW, StudyRange
from stratamart.sources.adaptors import event_trips, line_trips, order_trips, plain_trips, table
from stratamart.sources import metadata
from stratamart.sources.footers import list_files, read_footers, snapshot
from stratamart.sources.tables import TableStore
from stratamart.streaming.bronze import ingest_files, ingest_uniform, fresh_run_name, rescued_examples

Query = Callable[[SparkSession, str], DataFrame]

# Fixed values of the test tables: the period the events are studied over and its parts.
EVENT_STUDY = StudyRange(date(2024, 1, 3), date(2024, 1, 29))
EVENT_YEAR, EVENT_MONTH = 2024, 1
FIRST_LOAD_ENDS = date(2024, 1, 20)
SECOND_LOAD_STARTS = date(2024, 1, 10)
FIRST_LOADED_AT, SECOND_LOADED_AT = "2024-02-01 00:00:00", "2024-02-02 00:00:00"
SHORT_CALENDAR = StudyRange(date(2024, 1, 1), date(2024, 1, 16))
SHORT_STUDY = StudyRange(date(2024, 1, 3), date(2024, 1, 16))
ORDER_STUDY = StudyRange(date(1990, 1, 1), date(2010, 1, 1))
FIRST_DRIFT, SECOND_DRIFT = date(2024, 1, 10), date(2024, 1, 20)

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register a query under its name, with its result in the form results are compared in."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return comparable(function(pin_utc(spark), folder))

    QUERIES[function.__name__] = run
    return function


def comparable(df: DataFrame) -> DataFrame:
    """Zoned timestamps as plain UTC ones and decimals as doubles: clients of other engines hand
    these two over in different forms. The operators themselves keep the types of the contracts."""
    plain = {TimestampType: "timestamp_ntz", DecimalType: "double"}
    casts = {
        f.name: F.col(f.name).cast(plain[type(f.dataType)])
        for f in df.schema.fields
        if type(f.dataType) in plain
    }
    return df.withColumns(casts) if casts else df


# --- Shared inputs ---------------------------------------------------------------------------


def trips(spark: SparkSession, folder: str) -> DataFrame:
    return event_trips(table(spark, folder, "events"))


def bronze_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Trips of both sources in the Bronze shape they have in common: one scan, as the source is a
    column here. The ``published_*`` queries unite separate tables."""
    common = StructType().add("taxi_type", "string")
    for name in profile.BRONZE_UNION_COLUMNS:
        own = {"pickup_datetime": YELLOW.pickup_column, "dropoff_datetime": YELLOW.dropoff_column}
        common.add(name, BRONZE_YELLOW.types[own.get(name, name)])
    return conform(trips(spark, folder), TableContract("common_bronze", common))


def event_rules() -> list[rules.Rule]:
    return rules.trip_rules(EVENT_STUDY)


def keyed(df: DataFrame) -> DataFrame:
    extra = {spec.name: spec.extra_key_columns for spec in (YELLOW, GREEN)}
    return df.withColumn("tripsk", trip_key_of(df, "taxi_type", extra))


def clean(spark: SparkSession, folder: str) -> DataFrame:
    return keyed(rules.split(trips(spark, folder), event_rules())[0])


def quarantined(spark: SparkSession, folder: str) -> DataFrame:
    return rules.split(trips(spark, folder), event_rules())[1]


def event_fact(spark: SparkSession, folder: str) -> DataFrame:
    """Fact over clean trips of both sources, in one scan."""
    held = clean(spark, folder).withColumn("_ingestion_ts", F.lit(FIRST_LOADED_AT).cast("timestamp"))
    return facts.fact_rows(held, F.col("taxi_type"), EVENT_STUDY)


def order_fact(spark: SparkSession, folder: str) -> DataFrame:
    day = F.col("pickup_datetime")
    return order_trips(table(spark, folder, "orders")).withColumn(
        "date_key", (F.year(day) * 10000 + F.month(day) * 100 + F.day(day))
    )


def order_calendar(spark: SparkSession, folder: str) -> DataFrame:
    """Days between the first and the last order."""
    days = table(spark, folder, "orders").agg(
        F.min("o_orderdate").cast("date").alias("first_day"),
        F.max("o_orderdate").cast("date").alias("last_day"),
    )
    return dims.calendar(days)


def fresh_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid4().hex}"


# --- Rules -----------------------------------------------------------------------------------


@query
def rules_split_summary(spark, folder):
    return rules.split_summary(trips(spark, folder), event_rules(), ["taxi_type"])


@query
def rule_failures(spark, folder):
    return rules.rule_failures(trips(spark, folder), event_rules())


@query
def clean_trips(spark, folder):
    return rules.split(trips(spark, folder), event_rules())[0].select(
        "event_id",
        "taxi_type",
        "VendorID",
        "passenger_count",
        "total_amount",
        "pickup_datetime",
        "dropoff_datetime",
    )


@query
def quarantine_trips(spark, folder):
    return quarantined(spark, folder).select(
        "event_id",
        "taxi_type",
        "VendorID",
        F.col("passenger_count").cast("double").alias("passenger_count"),
        F.col("total_amount").cast("double").alias("total_amount"),
        "pickup_datetime",
        "dropoff_datetime",
        F.array_join(REASONS, ",").alias("reasons"),
    )


@query
def quarantine_by_reason(spark, folder):
    return profile.reason_counts_by_mask(trips(spark, folder), event_rules()).select(
        "taxi_type", F.array_join(REASONS, ",").alias("reasons"), "rows_in_quarantine"
    )


@query
def quarantine_bounds(spark, folder):
    return profile.quarantine_bounds(quarantined(spark, folder))


@query
def quarantine_samples(spark, folder):
    first = quarantined(spark, folder).orderBy("taxi_type", "pickup_datetime", "event_id").limit(50)
    return first.select(
        "event_id",
        "taxi_type",
        "VendorID",
        "passenger_count",
        "total_amount",
        "pickup_datetime",
        "dropoff_datetime",
        F.array_join(REASONS, ",").alias("reasons"),
    )


# --- Keys, upsert, checks --------------------------------------------------------------------


@query
def surrogate_key(spark, folder):
    return keyed(trips(spark, folder)).select("event_id", "tripsk")


def line_keys(spark: SparkSession, folder: str) -> DataFrame:
    parts = [F.col("l_orderkey"), F.col("l_returnflag")]
    return table(spark, folder, "lineitem").select(hashed_key(parts).alias("line_key"))


@query
def duplicate_keys(spark, folder):
    return checks.duplicate_keys(line_keys(spark, folder), "line_key")


@query
def duplicate_keys_topk(spark, folder):
    return checks.top_duplicate_keys(line_keys(spark, folder), "line_key", 10)


@query
def keep_one_per_key(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_returnflag", "l_shipdate", "l_linenumber", "l_quantity"
    )
    return checks.keep_one(rows, ["l_orderkey", "l_returnflag"])


def silver_loads(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Two loads that share the trips of some days, of trips that are judged and keyed once."""
    held = clean(spark, folder).select(*(c for c in SILVER.columns if c != "_ingestion_ts"))
    held, pickup = stage(held, "keyed"), F.col("pickup_datetime")

    def load(rows: DataFrame, at: str) -> DataFrame:
        stamped = rows.withColumn("_ingestion_ts", F.lit(at).cast("timestamp"))
        return stamped.select(*SILVER.columns)

    first = load(held.filter(pickup < F.lit(FIRST_LOAD_ENDS)), FIRST_LOADED_AT)
    second = load(held.filter(pickup >= F.lit(SECOND_LOAD_STARTS)), SECOND_LOADED_AT)
    return first, second


@query
def upsert_silver(spark, folder):
    first, second = silver_loads(spark, folder)
    return merge_rows(first, second, SILVER.key)


@query
def upsert_stored(spark, folder):
    """The same two loads through a stored table, the second one twice."""
    store = TableStore(spark, fresh_folder(spark, "upsert"))
    first, second = silver_loads(spark, folder)
    store.make_folder("silver", SILVER)
    first, second = stage(first, "load"), stage(second, "load")
    for load in (first, second, second):
        upsert(store, "silver", SILVER, load)
    return store.rows("silver", SILVER)


@query
def upsert_bucketed(spark, folder):
    """The same two loads through a table bucketed by the key, the second one twice."""
    store = TableStore(spark, fresh_folder(spark, "bucketed"), prefix=f"bucketed_{uuid4().hex}")
    store.create("silver", SILVER, buckets=4)
    first, second = silver_loads(spark, folder)
    first, second = stage(first, "load"), stage(second, "load")
    for load in (first, second, second):
        bucketed.upsert_bucketed(store, "silver", SILVER, load)
    twice = bucketed.stored_duplicates(store, "silver", SILVER).count()
    if twice:
        raise ValueError(f"{twice} keys are there twice")
    return spark.table(store.table_name("silver", SILVER)).select(*SILVER.columns)


@query
def overwritten_by_position(spark, folder):
    """Priorities per order status and year through a catalog table, whose odd years are then written again with double
    counts: by position, under other names, other years untouched."""
    counts = (
        table(spark, folder, "orders")
        .groupBy("o_orderpriority", "o_orderstatus", F.year("o_orderdate").alias("year"))
        .agg(F.count("*").alias("orders"))
    )
    counts = stage(counts, "priorities").select("o_orderpriority", "orders", "o_orderstatus", "year")
    name = f"priorities_{uuid4().hex}"
    spark.sql(
        f"CREATE TABLE {name} (priority STRING, orders BIGINT, status STRING, year INT) USING PARQUET "
        f"PARTITIONED BY (status, year) LOCATION '{fresh_folder(spark, 'priorities')}'"
    )
    insert_by_position(counts, name)
    again = counts.filter("year % 2 <> 0").select(
        F.col("o_orderpriority").alias("a"), (F.col("orders") * 2).alias("year"), F.col("o_orderstatus").alias("b"), F.col("year").alias("orders")
    )
    insert_by_position(again, name)
    return spark.table(name)


@query
def bounds_from_footers(spark, folder):
    """Counts and bounds of stored orders by status, out of the footers of files in folders by status and year."""
    root = fresh_folder(spark, "footers")
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", F.col("o_orderdate").cast("date").alias("day"), "o_orderstatus", F.year("o_orderdate").alias("year")
    )
    orders.write.partitionBy("o_orderstatus", "year").parquet(root)
    columns = ["o_orderkey", "o_totalprice", "day"]
    return metadata.stored_bounds(spark, root, orders.schema, ["o_orderstatus", "year"], columns, ["o_orderstatus"])


@query
def refused_in_write(spark, folder):
    """All trips into a fact table whose write refuses rows that break a check, after their sound part went through: the
    rows that are there afterwards, and whether the refusal named the check."""
    lasted = F.unix_timestamp("dropoff_datetime") - F.unix_timestamp("pickup_datetime")
    rows = trips(spark, folder).filter("event_id % 997 <> 0").select("event_id", "total_amount", "passenger_count", lasted.alias("duration_seconds"))
    contract = replace(FACT_TRIP, schema=rows.schema, partition_by={}, cluster_by=())
    root = fresh_folder(spark, "refused")
    sound = reduce(Column.__and__, (F.coalesce(F.expr(t), F.lit(False)) for t in contract.checks.values()))
    checks.asserted(rows.filter(sound), contract).write.parquet(root)
    said = "nothing was refused"
    try:
        checks.asserted(rows, contract).write.mode("overwrite").parquet(f"{root}-all")
    except Exception as refusal:  # noqa: BLE001 - Spark's own kinds differ by the place a task fails at
        said = str(refusal)
    named = any(f"{contract.name} refuses a row: {name}" in said for name in contract.checks)
    kept = spark.read.schema(rows.schema).parquet(root)
    return kept.groupBy("passenger_count").agg(F.count("*").alias("rows"), F.max("event_id").alias("last"), F.lit(named).alias("named"))


@query
def orphan_keys(spark, folder):
    """Different supplier and part keys of all order lines that the suppliers in credit and the parts lack."""
    suppliers = table(spark, folder, "supplier").filter("s_acctbal >= 0")
    links = {"l_suppkey": (suppliers, "s_suppkey"), "l_partkey": (table(spark, folder, "part"), "p_partkey")}
    return checks.orphan_keys(table(spark, folder, "lineitem"), links)


@query
def upsert_fact_union(spark, folder):
    """Fact of an earlier period, updated by the fact of all sources over a later one."""
    fact, pickup = event_fact(spark, folder), F.col("pickup_datetime")
    earlier = fact.filter(pickup < F.lit(FIRST_LOAD_ENDS))
    later = fact.filter(pickup >= F.lit(SECOND_LOAD_STARTS)).withColumn(
        "_ingestion_ts", F.lit(SECOND_LOADED_AT).cast("timestamp")
    )
    return merge_rows(earlier, later, FACT_TRIP.key)


@query
def orphans_date(spark, folder):
    short = dims.study_calendar(spark, SHORT_CALENDAR)
    lost = checks.orphans(event_fact(spark, folder), "date_key", short, "date_key")
    return lost.groupBy("taxi_type", "date_key").agg(F.count("*").alias("orphans"))


@query
def orphans_vendor(spark, folder):
    known = dims.vendors(spark).filter("vendor_id < 7")
    lost = checks.orphans(plain_trips(table(spark, folder, "events")), "VendorID", known, "vendor_id")
    return lost.groupBy("taxi_type", "VendorID").agg(F.count("*").alias("orphans"))


@query
def orphan_counts(spark, folder):
    """Supplier references of all order lines against the suppliers in debt and in credit."""
    suppliers = table(spark, folder, "supplier")
    parts = table(spark, folder, "part")
    lines = table(spark, folder, "lineitem")
    links = {
        "l_suppkey": (suppliers.filter("s_acctbal >= 0"), "s_suppkey"),
        "l_partkey": (parts, "p_partkey"),
    }
    return checks.orphan_counts(lines, links)


@query
def constraint_violations(spark, folder):
    """The fact's checks on trips nothing has been filtered from."""
    lasted = F.unix_timestamp("dropoff_datetime") - F.unix_timestamp("pickup_datetime")
    rows = keyed(trips(spark, folder)).withColumn("duration_seconds", lasted)
    raw = rows.withColumn("tripsk", F.when(F.col("event_id") % 997 != 0, F.col("tripsk")))
    return checks.constraint_violations(raw, FACT_TRIP)


# --- Dimensions, fact, marts, questions ------------------------------------------------------


@query
def dim_date(spark, folder):
    return order_calendar(spark, folder)


@query
def dim_vendor(spark, folder):
    """Known vendors with their trips; trips are counted before they meet the dimension."""
    per_vendor = plain_trips(table(spark, folder, "events")).groupBy("VendorID").agg(F.count("*").alias("trips"))
    known = dims.vendors(spark)
    joined = known.join(per_vendor, known.vendor_id == per_vendor.VendorID, "left")
    return joined.select("vendor_id", "vendor_name", "vendor_short_name", "trips")


@query
def fact_trip(spark, folder):
    return event_fact(spark, folder)


@query
def agg_hourly_daily(spark, folder):
    return marts.hourly_daily(event_fact(spark, folder))


@query
def agg_hourly_daily_lines(spark, folder):
    fact = line_trips(table(spark, folder, "lineitem"))
    day = F.col("pickup_datetime")
    return marts.hourly_daily(
        fact.withColumn("date_key", F.year(day) * 10000 + F.month(day) * 100 + F.day(day))
    )


@query
def agg_monthly(spark, folder):
    return marts.monthly(order_fact(spark, folder))


@query
def agg_monthly_rollup(spark, folder):
    return marts.monthly_from_hourly(marts.hourly_daily(order_fact(spark, folder)))


@query
def q1_monthly_mean(spark, folder):
    return marts.monthly_mean(marts.monthly(order_fact(spark, folder)), "F")


@query
def q1_from_fact(spark, folder):
    dates = dims.study_calendar(spark, ORDER_STUDY)
    return marts.monthly_mean_from_fact(order_fact(spark, folder), dates, "F")


@query
def q2_hourly_mean(spark, folder):
    dates = dims.study_calendar(spark, EVENT_STUDY)
    mart = marts.hourly_daily(event_fact(spark, folder))
    return marts.hourly_passengers(mart, dates, EVENT_YEAR, EVENT_MONTH)


@query
def q2_from_fact(spark, folder):
    dates = dims.study_calendar(spark, EVENT_STUDY)
    return marts.hourly_passengers_from_fact(
        event_fact(spark, folder), dates, EVENT_YEAR, EVENT_MONTH
    )


# --- Profiling -------------------------------------------------------------------------------


@query
def null_profile(spark, folder):
    return profile.null_profile(bronze_rows(spark, folder))


@query
def null_profile_rescued(spark, folder):
    return profile.null_profile_rescued(bronze_rows(spark, folder))


@query
def null_attribution(spark, folder):
    return profile.null_attribution(bronze_rows(spark, folder), "passenger_count")


@query
def rescued_samples(spark, folder):
    first = profile.rescued_samples(trips(spark, folder), ["taxi_type", "event_id"])
    return first.select("event_id", "taxi_type", *profile.CRITICAL_COLUMNS, "_rescued_data")


@query
def null_samples(spark, folder):
    order = ["taxi_type", "pickup_datetime", "event_id"]
    first = profile.null_samples(trips(spark, folder), "passenger_count", order)
    return first.select(
        "event_id",
        "taxi_type",
        "pickup_datetime",
        "dropoff_datetime",
        "VendorID",
        "passenger_count",
        "total_amount",
        "_rescued_data",
    )


@query
def range_outliers(spark, folder):
    start, end = (F.lit(d).cast("timestamp") for d in (EVENT_STUDY.start, EVENT_STUDY.end))
    return profile.range_outliers(bronze_rows(spark, folder), start, end)


@query
def time_bounds(spark, folder):
    return profile.bounds(bronze_rows(spark, folder), ["pickup_datetime"])


@query
def fact_bounds(spark, folder):
    return profile.bounds(event_fact(spark, folder), ["pickup_datetime", "total_amount"])


@query
def percentiles_passengers(spark, folder):
    return profile.approx_percentiles(trips(spark, folder), "passenger_count")


@query
def percentiles_amount(spark, folder):
    return profile.exact_percentiles(trips(spark, folder), "total_amount")


@query
def percentiles_distance(spark, folder):
    return profile.exact_percentiles(plain_trips(table(spark, folder, "events")), "trip_distance")


@query
def percentiles_line_price(spark, folder):
    return profile.exact_percentiles(line_trips(table(spark, folder, "lineitem")), "total_amount")


def priced_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines by the year they were shipped in."""
    rows = line_trips(table(spark, folder, "lineitem"))
    return rows.select("taxi_type", "total_amount", F.year("pickup_datetime").alias("year"))


@query
def percentiles_incremental(spark, folder):
    """Sketches kept by year and brought up to date by a second landing of the later years; whether the ranks of the
    percentiles that they state are within one hundredth."""
    lines = priced_lines(spark, folder)
    root = fresh_folder(spark, "sketches")
    years = [r["year"] for r in lines.select("year").distinct().orderBy("year").collect()]
    keys = (["year"], ["taxi_type"], ["total_amount"])
    lines.write.partitionBy("year").parquet(f"{root}/rows")
    stored = spark.read.parquet(f"{root}/rows")
    for landed in (years[: len(years) // 2 + 1], years[len(years) // 2 :]):  # one year is in both
        quantiles.refresh_sketches(stored, f"{root}/sketches", *keys, [Row(year=y) for y in landed])
    sketches = quantiles.stored_sketches(spark, f"{root}/sketches", stored.schema, *keys)
    found = quantiles.sketched_percentiles(sketches, "taxi_type", "total_amount", profile.POINTS)
    ranked = lines.join(found.withColumnRenamed("taxi_type", "of"), F.col("taxi_type") == F.col("of"))
    names = [profile.point_name(p) for p in profile.POINTS]
    near = [
        (F.abs(F.avg((F.col("total_amount") <= F.col(f"{n}_total_amount")).cast("double")) - p) <= 0.01).alias(f"{n}_near")
        for n, p in zip(names, profile.POINTS)
    ]
    return ranked.groupBy("taxi_type").agg(
        F.max("rows").alias("rows"), F.max("min_total_amount").alias("min_amount"), F.max("max_total_amount").alias("max_amount"), *near
    )


TOP_COLUMNS = (
    "event_id",
    "taxi_type",
    "pickup_datetime",
    "dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "total_amount",
)


@query
def top_passengers(spark, folder):
    rows = trips(spark, folder).filter("passenger_count IS NOT NULL")
    order = [F.desc("passenger_count"), F.desc("total_amount"), F.asc("event_id")]
    return profile.top_rows(rows, order).select(*TOP_COLUMNS)


@query
def top_amounts(spark, folder):
    rows = trips(spark, folder).filter("total_amount IS NOT NULL")
    order = [F.desc("total_amount"), F.desc("trip_distance"), F.asc("event_id")]
    return profile.top_rows(rows, order).select(*TOP_COLUMNS)


@query
def monthly_trips(spark, folder):
    return profile.monthly_trips(order_fact(spark, folder))


@query
def hourly_trips(spark, folder):
    start, end = (F.lit(d).cast("timestamp") for d in (FIRST_DRIFT, SECOND_DRIFT))
    return profile.hourly_trips(event_fact(spark, folder), start, end)


@query
def table_metrics(spark, folder):
    return profile.table_metrics(
        {
            "trips": trips(spark, folder),
            "orders": table(spark, folder, "orders"),
            "lineitem": table(spark, folder, "lineitem"),
        }
    )


# --- Ingestion -------------------------------------------------------------------------------


@query
def rescue_recover(spark, folder):
    """Values that are only in a JSON payload, next to values that are in their column."""
    contract = TableContract(
        "recovered",
        StructType()
        .add("event_id", "long")
        .add("value", "decimal(10,2)")
        .add("k", "integer")
        .add("absent", "double")
        .add("_rescued_data", "string"),
    )
    raw = table(spark, folder, "events").select(
        "event_id", F.col("value").alias("VALUE"), F.col("props").alias("_rescued_data"), "ts"
    )
    return conform(raw, contract)


def land_drifting_orders(spark: SparkSession, folder: str, root: str) -> None:
    """Orders as monthly files, whose customer column is wider, and whose day is an instant, in
    years that are not even."""
    when = F.col("o_orderdate")
    rows = table(spark, folder, "orders").withColumns(
        {"year": F.year(when), "month": F.month(when)}
    )
    even = F.coalesce(F.col("year") % 2 == 0, F.lit(False))
    narrow = rows.filter(even).withColumn("o_custkey", F.col("o_custkey").cast("int"))
    wide = rows.filter(~even).withColumn("o_orderdate", when.cast("timestamp"))
    for part in (narrow, wide):
        by_month = part.hint("rebalance", "year", "month")
        by_month.write.mode("append").partitionBy("year", "month").parquet(f"{root}/orders")


def landed_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    root = fresh_folder(spark, "landing")
    land_drifting_orders(spark, folder, root)
    return snapshot(read_footers(list_files(spark, root)))


@query
def schema_snapshot(spark, folder):
    return profile.schema_listing(landed_snapshot(spark, folder))


@query
def type_drift(spark, folder):
    drift = profile.type_drift(landed_snapshot(spark, folder))
    return drift.withColumn("observed_types", F.array_join("observed_types", ","))


def land_drifting_trips(spark: SparkSession, folder: str, root: str) -> None:
    """Three kinds of files, one after the other in time: a wide passenger count; a narrow vendor
    and a fee written with a capital; no fee, but a column nobody has announced."""
    rows = once(table(spark, folder, "events"), k=F.try_variant_get(parsed("props"), "$.k", "int"))
    k = F.col("k")
    common = [
        F.col("ts").alias("tpep_pickup_datetime"),
        (F.col("ts") + F.make_dt_interval(mins=k)).alias("tpep_dropoff_datetime"),
        F.col("value").alias("trip_distance"),
        F.col("event_id").alias("PULocationID"),
    ]
    passengers = F.when(k % 25 != 24, k % 7)
    when = F.col("ts")
    kinds = {
        "first": rows.filter(when < F.lit(FIRST_DRIFT)).select(
            F.col("user_id").alias("VendorID"),
            *common,
            passengers.cast("double").alias("passenger_count"),
            F.col("value").alias("airport_fee"),
        ),
        "second": rows.filter((when >= F.lit(FIRST_DRIFT)) & (when < F.lit(SECOND_DRIFT))).select(
            F.col("user_id").cast("int").alias("VendorID"),
            *common,
            passengers.cast("bigint").alias("passenger_count"),
            F.col("value").alias("Airport_fee"),
        ),
        "third": rows.filter(F.coalesce(when >= F.lit(SECOND_DRIFT), F.lit(True))).select(
            F.col("user_id").alias("VendorID"),
            *common,
            passengers.alias("passenger_count"),
            F.col("event_type").alias("kind"),
        ),
    }
    for name, part in kinds.items():
        part.write.parquet(f"{root}/{name}")


@query
def bronze_stream(spark, folder):
    """Drifting files through the incremental ingestion, run twice: the second finds nothing."""
    root = fresh_folder(spark, "stream")
    landing, bronze, checkpoint = f"{root}/landing", f"{root}/bronze", f"{root}/checkpoint"
    land_drifting_trips(spark, folder, landing)
    for _ in range(2):
        ingest_files(
            spark, landing, bronze, checkpoint, BRONZE_YELLOW, fresh_run_name(), files_per_batch=100
        )
    return spark.read.schema(BRONZE_YELLOW.schema).parquet(bronze).select(
        "VendorID",
        "tpep_pickup_datetime",
        "tpep_dropoff_datetime",
        "passenger_count",
        "trip_distance",
        "PULocationID",
        "airport_fee",
        "_rescued_data",
    )


@query
def bronze_two_checkpoints(spark, folder):
    """Two landing folders, each with a checkpoint of its own, into one Bronze: all rows of both."""
    root = fresh_folder(spark, "streams")
    rows = table(spark, folder, "events").select(F.col("event_id").cast("int").alias("PULocationID"))
    for name, own in (("even", F.col("PULocationID") % 2 == 0), ("odd", F.coalesce(F.col("PULocationID") % 2 != 0, F.lit(True)))):
        rows.filter(own).write.parquet(f"{root}/{name}")
        ingest_files(spark, f"{root}/{name}", f"{root}/bronze", f"{root}/{name}-seen", BRONZE_YELLOW, fresh_run_name())
    return spark.read.schema(BRONZE_YELLOW.schema).parquet(f"{root}/bronze").select("PULocationID")


@query
def bronze_uniform(spark, folder):
    """Files of one known schema, streamed as rows."""
    root = fresh_folder(spark, "uniform")
    rows = table(spark, folder, "events").select(
        F.col("event_id").alias("PULocationID"), F.col("value").alias("trip_distance")
    )
    rows.write.parquet(f"{root}/landing")
    ingest_uniform(
        spark, f"{root}/landing", rows.schema, f"{root}/bronze", f"{root}/seen", BRONZE_YELLOW, fresh_run_name()
    )
    bronze = spark.read.schema(BRONZE_YELLOW.schema).parquet(f"{root}/bronze")
    return bronze.select("PULocationID", "trip_distance")


# --- The jobs --------------------------------------------------------------------------------


def new_lake(spark: SparkSession, root: str) -> Lake:
    return Lake(TableStore(spark, f"{root}/tables", prefix=f"lake_{uuid4().hex}"), EVENT_STUDY)


def land_trips(rows: DataFrame, root: str, name: str) -> dict[str, str]:
    """Landed files of both sources. Trips of failed events come without their distance; it is in
    their payload, for the jobs to recover."""
    failed = F.col("event_type") == "error"
    landings = {}
    for spec in (YELLOW, GREEN):
        landings[spec.name] = f"{root}/landing/{spec.name}"
        own = rows.filter(F.col("taxi_type") == spec.name)
        own = own.withColumnsRenamed(
            {"pickup_datetime": spec.pickup_column, "dropoff_datetime": spec.dropoff_column}
        ).withColumns(
            {
                "total_amount": F.col("total_amount").cast("double"),
                "_rescued_data": F.when(failed, F.to_json(F.struct("trip_distance"))),
                "trip_distance": F.when(~failed, F.col("trip_distance")),
            }
        )
        files = [c for c in spec.bronze.columns if c in own.columns]
        own.select(*files).write.parquet(f"{landings[spec.name]}/{name}/year=2024/month=01")
    return landings


def run_jobs(spark: SparkSession, folder: str) -> Lake:
    """All jobs over landed files made from the event log."""
    root = fresh_folder(spark, "lake")
    lake = new_lake(spark, root)
    run_all(lake, land_trips(trips(spark, folder), root, "one"))
    return lake


def run_to_silver(spark: SparkSession, folder: str) -> Lake:
    root = fresh_folder(spark, "lake")
    lake = new_lake(spark, root)
    landings = land_trips(trips(spark, folder), root, "one")
    for spec in lake.sources:
        landed = land_to_bronze(lake, spec, landings[spec.name])
        bronze_to_silver(lake, spec, landed["stream_batches"])
    return lake


def stored_silver(lake: Lake) -> DataFrame:
    stored = {s.name: lake.store.rows("silver", s.silver) for s in lake.sources}
    return profile.labelled_union(stored).drop("_ingestion_ts")


@query
def published_silver(spark, folder):
    """Silver trips of both sources, as stored."""
    return stored_silver(run_to_silver(spark, folder))


@query
def published_quarantine(spark, folder):
    """Quarantined rows of both sources, as stored, through the view over them."""
    name = f"q{uuid4().hex}_"
    register_views(run_jobs(spark, folder), prefix=name)
    return spark.table(f"{name}silver_quarantine_union").select(
        "taxi_type",
        "VendorID",
        "passenger_count",
        "total_amount",
        "pickup_datetime",
        "dropoff_datetime",
        F.array_join(REASONS, ",").alias("reasons"),
    )


@query
def rejudged_batches(spark, folder):
    """Batches judged for a short period, then again for the whole one: every trip is in Silver
    or set aside, none in both."""
    root = fresh_folder(spark, "lake")
    lake = new_lake(spark, root)
    short = Lake(lake.store, SHORT_STUDY)
    landings = land_trips(trips(spark, folder), root, "one")
    for spec in lake.sources:
        batches = land_to_bronze(lake, spec, landings[spec.name])["stream_batches"]
        bronze_to_silver(short, spec, batches)
        bronze_to_silver(lake, spec, batches)
    aside = {s.name: lake.store.rows("silver", s.quarantine) for s in lake.sources}
    common = ["taxi_type", "VendorID", "pickup_datetime", "dropoff_datetime"]
    kept = stored_silver(lake).select(*common, F.lit("silver").alias("side"))
    return kept.unionByName(profile.labelled_union(aside).select(*common, F.lit("aside").alias("side")))


@query
def published_fact(spark, folder):
    return run_jobs(spark, folder).store.rows("gold", FACT_TRIP).drop("_ingestion_ts")


@query
def published_fact_incremental(spark, folder):
    """Two landings and two runs of all jobs: equal to one run over both."""
    root = fresh_folder(spark, "lake")
    lake, rows = new_lake(spark, root), trips(spark, folder)
    later = F.coalesce(F.col("pickup_datetime") >= F.lit(FIRST_LOAD_ENDS), F.lit(True))
    for name, part in (("one", rows.filter(~later)), ("two", rows.filter(later))):
        run_all(lake, land_trips(part, root, name))
    return lake.store.rows("gold", FACT_TRIP).drop("_ingestion_ts")


@query
def published_hourly_mart(spark, folder):
    """The hourly mart, read by name from the catalog."""
    store = run_jobs(spark, folder).store
    return spark.table(f"{store.database('gold')}.agg_trip_hourly_daily")


@query
def published_monthly_mart(spark, folder):
    store = run_jobs(spark, folder).store
    return spark.table(f"{store.database('gold')}.agg_trip_monthly_taxi")


@query
def published_answer(spark, folder):
    """Question 2 as a user asks it: SQL over the published tables."""
    gold = run_jobs(spark, folder).store.database("gold")
    return spark.sql(
        f"""
        SELECT pickup_hour,
               round(CAST(sum(passenger_count_sum) AS DOUBLE) / nullif(sum(trip_count), 0), 4)
                 AS avg_passengers,
               sum(trip_count) AS trip_count
        FROM {gold}.agg_trip_hourly_daily JOIN {gold}.dim_date USING (date_key)
        WHERE year = {EVENT_YEAR} AND month = {EVENT_MONTH}
        GROUP BY pickup_hour
        """
    )


@query
def stored_fact_answers(spark, folder):
    """Both questions from the stored fact; the calendar's month prunes its folders at run time."""
    store = run_jobs(spark, folder).store
    fact, dates = store.read("gold", FACT_TRIP), store.read("gold", DIM_DATE)
    hourly = marts.hourly_passengers_from_fact(fact, dates, EVENT_YEAR, EVENT_MONTH)
    monthly = marts.monthly_mean_from_fact(fact, dates, "yellow")
    return hourly.select(
        F.concat(F.lit("hour "), "pickup_hour").alias("part"), F.col("avg_passengers").alias("mean"), "trip_count"
    ).unionByName(
        monthly.select(
            F.concat_ws(" ", F.lit("month"), "year", "month").alias("part"),
            F.col("avg_total_amount").alias("mean"),
            "trip_count",
        )
    )


@query
def lake_checks(spark, folder):
    """What is verified after the jobs: keys held twice in Silver and the fact, days of the calendar,
    tables that are missing, and comments that are not those of the contract."""
    lake = run_jobs(spark, folder)
    store = lake.store
    wanted = [("silver", s.silver) for s in lake.sources] + [("gold", FACT_TRIP), ("gold", DIM_DATE)]
    store.require(wanted)
    parts = {"rows_in_silver": stored_silver(lake).agg(F.count("*").alias("value"))}
    for layer, contract in wanted[:3]:
        twice = checks.duplicate_keys(store.rows(layer, contract), contract.key[0])
        parts[f"keys_twice_in_{contract.name}"] = twice.agg(F.count("*").alias("value"))
    parts["days_in_calendar"] = store.rows("gold", DIM_DATE).agg(F.count("*").alias("value"))
    described = spark.sql(f"DESCRIBE TABLE {store.table_name('gold', FACT_TRIP)}")
    stated = spark.createDataFrame(list(FACT_TRIP.column_comments.items()), "col_name string, stated string")
    same = described.join(stated, "col_name").filter("comment = stated").select("col_name").distinct()
    parts["comments_as_stated"] = same.agg(F.count("*").alias("value"))
    return profile.labelled_union(parts, "what")


@query
def view_totals(spark, folder):
    """The views over Bronze, the fact and the landed files' schemas, in SQL."""
    root, name = fresh_folder(spark, "lake"), f"v{uuid4().hex}_"
    lake = new_lake(spark, root)
    landings = land_trips(trips(spark, folder), root, "one")
    run_all(lake, landings)
    register_views(lake, landings, name)
    return spark.sql(
        f"""
        SELECT 'bronze' AS view, taxi_type, count(*) AS rows, count(_rescued_data) AS rescued
        FROM {name}bronze_union GROUP BY taxi_type
        UNION ALL
        SELECT 'fact', taxi_type, count(*), 0 FROM {name}fact_trip_view GROUP BY taxi_type
        UNION ALL
        SELECT 'landing', taxi_type, count(DISTINCT column_name), 0
        FROM {name}landing_schema_snapshot GROUP BY taxi_type
        """
    )


@query
def rescued_in_bronze(spark, folder):
    """The first rescued rows of each source's Bronze, in order of their payloads."""
    root = fresh_folder(spark, "lake")
    lake = new_lake(spark, root)
    landings = land_trips(trips(spark, folder), root, "one")
    parts = []
    for spec in (YELLOW, GREEN):
        land_to_bronze(lake, spec, landings[spec.name])
        first = rescued_examples(lake.store.read("bronze", spec.bronze), order=["_rescued_data"])
        parts.append(first.select(F.lit(spec.name).alias("taxi_type"), "_rescued_data"))
    return reduce(DataFrame.unionByName, parts)


@query
def evolved_table(spark, folder):
    """A contract gains a column between two loads; both loads are read by the table's name."""
    root = fresh_folder(spark, "evolved")
    store = TableStore(spark, root, prefix=f"evolved_{uuid4().hex}")
    old = TableContract("readings", StructType().add("event_id", "long").add("value", "double"))
    new = TableContract("readings", StructType([*old.schema.fields, StructField("kind", StringType(), True, {"comment": "Kind of event"})]))
    events = table(spark, folder, "events").withColumnRenamed("event_type", "kind")
    for contract, own in ((old, F.col("event_id") % 2 == 0), (new, F.coalesce(F.col("event_id") % 2 != 0, F.lit(True)))):
        store.create("silver", contract)
        append_rows(events.filter(own), contract, store.location("silver", contract))
        store.refresh("silver", contract)
    return spark.table(store.table_name("silver", new))
