"""Table contracts: column names, types, nullability, comments, layout and checks.

A contract is a plain ``StructType`` plus what a Parquet table cannot state for itself. The
column comments live in the field metadata, so they travel with any DataFrame made from it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import SparkSession
from pyspark.sql.types import ArrayType, DataType, StringType, StructType


@dataclass(frozen=True)
class TableContract:
    """One table.

    ``key``           columns that identify a row; empty if rows have no identity
    ``partition_by``  folder column -> (type, SQL expression over the contract columns)
    ``cluster_by``    sort order inside each file, for min/max skipping
    ``checks``        check name -> SQL predicate that must be true for each row
    """

    name: str
    schema: StructType
    comment: str = ""
    key: tuple[str, ...] = ()
    partition_by: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    cluster_by: tuple[str, ...] = ()
    checks: Mapping[str, str] = field(default_factory=dict)

    def named(self, name: str) -> TableContract:
        return replace(self, name=name)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def types(self) -> dict[str, DataType]:
        return {f.name: f.dataType for f in self.schema.fields}

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]

    @property
    def column_comments(self) -> dict[str, str]:
        return {
            f.name: f.metadata["comment"] for f in self.schema.fields if "comment" in f.metadata
        }

    @property
    def folders(self) -> list[str]:
        """Folder columns that are not columns of the contract itself."""
        return [c for c in self.partition_by if c not in self.columns]

    @property
    def stored_schema(self) -> StructType:
        """All columns as read back from storage: contract columns, then folder columns.

        Parquet keeps no NOT NULL, so every stored field is nullable.
        """
        stored = StructType()
        for f in self.schema.fields:
            stored.add(f.name, f.dataType, True, f.metadata or None)
        for c in self.folders:
            stored.add(c, self.partition_by[c][0], True)
        return stored

    def create_table(self, database: str, location: str, buckets: int = 0) -> str:
        """The statement; with ``buckets``, rows are kept apart by a hash of their key."""
        lines = [
            f"  {f.name} {f.dataType.simpleString()}"
            + ("" if f.nullable else " NOT NULL")
            + _comment_clause(f.metadata.get("comment"))
            for f in self.schema.fields
        ]
        lines += [f"  {c} {self.partition_by[c][0]}" for c in self.folders]
        layout = f" PARTITIONED BY ({', '.join(self.partition_by)})" if self.partition_by else ""
        if buckets:
            layout += f" CLUSTERED BY ({', '.join(self.key)}) INTO {buckets} BUCKETS"
        return (
            f"CREATE TABLE IF NOT EXISTS {database}.{self.name} (\n"
            + ",\n".join(lines)
            + f"\n) USING PARQUET{layout} LOCATION {quoted(location)}"
            + _comment_clause(self.comment)
        )

    def comment_statements(self, database: str, present: Mapping[str, str] = {}) -> list[str]:
        """Statements that bring the comments of an existing table up to date. ``present`` holds
        comments the table already has, by column, and its own under the empty name."""
        table = f"{database}.{self.name}"
        statements = []
        if self.comment and present.get("") != self.comment:
            statements.append(f"COMMENT ON TABLE {table} IS {quoted(self.comment)}")
        for column, text in self.column_comments.items():
            # A folder column's comment is stated at creation; Spark refuses to alter it.
            if column not in self.partition_by and present.get(column) != text:
                statements.append(
                    f"ALTER TABLE {table} ALTER COLUMN {column} COMMENT {quoted(text)}"
                )
        return statements

    def apply_comments(
        self, spark: SparkSession, database: str, present: Mapping[str, str] = {}
    ) -> list[str]:
        statements = self.comment_statements(database, present)
        for statement in statements:
            spark.sql(statement)
        return statements


def quoted(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _comment_clause(text: str | None) -> str:
    return f" COMMENT {quoted(text)}" if text else ""


def _struct(*columns: Sequence) -> StructType:
    """Fields from ``(name, type[, comment])``; a type ending in ``!`` is NOT NULL."""
    built = StructType()
    for name, dtype, *comment in columns:
        required = isinstance(dtype, str) and dtype.endswith("!")
        built.add(
            name,
            dtype.rstrip("!") if isinstance(dtype, str) else dtype,
            not required,
            {"comment": comment[0]} if comment else None,
        )
    return built


# --- Fixed values: table and column names, types, check bounds -------------------------------

PROVENANCE_COLUMNS = ("_ingestion_ts", "_source_file", "_batch_id", "_rescued_data")

_PROVENANCE = (
    ("_ingestion_ts", "timestamp"),
    ("_source_file", "string"),
    ("_batch_id", "string"),
    ("_rescued_data", "string"),
)
_METER = (
    ("passenger_count", "integer"),
    ("trip_distance", "double"),
    ("RatecodeID", "integer"),
    ("store_and_fwd_flag", "string"),
    ("PULocationID", "integer"),
    ("DOLocationID", "integer"),
    ("payment_type", "integer"),
    ("fare_amount", "double"),
    ("extra", "double"),
    ("mta_tax", "double"),
    ("tip_amount", "double"),
    ("tolls_amount", "double"),
    ("improvement_surcharge", "double"),
    ("total_amount", "double"),
    ("congestion_surcharge", "double"),
    ("airport_fee", "double"),
)

# Every stream batch owns one folder, so replaying a batch replaces exactly what it wrote.
STREAM_BATCH = "_stream_batch"
_BY_STREAM_BATCH = {STREAM_BATCH: ("string", STREAM_BATCH)}

BRONZE_YELLOW = TableContract(
    "yellow_trips",
    _struct(
        ("VendorID", "integer"),
        ("tpep_pickup_datetime", "timestamp"),
        ("tpep_dropoff_datetime", "timestamp"),
        *_METER,
        *_PROVENANCE,
    ),
    partition_by=_BY_STREAM_BATCH,
)
BRONZE_GREEN = TableContract(
    "green_trips",
    _struct(
        ("VendorID", "integer"),
        ("lpep_pickup_datetime", "timestamp"),
        ("lpep_dropoff_datetime", "timestamp"),
        *_METER,
        ("ehail_fee", "double"),
        ("trip_type", "integer"),
        *_PROVENANCE,
    ),
    partition_by=_BY_STREAM_BATCH,
)
SILVER = TableContract(
    "trips",
    _struct(
        ("VendorID", "integer", "Vendor that recorded the trip"),
        ("passenger_count", "integer", "Passengers on board"),
        ("total_amount", "decimal(10,2)", "Amount charged for the trip"),
        ("pickup_datetime", "timestamp", "Start of the trip"),
        ("dropoff_datetime", "timestamp", "End of the trip"),
        ("tripsk", "string!", "Key of the trip, a hash over its business columns"),
        ("_ingestion_ts", "timestamp", "When the raw row was ingested"),
    ),
    comment="Trips that passed every quality rule",
    key=("tripsk",),
    partition_by={"pickup_date": ("date", "to_date(pickup_datetime)")},
    cluster_by=("pickup_datetime",),
)
QUARANTINE = TableContract(
    "trips_quarantine",
    _struct(
        ("VendorID", "integer", "Vendor that recorded the trip"),
        ("passenger_count", "double", "Passenger count as received"),
        ("total_amount", "double", "Amount as received"),
        ("pickup_datetime", "timestamp", "Start of the trip"),
        ("dropoff_datetime", "timestamp", "End of the trip"),
        ("_ingestion_ts", "timestamp", "When the raw row was ingested"),
        ("_quarantined_at", "timestamp", "When the row was set aside"),
        ("_rejection_reasons", ArrayType(StringType()), "Names of the rules the row broke"),
    ),
    comment="Trips that broke at least one quality rule, with the rules they broke",
    # By the Bronze batch a row came in with: reprocessing a batch replaces its rejects.
    partition_by=_BY_STREAM_BATCH,
)
DIM_DATE = TableContract(
    "dim_date",
    _struct(
        ("date_key", "integer", "Day as the number yyyymmdd"),
        ("full_date", "date", "Day"),
        ("year", "integer", "Year"),
        ("quarter", "integer", "Quarter of the year"),
        ("month", "integer", "Month of the year"),
        ("day", "integer", "Day of the month"),
        ("day_of_week", "integer", "Day of the week, Sunday is 1"),
        ("week_of_year", "integer", "ISO week"),
        ("is_weekend", "boolean", "Saturday or Sunday"),
    ),
    comment="One row per day of the study period",
    key=("date_key",),
)
DIM_VENDOR = TableContract(
    "dim_vendor",
    _struct(
        ("vendor_id", "integer", "Vendor number used in the trips"),
        ("vendor_name", "string", "Full name"),
        ("vendor_short_name", "string", "Short name"),
    ),
    comment="Known vendors",
    key=("vendor_id",),
)
FACT_TRIP = TableContract(
    "fact_trip",
    _struct(
        ("tripsk", "string!", "Key of the trip"),
        ("date_key", "integer", "Pickup day, key of dim_date"),
        ("vendor_id", "integer", "Vendor, key of dim_vendor"),
        ("passenger_count", "integer", "Passengers on board"),
        ("total_amount", "decimal(10,2)", "Amount charged for the trip"),
        ("pickup_datetime", "timestamp", "Start of the trip"),
        ("dropoff_datetime", "timestamp", "End of the trip"),
        ("duration_seconds", "long", "Whole seconds between start and end"),
        ("taxi_type", "string", "Source the trip came from"),
        ("_ingestion_ts", "timestamp", "When the raw row was ingested"),
    ),
    comment="All trips of all sources, one row each",
    key=("tripsk",),
    partition_by={"taxi_type": ("string", "taxi_type"), "date_key": ("integer", "date_key")},
    cluster_by=("pickup_datetime",),
    checks={
        "ck_positive_amount": "total_amount >= 0",
        "ck_valid_passenger": "passenger_count > 0",
        "ck_valid_duration": "duration_seconds >= 0",
    },
)
_MEASURES = (
    ("trip_count", "long", "Number of trips"),
    ("total_amount_sum", "decimal(18,2)", "Sum of total_amount"),
    ("passenger_count_sum", "long", "Sum of passenger_count"),
    ("avg_total_amount", "double", "Mean of total_amount"),
    ("avg_passenger_count", "double", "Mean of passenger_count"),
)
AGG_HOURLY_DAILY = TableContract(
    "agg_trip_hourly_daily",
    _struct(
        ("date_key", "integer", "Pickup day"),
        ("pickup_hour", "integer", "Hour of the day"),
        ("taxi_type", "string", "Source of the trips"),
        *_MEASURES,
    ),
    comment="Trips by day, hour and source",
    key=("date_key", "pickup_hour", "taxi_type"),
)
AGG_MONTHLY_TAXI = TableContract(
    "agg_trip_monthly_taxi",
    _struct(
        ("month_key", "integer", "Month as the number yyyymm"),
        ("year", "integer", "Year"),
        ("month", "integer", "Month of the year"),
        ("taxi_type", "string", "Source of the trips"),
        *_MEASURES,
    ),
    comment="Trips by month and source",
    key=("month_key", "taxi_type"),
)
