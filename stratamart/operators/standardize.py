"""Bronze rows to typed trips, and the columns Silver and its quarantine keep."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, IntegerType, TimestampType

from stratamart.functions.casts import soft_cast
from stratamart.functions.keys import trip_key
from stratamart.settings import SourceSpec

# The amount as received: DECIMAL(10,2) cannot hold every double, the quarantine can.
RAW_AMOUNT = "_raw_total_amount"
RAW_PASSENGERS = "_raw_passenger_count"


def standardize(bronze: DataFrame, spec: SourceSpec) -> DataFrame:
    """Common column names and types, plus the trip key over the typed values."""
    typed = bronze.withColumns(
        {
            RAW_AMOUNT: F.col("total_amount").cast("double"),
            RAW_PASSENGERS: F.col("passenger_count").cast("double"),
            "pickup_datetime": soft_cast(F.col(spec.pickup_column), TimestampType()),
            "dropoff_datetime": soft_cast(F.col(spec.dropoff_column), TimestampType()),
            "VendorID": soft_cast(F.col("VendorID"), IntegerType()),
            "passenger_count": soft_cast(F.col("passenger_count"), IntegerType()),
            "total_amount": soft_cast(F.col("total_amount"), DecimalType(10, 2)),
        }
    )
    return typed.withColumn("tripsk", trip_key(spec.name, spec.extra_key_columns))


def silver_columns(clean: DataFrame, spec: SourceSpec) -> DataFrame:
    return clean.select(*spec.silver.columns)


def quarantine_columns(
    quarantined: DataFrame, spec: SourceSpec, keep: Sequence[str] = ()
) -> DataFrame:
    """Quarantine contract columns with the values as they came, plus the columns in ``keep``."""
    raw = {"total_amount": RAW_AMOUNT, "passenger_count": RAW_PASSENGERS}
    held = set(quarantined.columns)

    def value(name: str, dtype: DataType) -> Column:
        source = raw.get(name, name)
        return F.col(source if source in held else name).cast(dtype).alias(name)

    return quarantined.select(
        *(value(n, t) for n, t in spec.quarantine.types.items()), *keep
    )
