"""Files whose schemas differ: read each kind with its own schema, set aside what does not fit."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    FractionalType,
    IntegralType,
    NumericType,
    StringType,
    StructField,
    TimestampNTZType,
    TimestampType,
)

from stratamart.contracts import PROVENANCE_COLUMNS, TableContract
from stratamart.functions.casts import soft_cast
from stratamart.operators.conform import RESCUED, conform
from stratamart.sources.footers import read_footers, signatures


def fits(found: DataType, wanted: DataType) -> bool:
    """Whether a file's column is of the kind the contract expects: equal up to its width."""
    if isinstance(wanted, IntegralType):
        return isinstance(found, IntegralType)
    if isinstance(wanted, FractionalType):
        return isinstance(found, NumericType)
    if isinstance(wanted, TimestampType):
        return isinstance(found, (TimestampType, TimestampNTZType, DateType))
    if isinstance(wanted, StringType):
        return isinstance(found, StringType)
    return found == wanted


def rescue(raw: DataFrame, contract: TableContract) -> DataFrame:
    """Type what the contract knows, and record what does not fit it in a JSON payload, keyed by
    the file's own names.

    A column is recorded as a whole if its name is unknown or written in another case, or if its
    type is of another kind; a single value is recorded if it is too large for the contract
    type. What can be converted is converted as well. Rows that fit have no payload.
    """
    known = {name.lower(): (name, dtype) for name, dtype in contract.types.items()}
    keep, aside = [], []
    for field in raw.schema.fields:
        found = F.col(f"`{field.name}`")
        if field.name == RESCUED:
            continue
        if field.name in PROVENANCE_COLUMNS:
            keep.append(found)
            continue
        name, wanted = known.get(field.name.lower(), (None, None))
        if name is None:
            aside.append(found)
            continue
        from_text = isinstance(field.dataType, StringType)
        typed = soft_cast(found, wanted, from_text=from_text)
        keep.append(typed.alias(name))
        if name != field.name or not fits(field.dataType, wanted):
            aside.append(found)
        elif _narrows(field, wanted):
            lost = found.isNotNull() & typed.isNull()
            aside.append(F.when(lost, found).alias(field.name))
    payload = _payload(aside)
    if RESCUED in raw.columns:  # set aside by an earlier step already
        payload = F.coalesce(payload, F.col(RESCUED))
    return raw.select(*keep, payload.alias(RESCUED))


def landed_rows(raw: DataFrame, contract: TableContract, batch_id: str) -> DataFrame:
    """Contract rows of a raw scan, with provenance. A payload is only searched for values if the
    files came with one; what is set aside here has been converted as far as it can be."""
    stamped = provenance(raw, batch_id)
    return conform(rescue(stamped, contract), contract, recover=RESCUED in raw.columns)


def _narrows(field: StructField, wanted: DataType) -> bool:
    if field.dataType == wanted or isinstance(wanted, (TimestampType, StringType)):
        return False
    return True


def _payload(values: Sequence[Column]) -> Column:
    """JSON of the values that are there; NULL if none is."""
    if not values:
        return F.lit(None).cast("string")
    text = F.to_json(F.struct(*values))
    return F.when(text != "{}", text)


def provenance(raw: DataFrame, batch_id: str) -> DataFrame:
    """Where and when a row came in. ``_metadata`` is hidden from ``*`` and must be named."""
    return raw.select(
        "*",
        F.current_timestamp().alias("_ingestion_ts"),
        F.col("_metadata.file_path").alias("_source_file"),
        F.lit(batch_id).alias("_batch_id"),
    )


def read_landed(
    spark: SparkSession, groups: Sequence[Sequence[str]], contract: TableContract, batch_id: str
) -> DataFrame:
    """Contract rows of landed files. Each group holds files of one schema, so Spark reads it as
    one scan with that schema, taken from one footer."""
    parts = []
    for paths in groups:
        raw = spark.read.option("mergeSchema", "false").parquet(*paths)
        parts.append(landed_rows(raw, contract, batch_id))
    return reduce(DataFrame.unionByName, parts)


def group_by_schema(paths: DataFrame) -> list[list[str]]:
    """File paths grouped by schema. The driver gets the names of one batch's files, which the
    stream's file limit bounds; their footers are read on the executors."""
    found = signatures(read_footers(paths)).groupBy("signature").agg(F.collect_list("path"))
    return [sorted(row[1]) for row in found.orderBy("signature").collect()]
