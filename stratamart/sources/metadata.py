"""Row counts and bounds of stored tables out of their files' metadata: no column is read."""

from __future__ import annotations

from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, DecimalType, NumericType, StructType

from stratamart.session import shared_dir

# What makes Spark answer MIN, MAX and COUNT from Parquet footers.
PUSHDOWN = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


def folder_bounds(spark: SparkSession, location: str, schema: StructType, folders: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per folder of a Parquet table: ``rows``, and ``n_``, ``min_`` and ``max_`` of each column, computed lazily in a session
    of its own that reads footers. ``folders`` are all of the table's folder columns, as the pushdown asks for. Numbers
    that are not decimals, booleans and dates have exact bounds in footers; for other types use ``profile.bounds``.
    """
    for c in columns:
        kind = schema[c].dataType
        if isinstance(kind, DecimalType) or not isinstance(kind, (NumericType, DateType, BooleanType)):
            raise ValueError(f"footers state no exact bounds of {c}, which is {kind.simpleString()}")
    own = spark.newSession()
    for name, value in PUSHDOWN.items():
        own.conf.set(name, value)
    ends = [F.count("*").alias("rows")]
    for c in columns:
        ends += [F.count(c).alias(f"n_{c}"), F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    return own.read.schema(schema).parquet(location).groupBy(*folders).agg(*ends)


def stored_bounds(
    spark: SparkSession, location: str, schema: StructType, folders: Sequence[str], columns: Sequence[str], by: Sequence[str]
) -> DataFrame:
    """The same per group of ``by``, some of the folder columns: a table of one row per folder is aggregated again. What the
    footers say is staged, so that the result belongs to ``spark`` and its folders are not listed again."""
    found = folder_bounds(spark, location, schema, folders, columns)
    path = f"{shared_dir(spark)}/stage/bounds-{uuid4().hex}"
    found.write.parquet(path)
    held = spark.read.schema(found.schema).parquet(path)
    whole = [F.sum("rows").alias("rows")]
    for c in columns:
        whole += [F.sum(f"n_{c}").alias(f"n_{c}"), F.min(f"min_{c}").alias(f"min_{c}"), F.max(f"max_{c}").alias(f"max_{c}")]
    return held.groupBy(*by).agg(*whole)
