"""Upserts into tables that are bucketed by their key: the stored side of a merge is never shuffled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.contracts import TableContract
from stratamart.operators.checks import SourceReport, inspect_source, require_sound
from stratamart.operators.layout import insert_by_position, with_folders
from stratamart.operators.upsert import in_folders
from stratamart.sources.tables import TableStore


def merge_by_key(target: DataFrame, source: DataFrame, contract: TableContract) -> DataFrame:
    """Source rows, plus the target rows whose key the source does not hold, with the columns of the target: one full
    outer join, whose result is dealt out by key as its inputs are. A NULL key matches nothing."""
    held, new = target.alias("t"), source.withColumn("_new", F.lit(True)).alias("s")
    same = [F.col(f"t.{c}") == F.col(f"s.{c}") for c in contract.key]
    pick = lambda c: F.when(F.col("s._new"), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c)
    return held.join(new, same, "full_outer").select(*(pick(c) for c in target.columns))


def upsert_bucketed(store: TableStore, layer: str, contract: TableContract, source: DataFrame) -> SourceReport:
    """Merge ``source`` into a table that ``TableStore.create`` made with buckets; refused as a whole if the source is not
    sound.

    As in :func:`stratamart.operators.upsert.upsert` only the folders that the source touches are read and rewritten. Of
    these, a task joins one bucket with the source's rows of that bucket and writes it back: the source is shuffled
    once to the table's buckets, the table not at all.
    """
    spark, name = store.spark, store.table_name(layer, contract)
    source = with_folders(source, contract)
    report = inspect_source(source, contract)
    require_sound(source, contract, report)
    if report.rows:
        touched = spark.table(name).filter(in_folders(report.folders))
        insert_by_position(merge_by_key(touched, source, contract), name)
    return report


def stored_duplicates(store: TableStore, layer: str, contract: TableContract) -> DataFrame:
    """Keys that a bucketed table holds more than once, with their rows; counted where they are."""
    return store.spark.table(store.table_name(layer, contract)).groupBy(*contract.key).agg(F.count("*").alias("count")).filter("count > 1")
