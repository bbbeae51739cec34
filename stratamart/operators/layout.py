"""How tables are laid out in files, and the ways of writing them."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.contracts import TableContract
from stratamart.session import shared_dir


def with_folders(df: DataFrame, contract: TableContract) -> DataFrame:
    """Add the folder columns that are computed from contract columns, where absent."""
    held = set(df.columns)
    new = [c for c in contract.folders if c not in held]
    return df.withColumns(
        {c: F.expr(contract.partition_by[c][1]).cast(contract.partition_by[c][0]) for c in new}
    ) if new else df


def laid_out(df: DataFrame, contract: TableContract) -> DataFrame:
    """Gather each folder's rows into a few tasks and sort them for min/max skipping.

    ``rebalance`` lets AQE join small folders into one task and split a folder that holds a
    large share of all rows over many, so neither tiny files nor one endless task results.
    """
    df = with_folders(df, contract)
    if contract.partition_by:
        df = df.hint("rebalance", *contract.partition_by)
    order = [*contract.partition_by, *contract.cluster_by]
    return df.sortWithinPartitions(*order) if contract.cluster_by else df


def replace_folders(
    df: DataFrame, contract: TableContract, location: str, only: str = "dynamic"
) -> None:
    """Replace the folders ``df`` has rows for and leave all others alone; or, with
    ``only="static"``, leave nothing else."""
    (
        laid_out(df.select(*contract.stored_schema.fieldNames()), contract)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", only)
        .partitionBy(*contract.partition_by)
        .parquet(location)
    )


def append_rows(df: DataFrame, contract: TableContract, location: str) -> None:
    whole = with_folders(df, contract).select(*contract.stored_schema.fieldNames())
    (
        laid_out(whole, contract)
        .write.mode("append")
        .partitionBy(*contract.partition_by)
        .parquet(location)
    )


def replace_table(df: DataFrame, contract: TableContract, location: str) -> None:
    """Replace a whole table by ``df``, matched by column name and cast to the contract.

    An overwrite clears the table before its job runs. The result is therefore computed into the
    shared folder first: what fails, fails while the old table still stands. Meant for the
    small, rebuilt tables (dimensions and marts).
    """
    ready = df.select(*(F.col(n).cast(t).alias(n) for n, t in contract.types.items()))
    staged = stage(ready, contract.name)
    staged.hint("rebalance").write.mode("overwrite").parquet(location)


def insert_by_position(df: DataFrame, table: str) -> None:
    """Replace the folders of a catalog table that ``df`` has rows for. Columns go by their place, whatever they are
    called, and folder columns come last, as in SQL; their number and what cannot be cast is refused by Spark.
    Other folders stay. The catalog knows new folders at once; tasks write to a staging folder that replaces the old
    ones once all have finished."""
    spark = df.sparkSession
    # This way of writing takes the mode from the session alone.
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    spark.conf.set(name, "dynamic")
    try:
        df.write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(name, before)


def stage(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends there, the columns
    can be pruned, and later passes do not recompute it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/stage/{name}-{uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
