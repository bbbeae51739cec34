"""Stored tables: Parquet folders under one root, also named in the session catalog."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from stratamart.contracts import TableContract, quoted


class TableStore:
    """Tables of the layers ``bronze``, ``silver`` and ``gold`` under ``root``.

    Jobs read and write the folders, because Spark refuses to overwrite a catalog table a query
    reads from. The catalog entry (``<prefix>_<layer>.<table>``) is for SQL users.
    """

    def __init__(self, spark: SparkSession, root: str, prefix: str = "strata") -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.prefix = prefix

    def database(self, layer: str) -> str:
        return f"{self.prefix}_{layer}"

    def table_name(self, layer: str, contract: TableContract) -> str:
        return f"{self.database(layer)}.{contract.name}"

    def location(self, layer: str, contract: TableContract) -> str:
        return f"{self.root}/{layer}/{contract.name}"

    def create(self, layer: str, contract: TableContract, buckets: int = 0) -> None:
        """Make the table if it is missing, with ``buckets`` by key if stated. Else add the columns that the
        contract has gained, refuse changed types, and bring the comments up to date."""
        database, name = self.database(layer), self.table_name(layer, contract)
        catalog = self.spark.catalog
        if catalog.tableExists(name):
            self.evolve(name, contract)
            present = {c.name: c.description for c in catalog.listColumns(name)}
            present[""] = catalog.getTable(name).description
            contract.apply_comments(self.spark, database, present)
            return
        if not buckets:  # files that are there must all be of a bucket
            self.make_folder(layer, contract)
        self.spark.sql(
            f"CREATE DATABASE IF NOT EXISTS {database} LOCATION {quoted(f'{self.root}/{layer}')}"
        )
        self.spark.sql(contract.create_table(database, self.location(layer, contract), buckets))
        if not buckets:
            self.refresh(layer, contract)

    def evolve(self, name: str, contract: TableContract) -> None:
        """Rows stored before a column was added have NULL there. A column that the contract no longer
        has stays in the table; jobs then write it no more."""
        held = {c.name.lower(): c.dataType for c in self.spark.catalog.listColumns(name)}
        wanted = {f.name: f.dataType.simpleString() for f in contract.stored_schema.fields}
        changed = [
            f"{c} is {held[c.lower()]}, not {t}" for c, t in wanted.items() if held.get(c.lower(), t) != t
        ]
        if changed:
            raise ValueError(f"{name} cannot change its types: {'; '.join(changed)}")
        new = [f"{c} {t}" for c, t in wanted.items() if c.lower() not in held]
        if new:
            self.spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(new)})")

    def make_folder(self, layer: str, contract: TableContract) -> None:
        schema = contract.stored_schema
        empty = self.spark.range(0).select(
            *(F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields)
        )
        ready = empty.write.mode("ignore").partitionBy(*contract.partition_by)
        ready.parquet(self.location(layer, contract))

    def exists(self, layer: str, contract: TableContract) -> bool:
        try:
            self.read(layer, contract)
        except AnalysisException as problem:
            if problem.getCondition() == "PATH_NOT_FOUND":
                return False
            raise
        return True

    def require(self, wanted: Iterable[tuple[str, TableContract]]) -> None:
        missing = sorted(self.table_name(*w) for w in wanted if not self.exists(*w))
        if missing:
            raise ValueError(f"missing tables: {', '.join(missing)}")

    def read(self, layer: str, contract: TableContract) -> DataFrame:
        """Contract and folder columns. The schema is given, so no file is opened to infer it."""
        schema = contract.stored_schema
        stored = self.spark.read.schema(schema).parquet(self.location(layer, contract))
        return stored.select(*schema.fieldNames())

    def rows(self, layer: str, contract: TableContract) -> DataFrame:
        """Contract columns only."""
        return self.read(layer, contract).select(*contract.columns)

    def refresh(
        self, layer: str, contract: TableContract, folders: Sequence[Row] | None = None
    ) -> None:
        """Let the catalog see files a job has written: those in ``folders``, or any at all."""
        name = self.table_name(layer, contract)
        if not self.spark.catalog.tableExists(name):
            return
        if folders is not None and all(None not in tuple(f) for f in folders):
            parts = [
                "PARTITION (" + ", ".join(f"{c} = {quoted(str(f[c]))}" for c in f.__fields__) + ")"
                for f in folders
            ]
            if parts:
                self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(parts)}")
        elif contract.partition_by:
            self.spark.catalog.recoverPartitions(name)
        self.spark.catalog.refreshTable(name)
