"""Parquet footers, read on the executors: what each file says its columns are."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# What the binary-file source needs as its schema. Only `path` is ever selected, so the content
# of the files is not read.
FILE_SCHEMA = "path STRING, modificationTime TIMESTAMP, length LONG, content BINARY"
SNAPSHOT_SCHEMA = "path STRING, position INT, column_name STRING, data_type STRING, nullable BOOLEAN"

# Arrow type names and what Spark calls them.
SPARK_NAMES = {
    "null": "int",
    "bool": "boolean",
    "int8": "tinyint",
    "int16": "smallint",
    "int32": "int",
    "int64": "bigint",
    "uint8": "smallint",
    "uint16": "int",
    "uint32": "bigint",
    "uint64": "decimal(20,0)",
    "float": "float",
    "double": "double",
    "string": "string",
    "large_string": "string",
    "binary": "binary",
    "large_binary": "binary",
    "date32[day]": "date",
}


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """Paths of all Parquet files below ``root``."""
    return (
        spark.read.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path")
    )


def footer_reader() -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """The function that runs in the tasks. It is closed over all it needs, so that it travels
    to the executors as a whole and they need not have this package."""
    names = dict(SPARK_NAMES)

    def open_file(path: str):
        # Local paths, and the object stores and HDFS that Arrow knows; s3a is Arrow's s3.
        from pyarrow import fs

        if path.startswith("file:") or "://" not in path:
            return fs.LocalFileSystem().open_input_file(re.sub("^file:(//)?", "", path))
        filesystem, inner = fs.FileSystem.from_uri(re.sub("^s3[an]://", "s3://", path))
        return filesystem.open_input_file(inner)

    def spark_name(dtype) -> str:
        import pyarrow as pa

        if pa.types.is_dictionary(dtype):
            dtype = dtype.value_type
        name = str(dtype)
        if name.startswith("timestamp["):
            return "timestamp" if dtype.tz else "timestamp_ntz"
        if name.startswith("decimal128"):
            return f"decimal({dtype.precision},{dtype.scale})"
        return names.get(name, name)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.parquet as pq

        for batch in batches:
            rows = []
            for path in batch["path"]:
                with open_file(path) as file:
                    footer = pq.read_metadata(file).schema
                leaves = (footer.column(i) for i in range(len(footer)))
                # Arrow shows these without a zone; Spark writes and reads them as instants.
                instants = {leaf.path for leaf in leaves if leaf.physical_type == "INT96"}
                for position, column in enumerate(footer.to_arrow_schema()):
                    kind = "timestamp" if column.name in instants else spark_name(column.type)
                    rows.append((path, position, column.name, kind, column.nullable))
            yield pd.DataFrame(
                rows, columns=["path", "position", "column_name", "data_type", "nullable"]
            )

    return read


def read_footers(paths: DataFrame) -> DataFrame:
    """One row per file and column, with the nullability the file itself states (Spark reads
    every file column as nullable). A footer is a few kilobytes at the end of a file, so this
    costs one small read per file, spread over the tasks that list the files."""
    return paths.select("path").mapInPandas(footer_reader(), SNAPSHOT_SCHEMA)


def snapshot(footers: DataFrame) -> DataFrame:
    """``(source, period, column_name, data_type, nullable)`` of files that lie under
    ``<source>/year=YYYY/month=MM/``, once per distinct combination."""
    folder = r"([^/]+)/year=(\d+)/month=(\d+)/[^/]+$"
    part = lambda i: F.regexp_extract("path", folder, i)
    return footers.select(
        part(1).alias("source"),
        F.concat_ws("-", part(2), F.lpad(part(3), 2, "0")).alias("period"),
        "column_name",
        "data_type",
        "nullable",
    ).distinct()


def signatures(footers: DataFrame) -> DataFrame:
    """``(path, signature)``: files with equal signatures can be read under one schema."""
    entry = F.struct("position", F.concat_ws(" ", "column_name", "data_type").alias("spec"))
    ordered = F.array_sort(F.collect_list(entry))
    return footers.groupBy("path").agg(F.concat_ws(",", ordered["spec"]).alias("signature"))
