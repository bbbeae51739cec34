"""Incremental ingestion of landed files: each file once, in bounded runs."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from threading import Event

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratamart.contracts import STREAM_BATCH, TableContract
from stratamart.operators.conform import RESCUED
from stratamart.sources.drift import group_by_schema, landed_rows, read_landed
from stratamart.sources.footers import FILE_SCHEMA

FILES_PER_BATCH = 10_000

# The file source forgets, and then ignores, files much older than the newest one; its default of
# a week would drop a late copy of an old month without a word.
FILE_AGE = "36500d"


@dataclass
class Landed:
    """What one run of an ingestion has written: its folders in Bronze, and their rows."""

    folders: list[str] = field(default_factory=list)
    rows: int = 0
    rescued_rows: int = 0


def fresh_run_name() -> str:
    """A name that no other run has. When a row came in is stated next to it."""
    return f"run-{uuid.uuid4()}"


def landed_paths(spark: SparkSession, landing: str, files_per_batch: int) -> DataFrame:
    """A stream of file names. The streaming source remembers in its checkpoint which files it
    has handed out; the content column is not selected, hence not read."""
    return (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .option("maxFileAge", FILE_AGE)
        .load(landing)
        .select("path")
    )


def ingest_files(
    spark: SparkSession,
    landing: str,
    bronze: str,
    checkpoint: str,
    contract: TableContract,
    batch_id: str,
    files_per_batch: int = FILES_PER_BATCH,
) -> Landed:
    """Ingest every file that is new below ``landing``, whatever its schema, then stop.

    A stream batch writes to a folder that is named after its checkpoint's stream and its number.
    A batch that is replayed after a failure lists the same files and overwrites that folder, so no
    row is lost or doubled; another checkpoint is another stream, whose folders never collide.
    """

    def land(paths: DataFrame, folder: str) -> tuple[int, int]:
        groups = group_by_schema(paths)
        if not groups:
            return 0, 0
        return _write(read_landed(paths.sparkSession, groups, contract, batch_id), f"{bronze}/{STREAM_BATCH}={folder}")

    return _run(landed_paths(spark, landing, files_per_batch), land, checkpoint)


def _write(rows: DataFrame, folder: str) -> tuple[int, int]:
    """Write one batch, and count it on the way: ``(rows, rows with a payload)``."""
    seen = Observation()
    rows.observe(
        seen, F.count("*").alias("rows"), F.count_if(F.col(RESCUED).isNotNull()).alias("rescued_rows")
    ).write.mode("overwrite").parquet(folder)
    return seen.get["rows"], seen.get["rescued_rows"]


def parquet_stream(
    spark: SparkSession, landing: str, schema: StructType, files_per_batch: int = FILES_PER_BATCH
) -> DataFrame:
    """A stream of rows, for a feed whose files all have ``schema``."""
    return (
        spark.readStream.schema(schema)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .option("maxFileAge", FILE_AGE)
        .parquet(landing)
    )


def ingest_uniform(
    spark: SparkSession,
    landing: str,
    schema: StructType,
    bronze: str,
    checkpoint: str,
    contract: TableContract,
    batch_id: str,
    files_per_batch: int = FILES_PER_BATCH,
) -> Landed:
    """Like :func:`ingest_files` for files of one known schema: rows are streamed directly and
    no footer is looked at."""
    raw = parquet_stream(spark, landing, schema, files_per_batch)
    rows = landed_rows(raw, contract, batch_id)

    def land(batch: DataFrame, folder: str) -> tuple[int, int]:
        return _write(batch, f"{bronze}/{STREAM_BATCH}={folder}")

    return _run(rows, land, checkpoint)


def _run(
    stream: DataFrame, land: Callable[[DataFrame, str], tuple[int, int]], checkpoint: str
) -> Landed:
    done, started = Landed(), Event()

    def land_and_note(batch: DataFrame, number: int) -> None:
        started.wait()
        # The stream's id is kept in its checkpoint, so it outlives restarts.
        folder = f"{query.id}-{number:09d}"
        rows, rescued = land(batch, folder)
        done.folders.append(folder)
        done.rows += rows
        done.rescued_rows += rescued

    query = (
        stream.writeStream.foreachBatch(land_and_note)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    started.set()
    query.awaitTermination()
    return done


def rescued_examples(bronze: DataFrame, limit: int = 3, order: Sequence[str] = ()) -> DataFrame:
    """A few rows with a payload: any, or the first in an order."""
    found = bronze.filter(F.col(RESCUED).isNotNull()).select("_source_file", RESCUED)
    return (found.orderBy(*order) if order else found).limit(limit)
