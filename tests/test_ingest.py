import os
import time
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from stratamart.contracts import BRONZE_YELLOW
from stratamart.sources.drift import landed_rows
from stratamart.sources.footers import list_files, read_footers
from stratamart.streaming.bronze import (
    ingest_files,
    ingest_uniform,
    fresh_run_name,
    rescued_examples,
)


@pytest.fixture
def places(tmp_path):
    return {
        "landing": str(tmp_path / "landing"),
        "bronze": str(tmp_path / "bronze"),
        "checkpoint": str(tmp_path / "checkpoint"),
    }


def land(spark, places, name, columns):
    spark.range(4).selectExpr(*columns).coalesce(1).write.parquet(f"{places['landing']}/{name}")


def run(spark, places, batch_id="b", **limits):
    return ingest_files(
        spark,
        places["landing"],
        places["bronze"],
        places["checkpoint"],
        BRONZE_YELLOW,
        batch_id,
        **limits,
    )


def ingest(spark, places, batch_id="b", **limits):
    run(spark, places, batch_id, **limits)
    return spark.read.parquet(places["bronze"])


WIDE = ["id AS VendorID", "CAST(id AS DOUBLE) AS passenger_count", "0.5D AS airport_fee"]
NARROW = ["CAST(id AS INT) AS VendorID", "id AS passenger_count", "1.5D AS Airport_fee"]
SHORT = ["id AS VendorID", "id AS passenger_count"]


def test_drifting_files_become_one_table(spark, places):
    land(spark, places, "year=2023/month=01", WIDE)
    land(spark, places, "year=2023/month=02", NARROW)
    land(spark, places, "year=2023/month=03", SHORT)
    landed = run(spark, places)
    assert (landed.rows, landed.rescued_rows, len(landed.folders)) == (12, 8, 1)
    bronze = spark.read.parquet(places["bronze"])
    assert bronze.columns == [*BRONZE_YELLOW.columns, "_stream_batch"]
    assert bronze.count() == 12
    assert bronze.agg(F.sum("VendorID"), F.sum("passenger_count")).first()[:] == (18, 18)
    fees = {r[0]: r[1] for r in bronze.groupBy("airport_fee").count().collect()}
    assert fees == {0.5: 4, 1.5: 4, None: 4}
    payloads = {r._rescued_data for r in rescued_examples(bronze, 100).collect()}
    assert '{"Airport_fee":1.5}' in payloads and '{"passenger_count":3.0}' in payloads
    assert rescued_examples(bronze).count() == 3
    sources = [r[0] for r in bronze.select("_source_file").distinct().collect()]
    assert len(sources) == 3 and all("month=0" in s for s in sources)
    assert bronze.filter("_ingestion_ts IS NULL OR _batch_id <> 'b'").isEmpty()


def test_a_file_is_ingested_once(spark, places):
    land(spark, places, "one", WIDE)
    assert ingest(spark, places, "first").count() == 4
    assert ingest(spark, places, "second").count() == 4
    land(spark, places, "two", NARROW)
    rows = ingest(spark, places, "third").groupBy("_batch_id").count().collect()
    assert {r[0]: r[1] for r in rows} == {"first": 4, "third": 4}


def test_another_checkpoint_leaves_what_is_there(spark, places):
    """Also one at the same place, after the old one has been removed."""
    land(spark, places, "one", WIDE)
    first = run(spark, places)
    other = {**places, "checkpoint": places["checkpoint"] + "-new"}
    land(spark, places, "two", NARROW)
    second = run(spark, other)
    assert (first.rows, second.rows) == (4, 8) and not set(first.folders) & set(second.folders)
    assert spark.read.parquet(places["bronze"]).count() == 12


def test_a_late_old_file_is_not_forgotten(spark, places):
    land(spark, places, "new", WIDE)
    ingest(spark, places, "first")
    land(spark, places, "old", NARROW)
    long_ago = time.time() - 400 * 24 * 3600
    for file in Path(places["landing"], "old").iterdir():
        os.utime(file, (long_ago, long_ago))
    assert ingest(spark, places, "second").count() == 8


def test_files_of_other_writers(spark, places):
    """An all-null column, a dictionary column, odd characters in the path."""
    folder = Path(places["landing"], "100%41 done")
    folder.mkdir(parents=True)
    columns = {
        "VendorID": pa.array([1, 2], pa.int64()),
        "airport_fee": pa.nulls(2),
        "store_and_fwd_flag": pa.array(["Y", "N"]).dictionary_encode(),
    }
    pq.write_table(pa.table(columns), folder / "a.parquet")
    footers = read_footers(list_files(spark, places["landing"])).orderBy("position").collect()
    assert [r.data_type for r in footers] == ["bigint", "int", "string"]
    rows = ingest(spark, places).orderBy("VendorID").collect()
    assert [(r.VendorID, r.airport_fee, r.store_and_fwd_flag) for r in rows] == [
        (1, None, "Y"),
        (2, None, "N"),
    ]
    assert {r._rescued_data for r in rows} == {None}


def test_a_payload_from_upstream_is_used(spark, places):
    columns = ["id AS VendorID", """concat('{"passenger_count":', id, '.0}') AS _rescued_data"""]
    land(spark, places, "one", columns)
    rows = ingest(spark, places)
    assert rows.filter("passenger_count = VendorID").count() == 4
    assert rows.filter("_rescued_data IS NULL").isEmpty()


def test_fresh_rows_are_not_searched_for_json(spark, places):
    land(spark, places, "one", WIDE)
    raw = spark.read.parquet(f"{places['landing']}/one")
    plan = landed_rows(raw, BRONZE_YELLOW, "b")._jdf.queryExecution().executedPlan().toString()
    assert "parseJson" not in plan


def test_runs_are_cut_into_bounded_batches(spark, places):
    for i in range(5):
        land(spark, places, f"f{i}", WIDE)
    bronze = ingest(spark, places, files_per_batch=2)
    assert bronze.count() == 20
    assert bronze.select("_stream_batch").distinct().count() == 3


def test_a_replayed_batch_leaves_no_copy(spark, places, monkeypatch):
    """The sink fails after it has written: the batch runs again and overwrites its own folder."""
    from stratamart.streaming import bronze as module

    land(spark, places, "one", WIDE)
    written = module._run

    def failing(stream, land_batch, checkpoint):
        def crash(rows, number):
            land_batch(rows, number)
            raise RuntimeError("lost")

        return written(stream, crash, checkpoint)

    monkeypatch.setattr(module, "_run", failing)
    with pytest.raises(Exception, match="lost"):
        ingest(spark, places, "first")
    assert spark.read.parquet(places["bronze"]).count() == 4
    monkeypatch.undo()
    bronze = ingest(spark, places, "second")
    assert bronze.count() == 4
    assert bronze.select("_batch_id").distinct().first()[0] == "second"


def test_uniform_files_are_streamed_as_rows(spark, places):
    land(spark, places, "one", WIDE)
    schema = spark.read.parquet(f"{places['landing']}/one").schema
    for _ in range(2):
        ingest_uniform(
            spark,
            places["landing"],
            schema,
            places["bronze"],
            places["checkpoint"],
            BRONZE_YELLOW,
            "u",
        )
    apart = ("_ingestion_ts", "_batch_id", "_stream_batch")
    direct = spark.read.parquet(places["bronze"]).drop(*apart)
    other = {k: v + "-files" if k != "landing" else v for k, v in places.items()}
    assert direct.exceptAll(ingest(spark, other).drop(*apart)).isEmpty()
    assert direct.count() == 4


def test_batch_ids_differ():
    assert len({fresh_run_name() for _ in range(100)}) == 100
