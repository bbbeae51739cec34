from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from tests_support import STUDY, land_both, landed_rows

from stratamart.contracts import (
    AGG_HOURLY_DAILY,
    AGG_MONTHLY_TAXI,
    DIM_DATE,
    FACT_TRIP,
    QUARANTINE,
    STREAM_BATCH,
)
from stratamart.operators import marts
from stratamart.plans import jobs
from stratamart.settings import GREEN, YELLOW, StudyRange
from stratamart.sources.tables import TableStore

@pytest.fixture
def lake(spark, tmp_path):
    prefix = f"j_{tmp_path.name.replace('-', '_')}"
    return jobs.Lake(TableStore(spark, str(tmp_path / "lake"), prefix), STUDY)


@pytest.fixture
def landings(spark, tmp_path):
    return land_both(spark, tmp_path)


def test_all_jobs_twice_and_a_new_month(spark, lake, landings):
    store = lake.store
    results = jobs.run_all(lake, landings)
    for name in ("yellow", "green"):
        assert results[f"bronze_{name}"]["rows"] == 200
        # 20 without passengers, 1 that no DECIMAL(10,2) holds.
        assert results[f"silver_{name}"]["rows_quarantine"] == 21
        assert results[f"silver_{name}"]["quarantine_pct"] == 10.5
        assert results[f"silver_{name}"]["rows"] == 179
    assert results["dimensions"] == {"dim_date": STUDY.days, "dim_vendor": 4}
    results["fact"]["folders"].sort()
    assert results["fact"]["rows"] == results["fact"]["rows_for_merge"] == 358
    assert results["marts"][AGG_MONTHLY_TAXI.name] == 2

    idle = jobs.run_all(lake, landings)
    assert idle["bronze_yellow"]["rows"] == idle["silver_yellow"]["rows_in"] == 0
    assert "fact" not in idle
    again = jobs.run_all(lake, landings, everything=True)
    same = ("rows", "rows_in", "rows_clean", "rows_quarantine", "duplicated_keys")
    for name in ("silver_yellow", "silver_green"):
        assert {k: again[name][k] for k in same} == {k: results[name][k] for k in same}
    again["fact"]["folders"].sort()
    assert again["fact"] == results["fact"] and again["marts"] == results["marts"]
    rejected = store.read("silver", YELLOW.quarantine)
    assert rejected.count() == 21
    assert rejected.agg(F.max("total_amount")).first()[0] == 1e9

    landed_rows(spark, YELLOW, 2).write.parquet(f"{landings['yellow']}/year=2023/month=02")
    third = jobs.land_to_bronze(lake, YELLOW, landings["yellow"])
    assert third["rows"] == 200
    newest = store.read("bronze", YELLOW.bronze).agg(F.max(STREAM_BATCH)).first()[0]
    assert third["stream_batches"] == [newest]
    step = jobs.bronze_to_silver(lake, YELLOW, third["stream_batches"])
    assert (step["rows_in"], step["rows_clean"], step["rows"]) == (200, 179, 179)
    assert {f.pickup_date.month for f in step["folders"]} == {2}
    written = jobs.publish_fact(lake, step["folders"])
    assert written["rows"] == 179 and store.read("gold", FACT_TRIP).count() == 537
    assert {(f.taxi_type, f.date_key // 100) for f in written["folders"]} == {("yellow", 202302)}
    jobs.publish_marts(lake, written["folders"])

    # The incremental run equals a run over everything.
    whole = jobs.bronze_to_silver(lake, YELLOW)
    assert (whole["rows_in"], whole["rows"], whole["rows_quarantine"]) == (400, 358, 42)
    assert store.read("silver", YELLOW.quarantine).count() == 42
    assert jobs.publish_fact(lake)["rows"] == 537

    # Marts agree with the fact they were built from, directly and rolled up.
    fact = store.read("gold", FACT_TRIP)
    for contract, build in (
        (AGG_HOURLY_DAILY, marts.hourly_daily),
        (AGG_MONTHLY_TAXI, marts.monthly),
    ):
        stored = spark.table(store.table_name("gold", contract))
        assert stored.exceptAll(build(fact)).isEmpty()
        assert build(fact).exceptAll(stored).isEmpty()


def files_below(folder):
    return {str(p): p.stat().st_mtime_ns for p in Path(folder).rglob("*.parquet")}


def test_a_second_landing_touches_only_its_days(spark, lake, landings):
    jobs.run_all(lake, landings)
    root = Path(lake.store.root)
    before = {layer: files_below(root / layer) for layer in ("bronze", "silver")}
    fact_before = files_below(root / "gold" / "fact_trip")
    landed_rows(spark, YELLOW, 2).write.parquet(f"{landings['yellow']}/year=2023/month=02")
    scanned, stored = [], jobs.stage
    jobs.stage = lambda df, *a: (scanned.append(df.count()), stored(df, *a))[1]
    try:
        results = jobs.run_all(lake, landings)
    finally:
        jobs.stage = stored
    assert sorted(scanned) == [0, 200]  # green has nothing new, yellow only the new batch
    assert results["fact"]["rows_for_merge"] == 179
    for layer, held in before.items():
        now = files_below(root / layer)
        assert {k: now.get(k) for k in held} == held
    now = files_below(root / "gold" / "fact_trip")
    assert {k: now.get(k) for k in fact_before} == fact_before
    fact = lake.store.read("gold", FACT_TRIP)
    assert marts.hourly_daily(fact).exceptAll(lake.store.read("gold", AGG_HOURLY_DAILY)).isEmpty()
    assert fact.count() == 537


def test_a_run_that_broke_off_is_made_up_for(spark, lake, landings, monkeypatch):
    monkeypatch.setattr(jobs, "publish_marts", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        jobs.run_all(lake, landings)
    monkeypatch.undo()
    results = jobs.run_all(lake, landings)
    assert results["silver_yellow"]["rows_in"] == 0 and results["fact"]["rows_for_merge"] == 358
    assert lake.store.read("gold", AGG_HOURLY_DAILY).agg(F.sum("trip_count")).first()[0] == 358


def test_batches_judged_again_empty_their_quarantine(spark, lake, landings):
    short = jobs.Lake(lake.store, StudyRange(date(2023, 1, 1), date(2023, 1, 3)))
    batches = jobs.land_to_bronze(lake, YELLOW, landings["yellow"])["stream_batches"]
    landed_rows(spark, YELLOW, 2, 10).filter("passenger_count > 0").write.parquet(
        f"{landings['yellow']}/year=2023/month=02"
    )
    batches += jobs.land_to_bronze(lake, YELLOW, landings["yellow"])["stream_batches"]
    assert jobs.bronze_to_silver(short, YELLOW, batches)["rows_quarantine"] > 100
    assert jobs.bronze_to_silver(lake, YELLOW, batches)["rows_quarantine"] == 21
    stored = lake.store.read("silver", YELLOW.quarantine)
    assert stored.count() == 21 and stored.select(STREAM_BATCH).distinct().count() == 1
    assert lake.store.rows("silver", YELLOW.silver).count() + 21 == 209


def test_the_fact_is_pruned_by_day(spark, lake, landings):
    jobs.run_all(lake, landings)
    store = lake.store
    answer = marts.hourly_passengers_from_fact(
        store.read("gold", FACT_TRIP), store.read("gold", DIM_DATE), 2023, 1
    )
    assert "dynamicpruning" in answer._jdf.queryExecution().executedPlan().toString()
    from_mart = marts.hourly_passengers(
        store.read("gold", AGG_HOURLY_DAILY), store.read("gold", DIM_DATE), 2023, 1
    )
    assert answer.collect() == from_mart.collect()


def test_silver_needs_only_one_scan_of_bronze(spark, lake, landings):
    """Everything after staging reads staged columns, so Bronze may vanish."""
    jobs.land_to_bronze(lake, YELLOW, landings["yellow"])
    stored = jobs.stage
    scans = []

    def spy(df, name, *partition_by):
        scans.append(df._jdf.queryExecution().executedPlan().toString().count("FileScan"))
        return stored(df, name, *partition_by)

    jobs.stage = spy
    try:
        jobs.bronze_to_silver(lake, YELLOW)
    finally:
        jobs.stage = stored
    assert scans == [1]


def test_missing_silver_and_unknown_vendors_are_refused(spark, lake, landings):
    jobs.publish_dimensions(lake)
    with pytest.raises(ValueError, match="missing tables: .*green_trips, .*yellow_trips"):
        jobs.publish_fact(lake)
    odd = landed_rows(spark, YELLOW, 2).withColumn("VendorID", F.lit(99).cast("bigint"))
    odd.write.parquet(f"{landings['yellow']}/year=2023/month=02")
    for spec in (YELLOW, GREEN):
        jobs.land_to_bronze(lake, spec, landings[spec.name])
        jobs.bronze_to_silver(lake, spec)
    with pytest.raises(ValueError, match="orphans_vendor_id"):
        jobs.publish_fact(lake)
    assert lake.store.read("gold", FACT_TRIP).isEmpty()


def test_copies_are_refused_or_reduced(spark, lake, landings):
    landed_rows(spark, YELLOW, 1).write.parquet(f"{landings['yellow']}/copy")
    jobs.land_to_bronze(lake, YELLOW, landings["yellow"])
    with pytest.raises(ValueError, match="179 values of tripsk"):
        jobs.bronze_to_silver(lake, YELLOW)
    assert lake.store.read("silver", YELLOW.silver).isEmpty()
    assert lake.store.read("silver", YELLOW.quarantine).isEmpty()
    assert jobs.bronze_to_silver(lake, YELLOW, copies="keep_one")["rows"] == 179


def test_a_wider_period_empties_the_quarantine(spark, lake, landings):
    """Rows are judged anew in a run over all of Bronze, and what passes leaves the quarantine."""
    short = jobs.Lake(lake.store, StudyRange(date(2023, 1, 1), date(2023, 1, 3)))
    jobs.land_to_bronze(lake, YELLOW, landings["yellow"])
    assert jobs.bronze_to_silver(short, YELLOW)["rows_quarantine"] > 21
    assert jobs.bronze_to_silver(lake, YELLOW)["rows_quarantine"] == 21
    assert lake.store.read("silver", YELLOW.quarantine).count() == 21
    assert lake.store.rows("silver", YELLOW.silver).count() == 179


def test_quarantine_can_be_appended(spark, lake, landings):
    jobs.land_to_bronze(lake, YELLOW, landings["yellow"])
    for _ in range(2):
        jobs.bronze_to_silver(lake, YELLOW, quarantine="append")
    rejected = lake.store.rows("silver", YELLOW.quarantine)
    assert rejected.count() == 42 and rejected.columns == QUARANTINE.columns
