"""The five jobs that take landed files to published tables. Tables are their only hand-off, so
each can be run, repeated and scheduled on its own."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stratamart.contracts import (
    AGG_HOURLY_DAILY,
    AGG_MONTHLY_TAXI,
    DIM_DATE,
    DIM_VENDOR,
    FACT_TRIP,
    STREAM_BATCH,
    TableContract,
)
from stratamart.operators import dims, facts, marts
from stratamart.operators.checks import (
    duplicate_keys,
    latest_copy,
    require_links,
    require_rows,
)
from stratamart.operators.layout import append_rows, replace_folders, replace_table, stage
from stratamart.operators.rules import REASONS, tag, trip_rules
from stratamart.operators.standardize import (
    RAW_AMOUNT,
    RAW_PASSENGERS,
    quarantine_columns,
    silver_columns,
    standardize,
)
from stratamart.operators.upsert import in_folders, upsert
from stratamart.plans.progress import Progress, folders_of
from stratamart.session import pin_utc
from stratamart.settings import SOURCES, STUDY, SourceSpec, StudyRange
from stratamart.sources.tables import TableStore
from stratamart.streaming.bronze import ingest_files, fresh_run_name, rescued_examples

CLEAN = "_clean"


@dataclass(frozen=True)
class Lake:
    """Where the tables are, what is studied, and what feeds it."""

    store: TableStore
    study: StudyRange = STUDY
    sources: Sequence[SourceSpec] = SOURCES

    @property
    def spark(self) -> SparkSession:
        return self.store.spark

    @property
    def progress(self) -> Progress:
        return Progress(self.spark, self.store.root)

    def checkpoint(self, spec: SourceSpec) -> str:
        return f"{self.store.root}/_checkpoints/{spec.name}_bronze"


def land_to_bronze(
    lake: Lake, spec: SourceSpec, landing: str, batch_id: str | None = None, **limits: int
) -> dict[str, object]:
    """New files below ``landing`` to Bronze rows with provenance; counts are those of the new rows."""
    pin_utc(lake.spark)
    store, batch_id = lake.store, batch_id or fresh_run_name()
    store.create("bronze", spec.bronze)
    landed = ingest_files(
        lake.spark,
        landing,
        store.location("bronze", spec.bronze),
        lake.checkpoint(spec),
        spec.bronze,
        batch_id,
        **limits,
    )
    store.refresh("bronze", spec.bronze)
    new = store.read("bronze", spec.bronze).filter(F.col(STREAM_BATCH).isin(landed.folders))
    return {
        "batch_id": batch_id,
        "stream_batches": landed.folders,
        "rows": landed.rows,
        "rescued_rows": landed.rescued_rows,
        "rescued_examples": rescued_examples(new).collect() if landed.rescued_rows else [],
    }


def due_batches(lake: Lake, spec: SourceSpec) -> list[str]:
    """Bronze folders that no run has judged yet, by their names in the catalog: no file is read."""
    lake.store.create("bronze", spec.bronze)
    lake.store.refresh("bronze", spec.bronze)
    held = lake.spark.sql(f"SHOW PARTITIONS {lake.store.table_name('bronze', spec.bronze)}").collect()
    judged = lake.progress.latest(f"judged {spec.name}")
    return sorted(name for r in held if (name := r[0].partition("=")[2]) not in judged)


def bronze_to_silver(
    lake: Lake,
    spec: SourceSpec,
    stream_batches: Sequence[str] | None = None,
    copies: str = "error",
    quarantine: str = "replace",
) -> dict[str, object]:
    """Bronze rows to Silver trips and quarantined rows.

    Bronze is scanned once: rows are typed, keyed and tagged with the rules they break, and
    written to the shared folder, clean and not clean apart. All later steps read the narrow
    columns staged there. ``stream_batches`` restricts the run to new Bronze folders; leaving it
    out processes all, with the same result. ``copies`` is ``error`` or ``keep_one``.
    ``quarantine`` is ``replace`` (the rows set aside replace those of an earlier run over the
    same Bronze batches) or ``append``.
    """
    store = lake.store
    store.create("silver", spec.silver)
    store.create("silver", spec.quarantine)

    pin_utc(lake.spark)
    batches = due_batches(lake, spec) if stream_batches is None else stream_batches
    bronze = store.read("bronze", spec.bronze)
    if stream_batches is not None:
        bronze = bronze.filter(F.col(STREAM_BATCH).isin(list(stream_batches)))
    tagged = tag(standardize(bronze, spec), trip_rules(lake.study)).select(
        *spec.silver.columns,
        RAW_AMOUNT,
        RAW_PASSENGERS,
        REASONS,
        STREAM_BATCH,
        (F.size(REASONS) == 0).alias(CLEAN),
    )
    seen = Observation()
    counted = tagged.observe(
        seen, F.count("*").alias("rows_in"), F.count_if(F.col(CLEAN)).alias("rows_clean")
    )
    staged = stage(counted, f"silver-{spec.name}", CLEAN)
    rows_in, rows_clean = seen.get["rows_in"], seen.get["rows_clean"]

    clean = silver_columns(staged.filter(F.col(CLEAN)), spec)
    if copies == "keep_one":
        clean = latest_copy(clean, "_ingestion_ts")
    report = upsert(store, "silver", spec.silver, clean)

    rejected = staged.filter(~F.col(CLEAN)).withColumn("_quarantined_at", F.current_timestamp())
    rows_quarantine = rows_in - rows_clean
    if quarantine == "append":
        if rows_quarantine:
            publish_quarantine(store, spec, rejected, append_rows)
    elif stream_batches is None:
        # All rows were judged anew: what was set aside before and is not now must go.
        publish_quarantine(store, spec, rejected, partial(replace_folders, only="static"))
    else:
        judged_anew(store, spec, rejected, stream_batches)

    lake.progress.note(f"silver {spec.name}", report.folders)
    lake.progress.note(f"judged {spec.name}", batches)
    return {
        "rows_in": rows_in,
        "rows_clean": rows_clean,
        "rows_quarantine": rows_quarantine,
        "quarantine_pct": rows_quarantine / max(rows_in, 1) * 100,
        "folders": report.folders,
        **verify_silver(store, spec, report.folders),
    }


def judged_anew(
    store: TableStore, spec: SourceSpec, rejected: DataFrame, stream_batches: Sequence[str]
) -> None:
    """Replace what was set aside of the given Bronze batches, also by nothing."""
    left = {r[0] for r in rejected.select(STREAM_BATCH).distinct().collect()}
    none = quarantine_columns(rejected.limit(0), spec)
    for batch in stream_batches:
        if batch not in left:
            folder = f"{store.location('silver', spec.quarantine)}/{STREAM_BATCH}={batch}"
            none.write.mode("overwrite").parquet(folder)
    if left:
        publish_quarantine(store, spec, rejected, replace_folders)
    else:
        store.refresh("silver", spec.quarantine)


def publish_quarantine(
    store: TableStore, spec: SourceSpec, rejected: DataFrame, write: Callable[..., None]
) -> None:
    rows = quarantine_columns(rejected, spec, keep=spec.quarantine.folders)
    write(rows, spec.quarantine, store.location("silver", spec.quarantine))
    store.refresh("silver", spec.quarantine)


def verify_silver(store: TableStore, spec: SourceSpec, folders: Sequence) -> dict[str, int]:
    """After the write: no key twice. A key can only be in one folder, so the folders just
    written are all that need a look; ``rows`` are the rows there."""
    written = store.read("silver", spec.silver).filter(in_folders(folders))
    twice = duplicate_keys(written, spec.silver.key[0]).count()
    if twice:
        raise ValueError(f"{twice} duplicated {spec.silver.key[0]} values in {spec.silver.name}")
    return {"rows": written.count(), "duplicated_keys": twice}


def publish_dimensions(lake: Lake) -> dict[str, int]:
    store, spark = lake.store, lake.spark
    dates, vendors = dims.study_calendar(spark, lake.study), dims.vendors(spark)
    counts = {"dim_date": require_rows(dates, lake.study.days, DIM_DATE.name)}
    for contract, rows in ((DIM_DATE, dates), (DIM_VENDOR, vendors)):
        store.create("gold", contract)
        replace_table(rows, contract, store.location("gold", contract))
        store.refresh("gold", contract)
    counts["dim_vendor"] = store.read("gold", DIM_VENDOR).count()
    return counts


def publish_fact(lake: Lake, folders: Sequence | None = None) -> dict[str, int]:
    """Silver trips of all sources to the fact. Uniqueness, checks and references to dimensions
    are verified on the source, before anything is written. ``folders`` restricts the run to
    pickup days, as :func:`bronze_to_silver` reports them; ``rows`` are the rows of the fact
    folders written."""
    store = lake.store
    store.require(("silver", spec.silver) for spec in lake.sources)
    store.create("gold", FACT_TRIP)

    def trips(spec: SourceSpec) -> DataFrame:
        stored = store.read("silver", spec.silver)
        return stored if folders is None else stored.filter(in_folders(folders))

    pin_utc(lake.spark)
    rows = facts.union_facts({spec.name: trips(spec) for spec in lake.sources}, lake.study)
    links = {
        "date_key": (store.read("gold", DIM_DATE), "date_key"),
        "vendor_id": (store.read("gold", DIM_VENDOR), "vendor_id"),
    }
    checked = require_links(rows, links)
    report = upsert(store, "gold", FACT_TRIP, rows)
    held = store.read("gold", FACT_TRIP).filter(in_folders(report.folders)).count()
    return {
        **checked,
        "rows_for_merge": checked["rows"],
        "rows": held,
        "folders": report.folders,
    }


def publish_marts(lake: Lake, folders: Sequence | None = None) -> dict[str, int]:
    """Rebuild both aggregates from one scan of the fact: months are rolled up from hours.

    ``folders`` restricts that scan to the fact folders just written, as :func:`publish_fact`
    reports them. A folder is one source on one day, which is a whole number of hourly rows, so
    the rows of all other folders stand as they are.
    """
    pin_utc(lake.spark)
    store, counts = lake.store, {}
    for contract in (AGG_HOURLY_DAILY, AGG_MONTHLY_TAXI):
        store.create("gold", contract)

    def publish(contract: TableContract, rows: DataFrame) -> DataFrame:
        replace_table(rows, contract, store.location("gold", contract))
        store.refresh("gold", contract)
        published = store.read("gold", contract)
        counts[contract.name] = published.count()
        return published

    fact, old = store.read("gold", FACT_TRIP), store.read("gold", AGG_HOURLY_DAILY)
    if folders is None:
        rows = marts.hourly_daily(fact)
    else:
        touched = in_folders(folders)
        rows = marts.hourly_daily(fact.filter(touched)).unionByName(old.filter(~touched))
    hourly = publish(AGG_HOURLY_DAILY, rows)
    publish(AGG_MONTHLY_TAXI, marts.monthly_from_hourly(hourly))
    return counts


def run_all(lake: Lake, landings: Mapping[str, str], everything: bool = False) -> dict[str, object]:
    """All jobs on each source's landing folder: the sources side by side up to Silver, then the
    shared tables.

    Each job takes what the one before has written and it has not yet taken over: new files, new Bronze
    batches, touched days. That is noted only once it is done, so a run that broke off is made up for
    by the next. ``everything`` judges all of Bronze anew and rebuilds what follows from it, as a
    changed period asks for.
    """

    def up_to_silver(spec: SourceSpec) -> dict[str, object]:
        landed = land_to_bronze(lake, spec, landings[spec.name])
        judged = bronze_to_silver(lake, spec, None if everything else due_batches(lake, spec))
        return {f"bronze_{spec.name}": landed, f"silver_{spec.name}": judged}

    results: dict[str, object] = {}
    with ThreadPoolExecutor(len(lake.sources)) as pool:
        for done in pool.map(up_to_silver, lake.sources):
            results |= done
    results["dimensions"] = publish_dimensions(lake)
    progress = lake.progress
    due = {spec.name: progress.due(f"silver {spec.name}", f"published {spec.name}") for spec in lake.sources}
    days = folders_of(sorted({item for items in due.values() for item in items}))
    if everything or days:
        results["fact"] = publish_fact(lake, None if everything else days)
        results["marts"] = publish_marts(lake, None if everything else results["fact"]["folders"])
    for name, items in due.items():
        progress.note(f"published {name}", items)
    return results
