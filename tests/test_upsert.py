from datetime import date, datetime, timedelta, timezone
from decimal import Decimal

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from stratamart.contracts import DIM_VENDOR, QUARANTINE, SILVER
from stratamart.operators import layout
from stratamart.operators.dims import vendors
from stratamart.operators.upsert import in_folders, merge_rows, upsert
from stratamart.sources.tables import TableStore


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "lake"), prefix=f"t_{tmp_path.name.replace('-', '_')}")


def loads(spark, first, last, stamp):
    """One trip per number, on a day that follows from the number."""
    start = datetime(2023, 1, 1, tzinfo=timezone.utc)
    rows = []
    for i in range(first, last):
        pickup = start + timedelta(days=i // 10, minutes=i)
        end = pickup + timedelta(minutes=5)
        rows.append((1, 1, Decimal("1.00"), pickup, end, f"k{i}", start + timedelta(days=stamp)))
    return spark.createDataFrame(rows, SILVER.schema)


def stamps(df):
    return {r.tripsk: r._ingestion_ts.day for r in df.collect()}


def test_merge_keeps_updates_and_inserts(spark):
    merged = merge_rows(loads(spark, 0, 20, 0), loads(spark, 10, 30, 1), SILVER.key)
    expected = {f"k{i}": 1 if i < 10 else 2 for i in range(30)}
    assert stamps(merged) == expected and merged.count() == 30


def test_a_null_key_matches_nothing(spark):
    target = spark.createDataFrame([(None, 1), ("a", 1)], "k string, v int")
    source = spark.createDataFrame([(None, 2), ("a", 2)], "k string, v int")
    found = sorted(map(str, merge_rows(target, source, ["k"]).collect()))
    assert found == ["Row(k='a', v=2)", "Row(k=None, v=1)", "Row(k=None, v=2)"]


def test_stored_upsert_is_idempotent(spark, store):
    store.create("silver", SILVER)
    expected = {f"k{i}": 1 if i < 15 else 2 for i in range(35)}
    for first, last, stamp in ((0, 25, 0), (15, 35, 1), (15, 35, 1)):
        report = upsert(store, "silver", SILVER, loads(spark, first, last, stamp))
        assert report.rows == last - first
    assert stamps(store.rows("silver", SILVER)) == expected
    named = spark.table(store.table_name("silver", SILVER))
    assert named.count() == 35
    assert named.filter("pickup_date = DATE '2023-01-02'").count() == 10


def test_only_touched_folders_are_rewritten(spark, store):
    store.create("silver", SILVER)
    upsert(store, "silver", SILVER, loads(spark, 0, 30, 0))
    files = lambda: {
        r.pickup_date: r.files
        for r in store.read("silver", SILVER)
        .select("pickup_date", F.input_file_name().alias("file"))
        .groupBy("pickup_date")
        .agg(F.sort_array(F.collect_set("file")).alias("files"))
        .collect()
    }
    before = files()
    upsert(store, "silver", SILVER, loads(spark, 20, 30, 1))
    after = files()
    untouched = [date(2023, 1, 1), date(2023, 1, 2)]
    assert all(before[d] == after[d] for d in untouched)
    assert before[date(2023, 1, 3)] != after[date(2023, 1, 3)]


def test_a_bad_source_changes_nothing(spark, store):
    store.create("silver", SILVER)
    upsert(store, "silver", SILVER, loads(spark, 0, 5, 0))
    twice = loads(spark, 3, 8, 1).unionByName(loads(spark, 3, 4, 1))
    with pytest.raises(ValueError, match="1 values of tripsk"):
        upsert(store, "silver", SILVER, twice)
    keyless = loads(spark, 3, 8, 1).withColumn("tripsk", F.lit(None).cast("string"))
    with pytest.raises(ValueError, match="tripsk_required: 5 rows"):
        upsert(store, "silver", SILVER, keyless)
    assert stamps(store.rows("silver", SILVER)) == {f"k{i}": 1 for i in range(5)}


def test_an_empty_source_changes_nothing(spark, store):
    store.create("silver", SILVER)
    upsert(store, "silver", SILVER, loads(spark, 0, 5, 0))
    assert upsert(store, "silver", SILVER, loads(spark, 0, 5, 0).limit(0)).rows == 0
    assert store.rows("silver", SILVER).count() == 5


def test_a_dominant_folder_is_written_by_several_tasks(spark, store, tmp_path):
    """Nine tenths of all rows lie on one day; small slices are asked for to see the split."""
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(size)
    spark.conf.set(size, "100KB")
    try:
        rows = spark.range(0, 60_000, 1, 8).select(
            F.lit(1).alias("VendorID"),
            F.lit(1).alias("passenger_count"),
            F.lit(1).cast("decimal(10,2)").alias("total_amount"),
            F.expr(
                "TIMESTAMP '2023-01-01' + make_dt_interval(if(id % 10 = 0, 1, 0), 0, id % 1440)"
            ).alias("pickup_datetime"),
            F.expr("TIMESTAMP '2023-02-01'").alias("dropoff_datetime"),
            F.sha2(F.col("id").cast("string"), 256).alias("tripsk"),
            F.expr("TIMESTAMP '2023-02-01'").alias("_ingestion_ts"),
        )
        layout.replace_folders(
            layout.with_folders(rows, SILVER), SILVER, store.location("silver", SILVER)
        )
    finally:
        spark.conf.set(size, old)
    files = (
        store.read("silver", SILVER)
        .select("pickup_date", F.input_file_name().alias("file"))
        .groupBy("pickup_date")
        .agg(F.count("*").alias("rows"), F.count_distinct("file").alias("files"))
        .orderBy("pickup_date")
        .collect()
    )
    assert [r.rows for r in files] == [54_000, 6_000]
    assert files[0].files > 4


def test_folder_predicates(spark):
    df = spark.createDataFrame(
        [("a", 1), ("a", 2), ("b", 1), ("b", None), (None, 3)], "t string, d int"
    )
    wanted = [Row(t="a", d=2), Row(t="b", d=None), Row(t=None, d=3)]
    found = df.filter(in_folders(wanted)).collect()
    assert sorted(map(str, found)) == sorted(map(str, wanted))
    assert df.filter(in_folders([])).isEmpty()


def test_folder_predicates_prune_the_listing(spark, store):
    store.create("silver", SILVER)
    upsert(store, "silver", SILVER, loads(spark, 0, 30, 0))
    one = store.read("silver", SILVER).filter(in_folders([Row(pickup_date=date(2023, 1, 2))]))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(pickup_date" in plan
    assert one.count() == 10


def test_whole_tables_are_replaced_by_name(spark, store):
    store.create("gold", DIM_VENDOR)
    shuffled = vendors(spark).select("vendor_short_name", "vendor_id", "vendor_name")
    for df in (shuffled, shuffled.filter("vendor_id < 7")):
        layout.replace_table(df, DIM_VENDOR, store.location("gold", DIM_VENDOR))
        store.refresh("gold", DIM_VENDOR)
    named = spark.table(store.table_name("gold", DIM_VENDOR))
    assert named.columns == DIM_VENDOR.columns
    assert [r.vendor_short_name for r in named.orderBy("vendor_id").collect()] == [
        "CMT",
        "VeriFone",
        "Myle",
    ]


def test_a_failing_rebuild_leaves_the_old_table(spark, store):
    layout.replace_table(vendors(spark), DIM_VENDOR, store.location("gold", DIM_VENDOR))
    broken = vendors(spark).withColumn("vendor_id", F.raise_error(F.lit("no")).cast("int"))
    with pytest.raises(Exception, match="no"):
        layout.replace_table(broken, DIM_VENDOR, store.location("gold", DIM_VENDOR))
    assert store.read("gold", DIM_VENDOR).count() == 4


def test_tables_describe_themselves(spark, store):
    for contract in (SILVER, QUARANTINE):
        store.create("silver", contract)
        store.create("silver", contract)
    listed = {r.col_name: r.comment for r in spark.sql(
        f"DESCRIBE {store.table_name('silver', SILVER)}"
    ).collect()}
    assert listed["tripsk"] == SILVER.column_comments["tripsk"]
    with pytest.raises(ValueError, match="missing tables: .*dim_vendor"):
        store.require([("silver", SILVER), ("gold", DIM_VENDOR)])
