from decimal import Decimal

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from stratamart.contracts import FACT_TRIP
from stratamart.operators import checks
from stratamart.operators.layout import with_folders


def keyed(spark, *keys):
    return spark.createDataFrame([Row(tripsk=k, VendorID=i) for i, k in enumerate(keys)])


def test_duplicates_are_named(spark):
    rows = keyed(spark, *"mnonpno")
    assert {tuple(r) for r in checks.duplicate_keys(rows, "tripsk").collect()} == {("n", 3), ("o", 2)}
    text = checks.duplicates_message(rows, "tripsk", 2)
    assert text.startswith("2 values of tripsk occur in more than one row") and "n (3 rows), o (2 rows)" in text
    assert checks.duplicate_keys(keyed(spark, "m", "n"), "tripsk").isEmpty()


def test_colliding_hashes_are_no_duplicates(spark, monkeypatch):
    monkeypatch.setattr(checks, "key_hash", lambda *key: F.pmod(F.xxhash64(*key), F.lit(3)))
    rows = keyed(spark, *"mnonpno")
    assert {tuple(r) for r in checks.duplicate_keys(rows, "tripsk").collect()} == {("n", 3), ("o", 2)}
    assert checks.duplicate_keys(keyed(spark, *"abcdefgh"), "tripsk").isEmpty()
    good = fact(spark, *((c, 20230101, 1, 1, 0.0) for c in "abcdefgh"))
    assert checks.inspect_source(good, FACT_TRIP).duplicated_keys == 0
    twice = fact(spark, *((c, 20230101, 1, 1, 0.0) for c in "abcdefgha"))
    assert checks.inspect_source(twice, FACT_TRIP).duplicated_keys == 1


def test_only_hashes_are_shuffled_first(spark):
    plan = checks.duplicate_keys(keyed(spark, *"mno"), "tripsk")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(tripsk") == 1 and "hashpartitioning(_groupingexpression" in plan


def test_null_keys_and_several_columns(spark):
    rows = spark.createDataFrame([(None, 1), (None, 1), (None, 2), ("a", 2)], "k string, n int")
    assert [tuple(r) for r in checks.duplicate_keys(rows, "k", "n").collect()] == [(None, 1, 2)]


def test_a_write_fails_with_the_name_of_the_check(spark, tmp_path):
    good = fact(spark, ("a", 20230101, 1, 1, 0.0), ("b", 20230102, 1, 1, 2.0))
    place = f"{tmp_path}/t"
    checks.asserted(good, FACT_TRIP).write.parquet(place)
    for row, name in ((("c", 1, 1, 1, -1.0), "ck_positive_amount"), ((None, 1, 1, 0, 1.0), "tripsk_required"), (("d", 1, 1, None, 1.0), "ck_valid_passenger")):
        with pytest.raises(Exception, match=f"fact_trip refuses a row: {name}"):
            checks.asserted(good.unionAll(fact(spark, row)), FACT_TRIP).write.mode("append").parquet(place)
    assert spark.read.parquet(place).count() == 2
    assert checks.asserted(good, FACT_TRIP).schema.fieldNames() == good.schema.fieldNames()


def test_orphan_keys_by_bitmaps(spark):
    rows = spark.createDataFrame([(k,) for k in (0, 1, -1, -1, 40_000, 2**40, 7, None, 65_536)], "k long")
    known = spark.createDataFrame([(1,), (40_000,), (5,), (None,), (-40_000,), (65_537,)], "id int")
    found = checks.orphan_keys(rows, {"k": (known, "id")})
    assert [tuple(r) for r in found.collect()] == [("k", 7, 5)]
    assert [tuple(r) for r in checks.orphan_keys(rows.limit(0), {"k": (known, "id")}).collect()] == [("k", 0, 0)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Join" not in checks.orphan_counts(rows, {"k": (known, "id")})._jdf.queryExecution().executedPlan().toString()


def test_top_duplicates_are_ordered(spark):
    df = keyed(spark, *"bbaaccc", "d")
    found = [tuple(r) for r in checks.top_duplicate_keys(df, "tripsk", 2).collect()]
    assert found == [("c", 3), ("a", 2)]


def test_keep_one(spark):
    kept = checks.keep_one(keyed(spark, *"aab"), ["tripsk"]).orderBy("tripsk").collect()
    assert [tuple(r) for r in kept] == [("a", 1), ("b", 2)]


def test_latest_copy_sorts_nothing(spark):
    rows = spark.createDataFrame(
        [("a", 1, "2024-01-02"), ("a", 1, "2024-01-05"), ("b", None, "2024-01-01")], "k string, n int, at string"
    )
    kept = checks.latest_copy(rows, "at")
    assert sorted(map(tuple, kept.collect())) == [("a", 1, "2024-01-05"), ("b", None, "2024-01-01")]
    stamped = rows.withColumn("at", F.to_timestamp("at"))
    plan = checks.latest_copy(stamped, "at")._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "Sort" not in plan


def fact(spark, *rows):
    columns = "tripsk string, date_key int, vendor_id int, passenger_count int, total_amount double"
    df = spark.createDataFrame(list(rows), columns)
    return df.select(
        "*",
        F.lit(60).cast("bigint").alias("duration_seconds"),
        F.lit("yellow").alias("taxi_type"),
    )


def test_report_and_gate(spark):
    good = fact(spark, ("a", 20230101, 1, 1, 0.0), ("b", 20230102, 1, 1, 2.0))
    report = checks.inspect_source(with_folders(good, FACT_TRIP), FACT_TRIP)
    assert report.rows == 2 and report.duplicated_keys == 0
    assert sorted(r.date_key for r in report.folders) == [20230101, 20230102]
    checks.require_sound(good, FACT_TRIP, report)

    bad = fact(spark, ("a", 20230101, 1, 0, -1.0), (None, 20230101, 1, None, 1.0))
    report = checks.inspect_source(bad, FACT_TRIP)
    assert report.violations == {
        "tripsk_required": 1,
        "ck_positive_amount": 1,
        "ck_valid_passenger": 2,
        "ck_valid_duration": 0,
    }
    with pytest.raises(ValueError, match="ck_valid_passenger: 2 rows"):
        checks.require_sound(bad, FACT_TRIP, report)
    twice = fact(spark, ("a", 20230101, 1, 1, 0.0), ("a", 20230101, 1, 1, 0.0))
    with pytest.raises(ValueError, match="1 values of tripsk"):
        checks.require_sound(twice, FACT_TRIP, checks.inspect_source(twice, FACT_TRIP))


def test_violations_agree_with_the_report(spark):
    bad = fact(spark, ("a", 20230101, 1, 0, -1.0), (None, 20230101, 1, None, 1.0))
    listed = {r.check_name: r.violations for r in checks.constraint_violations(bad, FACT_TRIP).collect()}
    assert listed == checks.inspect_source(bad, FACT_TRIP).violations


def test_orphans_count_null_keys(spark):
    rows = fact(spark, ("a", 1, 1, 1, 0.0), ("b", 2, None, 1, 0.0), ("c", 2, 9, 1, 0.0))
    vendors = spark.createDataFrame([(1,), (2,)], "vendor_id int")
    dates = spark.createDataFrame([(1,)], "date_key int")
    lost = checks.orphans(rows, "vendor_id", vendors, "vendor_id")
    assert sorted(r.tripsk for r in lost.collect()) == ["b", "c"]
    links = {"date_key": (dates, "date_key"), "vendor_id": (vendors, "vendor_id")}
    counts = checks.orphan_counts(rows, links).first().asDict()
    assert counts == {"rows": 3, "orphans_date_key": 2, "orphans_vendor_id": 2}
    with pytest.raises(ValueError, match="orphans_vendor_id"):
        checks.require_links(rows, links)
    assert checks.require_links(rows.limit(0), links)["rows"] == 0
    plan = checks.orphan_counts(rows, links)._jdf.queryExecution().executedPlan().toString()
    assert "date_key, vendor_id" not in plan  # no exchange on the combination


def test_require_rows(spark):
    assert checks.require_rows(spark.range(3), 3, "t") == 3
    with pytest.raises(ValueError, match="t should have 4 rows, found 3"):
        checks.require_rows(spark.range(3), 4, "t")


def test_decimal_amounts_pass_the_gate(spark):
    df = fact(spark, ("a", 20230101, 1, 1, 0.0)).withColumn(
        "total_amount", F.lit(Decimal("0.00")).cast("decimal(10,2)")
    )
    assert checks.inspect_source(df, FACT_TRIP).violations["ck_positive_amount"] == 0
