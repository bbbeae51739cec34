import math
import random
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from stratamart.operators import profile
from stratamart.sources.footers import footer_reader, list_files, read_footers, signatures, snapshot


def brute(values, points=profile.POINTS):
    ordered = sorted(v for v in values if v is not None)
    return [ordered[math.ceil(round(p * len(ordered), 9)) - 1] for p in points]


@pytest.mark.parametrize("shape", ["uniform", "one value", "few", "skewed", "single row"])
def test_exact_percentiles_against_a_sort(spark, shape):
    rng = random.Random(shape)
    rows = {
        "uniform": [("a", rng.uniform(-5, 5)) for _ in range(3000)],
        "one value": [("a", 2.5)] * 500,
        "few": [("a", float(rng.randint(0, 3))) for _ in range(700)],
        "skewed": [("a", 0.0)] * 900 + [("a", rng.expovariate(0.01)) for _ in range(100)],
        "single row": [("a", 1.0)],
    }[shape] + [("b", float(i)) for i in range(1, 101)] + [("b", None)]
    df = spark.createDataFrame(rows, "taxi_type string, x double")
    for accuracy in (10_000, 50):
        out = profile.exact_percentiles(df, "x", accuracy=accuracy).collect()
        assert [r.taxi_type for r in out] == ["a", "b"]
        for row in out:
            values = [v for t, v in rows if t == row.taxi_type and v is not None]
            assert list(row)[1:] == [min(values), *brute(values), max(values)]


def test_exact_percentiles_of_many_values(spark):
    """Brackets hold a small part of the rows; null is a group like others."""
    df = spark.range(200_000).select(F.lit(None).cast("string").alias("taxi_type"), F.col("id").alias("x"))
    row = profile.exact_percentiles(df, "x", accuracy=200).first()
    assert list(row) == [None, 0, 99_999, 189_999, 197_999, 199_999]
    empty = profile.exact_percentiles(df.limit(0), "x")
    assert empty.isEmpty() and len(empty.columns) == 6


def test_approx_percentiles_and_rounding(spark):
    df = spark.createDataFrame([("a", i / 3) for i in range(1, 101)], "taxi_type string, x double")
    row = profile.approx_percentiles(df, "x", digits=2).first()
    assert row.asDict() == {
        "taxi_type": "a",
        "min_x": 1 / 3,
        "p50_x": 16.67,
        "p95_x": 31.67,
        "p99_x": 33.0,
        "max_x": 100 / 3,
    }
    assert profile.point_name(0.999) == "p99_9" and profile.point_name(0.1) == "p10"


def test_union_has_common_names(spark):
    held = ", ".join(
        f"1 AS {c}"
        for c in profile.BRONZE_UNION_COLUMNS
        if c not in ("pickup_datetime", "dropoff_datetime")
    )
    yellow = spark.sql(f"SELECT {held}, 1 AS tpep_pickup_datetime, 2 AS tpep_dropoff_datetime")
    green = spark.sql(f"SELECT {held}, 3 AS lpep_pickup_datetime, 4 AS lpep_dropoff_datetime")
    both = profile.bronze_union(
        {
            "yellow": (yellow, "tpep_pickup_datetime", "tpep_dropoff_datetime"),
            "green": (green, "lpep_pickup_datetime", "lpep_dropoff_datetime"),
        }
    )
    assert both.columns == ["taxi_type", *profile.BRONZE_UNION_COLUMNS]
    found = both.select("taxi_type", "pickup_datetime", "dropoff_datetime").collect()
    assert sorted(map(tuple, found)) == [("green", 3, 4), ("yellow", 1, 2)]


def test_top_rows_are_taken_without_a_full_sort(spark):
    top = profile.top_rows(spark.range(1000), [F.desc("id")], 3)
    assert [r.id for r in top.collect()] == [999, 998, 997]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()


def test_reasons_are_grouped_as_arrays(spark):
    df = spark.createDataFrame(
        [("a", ["x", "y"]), ("a", ["x", "y"]), ("a", ["x"])],
        "taxi_type string, _rejection_reasons array<string>",
    )
    found = [tuple(r) for r in profile.reason_counts(df).collect()]
    assert found == [("a", ["x", "y"], 2), ("a", ["x"], 1)]


def test_drift_is_seen_in_footers(spark, tmp_path):
    root = tmp_path / "landing with space"
    base = spark.range(3).selectExpr("nullif(id, -1) AS VendorID", "nullif('t', '') AS name")
    base.write.parquet(f"{root}/yellow/year=2023/month=1")
    base.withColumn("VendorID", F.col("VendorID").cast("int")).write.parquet(
        f"{root}/yellow/year=2023/month=2"
    )
    base.write.parquet(f"{root}/green/year=2023/month=1")
    footers = read_footers(list_files(spark, str(root)))
    seen = snapshot(footers)
    assert seen.count() == 6
    assert profile.schema_listing(seen).first().asDict() == {
        "source": "green",
        "period": "2023-01",
        "column_name": "VendorID",
        "data_type": "bigint",
        "nullable": True,
    }
    (row,) = profile.type_drift(seen).collect()
    assert (row.source, row.column_name, row.distinct_types) == ("yellow", "VendorID", 2)
    assert row.observed_types == ["2023-01 -> bigint", "2023-02 -> int"]
    assert signatures(footers).select("signature").distinct().count() == 2


def test_executors_need_no_package_of_ours(tmp_path):
    """The function sent to the tasks loads in an interpreter that cannot import this library."""
    from pyspark import cloudpickle

    sent = tmp_path / "function"
    sent.write_bytes(cloudpickle.dumps(footer_reader()))
    code = (
        "import sys; from pyspark import cloudpickle; "
        "read = cloudpickle.loads(open(sys.argv[1], 'rb').read()); "
        "assert list(read(iter([]))) == []; assert 'stratamart' not in sys.modules"
    )
    subprocess.run([sys.executable, "-c", code, str(sent)], cwd=tmp_path, check=True)


@pytest.mark.parametrize("kind", ["INT96", "TIMESTAMP_MICROS", "TIMESTAMP_MILLIS"])
def test_instants_are_told_from_plain_times(spark, tmp_path, kind):
    name = "spark.sql.parquet.outputTimestampType"
    before = spark.conf.get(name)
    spark.conf.set(name, kind)
    try:
        zoned = spark.sql("SELECT TIMESTAMP '2023-01-01 10:00:00' AS at")
        zoned.write.parquet(str(tmp_path / "in" / "s/year=2023/month=1"))
        plain = spark.sql("SELECT TIMESTAMP_NTZ '2023-01-01 10:00:00' AS at")
        plain.write.parquet(str(tmp_path / "in" / "s/year=2023/month=2"))
    finally:
        spark.conf.set(name, before)
    (row,) = profile.type_drift(snapshot(read_footers(list_files(spark, str(tmp_path / "in"))))).collect()
    assert row.observed_types == ["2023-01 -> timestamp", "2023-02 -> timestamp_ntz"]


def test_footer_types_are_those_spark_reports(spark, tmp_path):
    df = spark.sql(
        "SELECT true AS a, 1Y AS b, 1S AS c, 1 AS d, 1L AS e, 1.0F AS f, 1.0D AS g, 'x' AS h, "
        "DATE '2023-01-01' AS i, TIMESTAMP_NTZ '2023-01-01' AS j, CAST(1 AS DECIMAL(10,2)) AS k, "
        "CAST(1 AS DECIMAL(38,0)) AS l, X'00' AS m, TIMESTAMP '2023-01-01' AS n"
    )
    df.write.parquet(str(tmp_path / "t"))
    footers = read_footers(list_files(spark, str(tmp_path / "t"))).orderBy("position").collect()
    assert [(r.column_name, r.data_type) for r in footers] == [
        (f.name, f.dataType.simpleString()) for f in df.schema
    ]
