import pytest

from stratamart.sources import metadata


@pytest.fixture
def stored(spark, tmp_path):
    rows = spark.range(1_000).selectExpr(
        "id", "if(id % 10 = 0, null, double(id) / 4) AS price", "date_add(date'2024-01-01', int(id % 400)) AS day",
        "timestamp_seconds(id) AS at", "if(id % 3 = 0, 'a', 'b') AS kind", "int(id div 500) AS part",
    )
    rows.write.partitionBy("kind", "part").parquet(f"{tmp_path}/t")
    return f"{tmp_path}/t", rows


def test_bounds_come_out_of_footers(spark, stored):
    place, rows = stored
    found = metadata.folder_bounds(spark, place, rows.schema, ["kind", "part"], ["id", "price", "day"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), COUNT(id), MIN(id), MAX(id)" in plan and "PushedGroupBy: [kind, part]" in plan
    assert "ReadSchema: struct<kind:string,part:int,count(*):bigint" in plan  # no column of rows
    got = metadata.stored_bounds(spark, place, rows.schema, ["kind", "part"], ["id", "price", "day"], ["kind"])
    ends = [f"count({c}) AS n_{c}, min({c}) AS min_{c}, max({c}) AS max_{c}" for c in ("id", "price", "day")]
    rows.createOrReplaceTempView("all_rows")
    wanted = spark.sql(f"SELECT kind, count(*) AS rows, {', '.join(ends)} FROM all_rows GROUP BY kind")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, wanted.collect()))


def test_types_without_exact_bounds_are_refused(spark, stored):
    for column in ("at", "kind"):
        with pytest.raises(ValueError, match="no exact bounds"):
            metadata.folder_bounds(spark, stored[0], stored[1].schema, ["kind", "part"], [column])


def test_the_session_keeps_its_settings(spark, stored):
    metadata.stored_bounds(spark, stored[0], stored[1].schema, ["kind", "part"], ["id"], ["part"]).collect()
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")
