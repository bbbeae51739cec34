import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratamart.contracts import TableContract
from stratamart.operators import bucketed
from stratamart.operators.layout import insert_by_position
from stratamart.sources.tables import TableStore

ITEMS = TableContract(
    "items",
    StructType().add("id", "long", False).add("size", "integer").add("day", "string"),
    key=("id",),
    partition_by={"part": ("int", "int(id div 100)")},
    checks={"ck_size": "size >= 0"},
)


@pytest.fixture
def store(spark, tmp_path):
    made = TableStore(spark, str(tmp_path), prefix=f"b{tmp_path.name.replace('-', '_')}")
    made.create("silver", ITEMS, buckets=4)
    return made


def items(spark, low, high, size):
    return spark.range(low, high).select("id", F.lit(size).alias("size"), F.lit("x").alias("day"))


def test_only_touched_folders_change_and_sources_win(spark, store):
    bucketed.upsert_bucketed(store, "silver", ITEMS, items(spark, 0, 300, 1))
    bucketed.upsert_bucketed(store, "silver", ITEMS, items(spark, 250, 420, 2))
    bucketed.upsert_bucketed(store, "silver", ITEMS, items(spark, 250, 420, 2))
    table = spark.table(store.table_name("silver", ITEMS))
    assert {(r["size"], r["count"], r["low"]) for r in table.groupBy("size").agg(F.count("*").alias("count"), F.min("id").alias("low")).collect()} == {
        (1, 250, 0), (2, 170, 250)
    }
    assert bucketed.stored_duplicates(store, "silver", ITEMS).isEmpty()
    files = {f.rsplit("/", 2)[1] for f in table.inputFiles()}
    assert files == {f"part={i}" for i in range(5)}


def test_the_stored_side_is_not_shuffled(spark, store):
    bucketed.upsert_bucketed(store, "silver", ITEMS, items(spark, 0, 300, 1))
    table = spark.table(store.table_name("silver", ITEMS))
    merged = bucketed.merge_by_key(table, items(spark, 5, 9, 3).withColumn("part", F.lit(0)), ITEMS)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "SelectedBucketsCount: 4 out of 4" in plan
    assert "Exchange" not in bucketed.stored_duplicates(store, "silver", ITEMS)._jdf.queryExecution().executedPlan().toString()


def test_null_keys_match_nothing_and_bad_sources_change_nothing(spark, store):
    held = spark.createDataFrame([(1, "a"), (None, "b")], "id long, v string")
    new = spark.createDataFrame([(1, "c"), (None, "d")], "id long, v string")
    merged = bucketed.merge_by_key(held, new, ITEMS)
    assert sorted(map(str, merged.collect())) == sorted(map(str, [*new.collect(), held.collect()[1]]))
    bucketed.upsert_bucketed(store, "silver", ITEMS, items(spark, 0, 10, 1))
    for bad in (items(spark, 0, 10, -1), items(spark, 0, 5, 2).unionAll(items(spark, 3, 5, 2))):
        with pytest.raises(ValueError):
            bucketed.upsert_bucketed(store, "silver", ITEMS, bad)
    assert bucketed.upsert_bucketed(store, "silver", ITEMS, items(spark, 0, 0, 1)).rows == 0
    assert spark.table(store.table_name("silver", ITEMS)).filter("size = 1").count() == 10


def test_insert_goes_by_place_and_leaves_other_folders(spark, tmp_path):
    name = f"placed_{tmp_path.name.replace('-', '_')}"
    spark.sql(f"CREATE TABLE {name} (a STRING, b INT, part INT) USING PARQUET PARTITIONED BY (part) LOCATION '{tmp_path}/t'")
    insert_by_position(spark.createDataFrame([("x", 1, 0), ("y", 2, 1)], "a string, b int, part int"), name)
    insert_by_position(spark.createDataFrame([("z", 9, 1)], "part string, a int, b int"), name)
    assert sorted(map(tuple, spark.table(name).collect())) == [("x", 1, 0), ("z", 9, 1)]
    with pytest.raises(Exception, match="INSERT_COLUMN_ARITY_MISMATCH"):
        insert_by_position(spark.createDataFrame([("z", 9)], "a string, b int"), name)
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
