import pytest
from pyspark.sql.types import StructField, StructType

from stratamart import contracts
from stratamart.contracts import FACT_TRIP, SILVER, TableContract, quoted
from stratamart.operators.layout import append_rows
from stratamart.sources.tables import TableStore

ALL = [c for c in vars(contracts).values() if isinstance(c, TableContract)]


class Recorder:
    def __init__(self):
        self.statements = []

    def sql(self, statement):
        self.statements.append(statement)


def test_silver_and_fact_carry_comments():
    assert SILVER.comment and FACT_TRIP.comment
    assert {"tripsk", "pickup_datetime"} <= set(SILVER.column_comments)
    assert "taxi_type" in FACT_TRIP.column_comments


def test_apply_comments_runs_every_statement():
    recorder = Recorder()
    statements = FACT_TRIP.apply_comments(recorder, "gold")
    assert statements and recorder.statements == statements
    assert any("COMMENT ON TABLE gold.fact_trip" in s for s in statements)
    assert any("ALTER TABLE gold.fact_trip ALTER COLUMN tripsk COMMENT" in s for s in statements)


def test_only_silver_and_fact_are_clustered():
    clustered = {c.name: c.cluster_by for c in ALL if c.cluster_by}
    assert clustered == {SILVER.name: ("pickup_datetime",), "fact_trip": ("pickup_datetime",)}
    assert list(FACT_TRIP.partition_by) == ["taxi_type", "date_key"]
    assert "PARTITIONED BY (taxi_type, date_key)" in FACT_TRIP.create_table("gold", "/x")
    assert "PARTITIONED BY" not in contracts.DIM_DATE.create_table("gold", "/x")


def test_keys_are_required_and_named():
    assert SILVER.required == FACT_TRIP.required == ["tripsk"]
    assert all(set(c.key) <= set(c.columns) for c in ALL)
    assert all(len(set(c.columns)) == len(c.columns) for c in ALL)


def test_a_gained_column_is_added_and_a_changed_type_refused(spark, tmp_path):
    store = TableStore(spark, str(tmp_path), prefix=f"e_{tmp_path.name.replace('-', '_')}")
    old = TableContract("t", StructType().add("n", "long"), partition_by={"p": ("long", "n % 2")})
    gained = StructField("note", StructType().add("x", "integer"), True, {"comment": "What was seen"})
    new = TableContract("t", StructType([*old.schema.fields, gained]), partition_by=old.partition_by)
    store.create("silver", old)
    append_rows(spark.range(3).toDF("n"), old, store.location("silver", old))
    store.create("silver", new)
    rows = spark.range(3, 5).selectExpr("id AS n", "named_struct('x', 7) AS note")
    append_rows(rows, new, store.location("silver", new))
    store.refresh("silver", new)
    stored = spark.table(store.table_name("silver", new))
    assert sorted((r.n, r.note and r.note.x) for r in stored.collect()) == [(0, None), (1, None), (2, None), (3, 7), (4, 7)]
    comments = {c.name: c.description for c in spark.catalog.listColumns(store.table_name("silver", new))}
    assert comments["note"] == "What was seen"
    store.create("silver", new)  # nothing left to do
    changed = TableContract("t", StructType().add("n", "string"), partition_by=old.partition_by)
    with pytest.raises(ValueError, match="n is bigint, not string"):
        store.create("silver", changed)


def test_literals_are_escaped(spark):
    text = "it's a \\ mark"
    assert spark.sql(f"SELECT {quoted(text)}").first()[0] == text
