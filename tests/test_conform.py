from datetime import datetime

from pyspark.sql.types import DoubleType, StructType

from stratamart.contracts import BRONZE_YELLOW, TableContract
from stratamart.operators.conform import conform
from stratamart.sources.drift import rescue

COUNTS = ("stops", "bags", "seats", "riders")
# Payloads, and what is in the columns before and after.
PAYLOADS = [
    ('{"stops":"12","bags":true,"unheard_of":[1,2]}', {}, (12, None, None, None)),
    ('{"Seats":4,"seats":null,"riders":2.9}', {}, (None, None, 4, 2)),
    ('{"seats":3,"Seats":8,"riders":"two"}', {}, (None, None, 3, None)),
    ('{"stops":7,"bags":{"n":1}}', {"stops": 5}, (5, None, None, None)),
    ('{"stops":7', {"bags": 1}, (None, 1, None, None)),
    ("[7]", {"riders": 6}, (None, None, None, 6)),
    (None, {"seats": 2}, (None, None, 2, None)),
]


def test_values_come_back_from_the_payload(spark):
    rows = [(i, *(held.get(c) for c in COUNTS), text) for i, (text, held, _) in enumerate(PAYLOADS)]
    columns = ", ".join(f"{c} int" for c in COUNTS)
    df = spark.createDataFrame(rows, f"id int, {columns}, _rescued_data string")
    out = conform(df, probe(("id", "integer"), *((c, "integer") for c in COUNTS), ("toll", "double")))
    assert out.schema["toll"].dataType == DoubleType()
    found = {r.id: r for r in out.collect()}
    for i, (text, _, wanted) in enumerate(PAYLOADS):
        assert tuple(found[i][c] for c in COUNTS) == wanted, text
        assert found[i]._rescued_data == text and found[i].toll is None


def test_the_contract_of_bronze_is_met(spark):
    df = spark.range(1).selectExpr("'2031-05-06 07:08:09' AS tpep_pickup_datetime", "'{\"trip_distance\":0.5}' AS _rescued_data")
    out = conform(df, BRONZE_YELLOW)
    assert [f.dataType for f in out.schema] == [f.dataType for f in BRONZE_YELLOW.schema]
    row = out.first()
    assert row.tpep_pickup_datetime == datetime(2031, 5, 6, 7, 8, 9) and row.trip_distance == 0.5


def test_a_payload_is_parsed_once_a_row(spark):
    df = spark.range(5).selectExpr("id", "concat('{\"a\":', id, '}') AS _rescued_data")
    out = conform(df, probe(("a", "integer"), ("b", "integer"), ("c", "double"))).filter("a > 1 and b is null")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson") == 1
    assert sorted(r.a for r in out.collect()) == [2, 3, 4]


def probe(*columns):
    built = StructType()
    for name, dtype in columns:
        built.add(name, dtype)
    return TableContract("probe", built.add("_rescued_data", "string"))


def test_payload_texts_are_cast_softly(spark):
    rows = [
        ('{"n":"1.0","big":9007199254740993}',),
        ('{"n":"abc","big":1.9}',),
        ('{"n":-1.9,"big":-1.9}',),
        (None,),
    ]
    df = spark.createDataFrame(rows, "_rescued_data string")
    out = conform(df, probe(("n", "integer"), ("big", "long"))).collect()
    assert [(r.n, r.big) for r in out] == [
        (1, 9007199254740993),
        (None, 1),
        (-1, -1),
        (None, None),
    ]


def test_names_match_in_any_case_and_extras_are_dropped(spark):
    df = spark.createDataFrame([(7.5, "x")], "Airport_fee double, other string")
    out = conform(df, TableContract("p", StructType().add("airport_fee", "double")))
    assert out.columns == ["airport_fee"] and out.first()[0] == 7.5


def test_rescue_records_what_does_not_fit(spark):
    contract = probe(("n", "integer"), ("fee", "double"), ("name", "string"))
    df = spark.createDataFrame(
        [(1, 1.5, "a", 3), (1 << 40, None, "b", None), (None, None, None, None)],
        "n long, Fee double, name string, extra int",
    )
    out = rescue(df, contract).collect()
    assert [r.n for r in out] == [1, None, None]
    assert [r.fee for r in out] == [1.5, None, None]
    assert [r._rescued_data for r in out] == [
        '{"Fee":1.5,"extra":3}',
        '{"n":1099511627776}',
        None,
    ]


def test_rescue_of_another_kind_converts_and_records(spark):
    contract = probe(("n", "integer"))
    df = spark.createDataFrame([(2.0,), (None,)], "n double")
    out = conform(rescue(df, contract), contract).collect()
    assert [(r.n, r._rescued_data) for r in out] == [(2, '{"n":2.0}'), (None, None)]
