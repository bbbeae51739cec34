import shutil

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from stratamart.operators import quantiles

POINTS = (0.5, 0.95, 0.99)


def test_three_million_values_are_never_in_one_task(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "SELECT_VALUES", 1_000)
    n = 3_000_000
    mixed = (F.col("id") * 1_000_003 % n).alias("x")
    df = spark.range(n).select(F.lit("a").alias("taxi_type"), mixed)
    seen = []
    whole = quantiles.narrowed

    def counting(held, wanted):
        before = held.count()
        out, ranks = whole(held, wanted)
        seen.append((before, out.groupBy("_point").count().agg(F.max("count")).first()[0]))
        return out, ranks

    monkeypatch.setattr(quantiles, "narrowed", counting)
    row = quantiles.exact_percentiles(df, "x", accuracy=100).first()
    assert list(row) == ["a", 0, n // 2 - 1, n * 95 // 100 - 1, n * 99 // 100 - 1, n - 1]
    (before, largest), = seen
    assert before > 100_000 and largest <= 1_000


def test_narrowing_keeps_the_ranks_of_weighted_values(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "SELECT_VALUES", 20)
    rows = [(g, p, float(v), 1 + v % 7 * 50) for g in ("a", None) for p in (0, 1) for v in range(2_000)]
    held = spark.createDataFrame(rows, "_by string, _point int, _value double, _rows long")
    order = sorted(v for _, _, v, n in rows[:2_000] for _ in range(n))
    ranks = {("a", 0): 1, ("a", 1): 123_456, (None, 0): len(order), (None, 1): 777}
    wanted = spark.createDataFrame([(g, p, r) for (g, p), r in ranks.items()], "_by string, _point int, _rank long")
    values, rest = quantiles.narrowed(held, wanted)
    left = {(r["_by"], r["_point"]): r["_rank"] for r in rest.collect()}
    for at, rank in ranks.items():
        own = sorted((r["_value"], r["_rows"]) for r in values.collect() if (r["_by"], r["_point"]) == at)
        assert 0 < len(own) <= 20
        found, upto = None, 0
        for value, n in own:
            upto += n
            if upto >= left[at]:
                found = value
                break
        assert found == order[rank - 1]


@pytest.fixture
def landed(spark, tmp_path):
    rows = spark.range(30_000).selectExpr(
        "if(id % 3 = 0, 'a', 'b') AS taxi_type", "double(id) AS x", "if(id % 2 = 0, double(id), null) AS y", "int(id div 10000) AS year"
    )
    rows.write.partitionBy("year").parquet(f"{tmp_path}/rows")
    return f"{tmp_path}/rows", f"{tmp_path}/sketches"


KEYS = (["year"], ["taxi_type"], ["x", "y"])


def percentiles(spark, places, column="x"):
    stored = quantiles.stored_sketches(spark, places[1], spark.read.parquet(places[0]).schema, *KEYS)
    return quantiles.sketched_percentiles(stored, "taxi_type", column, POINTS).collect()


def test_only_new_folders_are_read(spark, landed):
    assert percentiles(spark, landed) == []
    rows = spark.read.parquet(landed[0])
    quantiles.refresh_sketches(rows, landed[1], *KEYS, [Row(year=0), Row(year=1)])
    shutil.rmtree(f"{landed[0]}/year=0")  # what has been sketched is not needed any more
    shutil.rmtree(f"{landed[0]}/year=1")
    quantiles.refresh_sketches(spark.read.parquet(landed[0]), landed[1], *KEYS, [Row(year=2)])
    quantiles.refresh_sketches(spark.read.parquet(landed[0]), landed[1], *KEYS, [])
    found = percentiles(spark, landed)
    assert [(r.taxi_type, r.rows, r.min_x, r.max_x) for r in found] == [("a", 10_000, 0.0, 29_997.0), ("b", 20_000, 1.0, 29_999.0)]
    for r in found:
        assert all(abs(r[f"{quantiles.point_name(p)}_x"] / 30_000 - p) < 0.01 for p in POINTS)


def test_a_folder_is_replaced_and_nulls_are_left_out(spark, landed):
    rows = spark.read.parquet(landed[0])
    for _ in range(2):
        quantiles.refresh_sketches(rows, landed[1], *KEYS, [Row(year=y) for y in range(3)])
    found = percentiles(spark, landed, "y")
    assert [(r.rows, r.max_y) for r in found] == [(10_000, 29_994.0), (20_000, 29_998.0)]
    nothing = spark.createDataFrame([("a", None, None, 9)], rows.schema)
    quantiles.refresh_sketches(nothing, landed[1], *KEYS, [Row(year=9)])
    assert sum(r.rows for r in percentiles(spark, landed)) == 30_001
    none = quantiles.sketched_percentiles(quantiles.sketched(nothing, ["taxi_type"], ["x"]), "taxi_type", "x", POINTS).first()
    assert list(none) == ["a", 1, None, None, None, None, None]
