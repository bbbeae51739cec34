import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))

import __spark_entry__ as driver  # noqa: E402
import corpus_pipeline  # noqa: E402
from check_oracles import compare, connect  # noqa: E402

from stratamart.llm.oracles import ORACLES  # noqa: E402
from stratamart.llm.queries import QUERIES  # noqa: E402

COUNTED = {"op1_language_id": "documents", "op9_mixing": "documents"}


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


def test_all_are_registered():
    assert {*QUERIES, "pipeline"} <= set(driver.queries())
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_sql(spark, con, small, name):
    same, text = compare(spark, con, name, small)
    assert same, text


@pytest.mark.parametrize("name", COUNTED)
def test_a_row_per_row(spark, con, small, name):
    rows = QUERIES[name](spark, small).count()
    assert rows == con.execute(f"SELECT count(*) FROM {COUNTED[name]}").fetchall()[0][0]


def test_pipeline(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    out = corpus_pipeline.run(spark, small)
    assert out.columns == [*docs.columns, "shard", "slot"]
    kept = {r[0] for r in out.select("doc_id").collect()}
    assert kept < {r[0] for r in docs.select("doc_id").collect()}
    held = {r["doc_id"] for r in QUERIES["op3_decontamination"](spark, small).collect()}
    assert held and not kept & held
    sizes = [r[0] for r in out.groupBy("shard").count().select("count").collect()]
    assert len(sizes) == 24 and max(sizes) - min(sizes) <= 1


def test_stages_take_odd_and_empty_tables(spark, small, odd, none):
    for docs in (odd, none):
        for _, step in corpus_pipeline.STAGES:
            docs = step(spark, docs, small)
        assert docs.columns[-2:] == ["shard", "slot"]
        docs.collect()
