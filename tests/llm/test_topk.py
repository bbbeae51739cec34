import random

import pytest

from stratamart.llm import topk

VECTOR = "id long, vector array<double>, shard string, score string"


def brute(queries, rows, k):
    out = []
    asked = {}
    for i, v in queries:
        asked[i] = min(asked.get(i, v), v)
    for q, v in asked.items():
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in rows if i != q and len(w) == len(v))
        out += [(q, n + 1, i, int(-s)) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "s", "x") for i, v in rows], VECTOR)


@pytest.mark.parametrize("k", [1, 5, 400])
def test_as_by_scoring_all(spark, k, monkeypatch):
    monkeypatch.setattr(topk, "ROW_BLOCK", 9)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 5)
    monkeypatch.setattr(topk, "STRIP", 3)
    rng = random.Random(k)
    rows = [(i, [float(rng.randint(-2, 2)) for _ in range(3)]) for i in range(200)]
    rows += [(7, rows[7][1]), (300, [0.0, 0.0, 0.0]), (301, [1.0]), (302, [2.0])]
    asked = [r for r in rows if r[0] % 20 == 0 or r[0] > 299]
    out = topk.search(frame(spark, asked), frame(spark, rows), k)
    assert sorted(map(tuple, out.collect())) == brute(asked, rows, k)


def test_unusable_rows_take_no_part(spark):
    bad = [(1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (None, [1.0, 1.0])]
    good = [(0, [1.0, 2.0]), (9, [3.0, -1.0]), (9, [3.0, -1.0])]
    both = frame(spark, bad + good)
    assert sorted(map(tuple, topk.search(both, both).collect())) == brute(good, good, 20)
    assert topk.search(both.limit(0), both).collect() == topk.search(both, both.limit(0)).collect() == []


def test_components_are_floored(spark):
    df = spark.createDataFrame([([0.5, -0.001, 0.015625],)], "v array<float>")
    assert df.select(topk.whole(df["v"])).first()[0] == [32.0, -1.0, 1.0]
