from collections import Counter, defaultdict

from pyspark.sql import functions as F

from stratamart.llm import sharding


def test_counts_slots_and_mixture(spark, docs_of):
    rows = [(i, f"t{i}", "en", "hot" if i % 3 == 0 else f"s{i % 7}") for i in range(5000)]
    out = sharding.interleave(docs_of(rows), 24).collect()
    assert len(out) == 5000
    per_shard, sources = defaultdict(list), defaultdict(Counter)
    for r in out:
        per_shard[r["shard"]].append(r["slot"])
        sources[r["shard"]][r["source"]] += 1
    sizes = [len(v) for v in per_shard.values()]
    assert len(sizes) == 24 and max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in per_shard.values())
    whole = Counter(r[3] for r in rows)
    for held in sources.values():
        assert all(abs(held[s] - n / 24) <= 2 for s, n in whole.items())


def test_slices_do_not_change_the_result(docs_of, monkeypatch):
    df = docs_of([(i, "x", "en", "ab"[i % 2]) for i in range(300)])
    one = {(r["doc_id"], r["shard"], r["slot"]) for r in sharding.interleave(df, 5).collect()}
    monkeypatch.setattr("stratamart.llm.common.SLICE_ROWS", 17)
    assert {(r["doc_id"], r["shard"], r["slot"]) for r in sharding.interleave(df, 5).collect()} == one


def test_odd_rows_stay_and_columns_are_kept(odd, none):
    out = sharding.interleave(odd, 3, ties=("text",))
    assert out.columns == [*[c for c in odd.columns if c != "shard"], "shard", "slot"]
    assert out.count() == odd.count()
    assert out.filter(F.col("shard").isNull() | F.col("slot").isNull()).count() == 0
    assert sharding.interleave(none, 3).collect() == []


def test_written_shards_read_back(docs_of, tmp_path):
    df = sharding.interleave(docs_of([(i, "x", "en", "a") for i in range(50)]), 4)
    sharding.write_shards(df, str(tmp_path / "shards"))
    back = df.sparkSession.read.parquet(str(tmp_path / "shards"))
    assert back.groupBy("shard").count().count() == 4 and back.count() == 50
