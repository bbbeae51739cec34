import os
import random
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from stratamart.llm import ngrams
from stratamart.session import shared_dir


def brute_set(text, n=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def brute_groups(rows, n=4, percent=85):
    sets = [brute_set(t, n) for _, t in rows]
    label = [i for i, _ in rows]
    parent = {i: i for i in label}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = root(label[i]), root(label[j])
                parent[max(x, y)] = min(x, y)
    return {i: (len(s), root(i)) for (i, _), s in zip(rows, sets, strict=True)}


def near_copies(rng, n_docs, longest=60):
    word = lambda: "".join(rng.choices("abcde", k=3))
    bases = [[word() for _ in range(rng.randint(1, longest))] for _ in range(12)]
    passage = [word() for _ in range(25)]
    texts = []
    for _ in range(n_docs):
        own = list(rng.choice(bases))
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(len(own))
            own[at : at + 1] = rng.choice([[], [word()], [own[at], word()]])
            own = own or ["x"]
        if rng.random() < 0.2:
            own += passage
        texts.append(" ".join(own))
    return texts


@pytest.mark.parametrize("seed, n, percent", [(1, 4, 85), (2, 5, 80)])
def test_groups_as_by_comparing_all(docs_of, seed, n, percent, monkeypatch):
    monkeypatch.setattr(ngrams, "TILE", 7)  # several blocks
    rng = random.Random(seed)
    rows = [(i, t) for i, t in enumerate(near_copies(rng, 150))]
    rows += [(1000, None), (1001, ""), (1002, " \n"), (1003, "Two Words"), (1004, "two\twords"), (1005, "two words")]
    df = docs_of([(i, t, "en", "s") for i, t in rows])
    out = {r["id"]: (r["n_shingles"], r["component_id"]) for r in ngrams.near_groups(df, n=n, percent=percent).collect()}
    assert out == brute_groups(rows, n, percent)


def test_linked_sets_always_share_a_key():
    rng = np.random.default_rng(3)
    table = ngrams.bands(4000)
    for size in [6, 7, 8, 9, 12, 13, 20, 40, 100, 333, 1000]:
        for _ in range(30):
            a = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
            gone = rng.integers(0, 15 * size // 100 + 1)
            b = np.setdiff1d(a, rng.choice(a, gone, replace=False))
            new = rng.integers(0, 2**64, rng.integers(0, 15 * size // 100 + 1), dtype=np.uint64)
            b = np.unique(np.concatenate([b, new]))
            shared = len(np.intersect1d(a, b))
            if 100 * shared >= 85 * (len(a) + len(b) - shared) and shared < len(a):
                assert set(ngrams.keys_of(a, table)) & set(ngrams.keys_of(b, table))
            differ = np.bitwise_count(ngrams.bitmap(a) ^ ngrams.bitmap(b)).sum()
            assert differ <= len(a) + len(b) - 2 * shared


def test_sets_with_empty_parts_state_them():
    band = ngrams.Band(7, 10, 6, 0)
    rng = np.random.default_rng(4)
    for _ in range(300):
        a = np.unique(rng.integers(0, 2**64, 9, dtype=np.uint64))
        b = np.unique(np.concatenate([a[1:], rng.integers(0, 2**64, 1, dtype=np.uint64)]))
        assert set(ngrams.part_keys(a, band, 2)) & set(ngrams.part_keys(b, band, 2))


def test_hashing_follows_the_words():
    texts = ["A b\x0bC d e", "a B c\x0cd  e", "a b c e d", "", "é É", "x" * 700, "x" * 699 + "y", " lone "]
    sets = ngrams.shingle_sets([t.encode() for t in texts])
    assert [len(s) for s in sets] == [len(brute_set(t)) for t in texts]
    assert sets[0].tolist() == sets[1].tolist() != sets[2].tolist()
    assert sets[5].tolist() != sets[6].tolist()


def test_odd_rows_and_one_of_each(odd, none, docs_of):
    rows = ngrams.near_groups(odd).collect()
    assert len(rows) == odd.count()
    assert all((r["component_id"] is None) == (r["id"] is None) for r in rows)
    kept = ngrams.one_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == [-8, 1, 2, 3, 4, 5, 7]
    assert sum(r["doc_id"] is None for r in kept.collect()) == 1
    assert ngrams.near_groups(none).collect() == [] and ngrams.one_of_each(none).collect() == []


def test_a_large_group_of_copies(docs_of, words):
    base = words(60)
    rows = [(i, " ".join(base[:30] + ([f"w{i}"] if i % 3 else []) + base[30:]), "en", "s") for i in range(400)]
    rows += [(1000 + i, " ".join(words(50)), "en", "s") for i in range(50)]
    found = {r["id"]: r["component_id"] for r in ngrams.near_groups(docs_of(rows)).collect()}
    assert {found[i] for i in range(400)} == {0} and all(found[1000 + i] == 1000 + i for i in range(50))


def test_rows_are_judged_by_their_own_text(docs_of, words):
    base, other = words(40), words(30)
    near = [*base, "new"]
    rows = [(3, " ".join(base), "en", "a"), (5, " ".join(near), "en", "a"), (5, " ".join(other), "en", "b"), (5, " ".join(other), "en", "c")]
    rows += [(None, " ".join(base), "en", "d"), (None, "alone " * 9, "en", "e"), (None, "alone " * 9, "en", "f"), (None, None, "en", "g")]
    kept = ngrams.one_of_each(docs_of(rows)).collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in kept) == sorted(
        [(3, " ".join(base)), (5, " ".join(other)), (0, "alone " * 9), (0, "")]
    )
    groups = {(r["id"], r["component_id"]) for r in ngrams.near_groups(docs_of(rows)).collect()}
    assert groups == {(3, 3), (5, 3), (None, None)}


def test_pairs_of_a_tile_come_in_strips(monkeypatch):
    monkeypatch.setattr(ngrams, "STRIP", 500)
    n = 300
    rows = pd.DataFrame({"id": range(n), "n": 10, "label": range(n), "block": 0, "low": 0, "high": 0, "starts": [True] + [False] * (n - 1)})
    rows["bits"] = [np.zeros(8, np.int64)] * n
    strips = list(ngrams.all_pairs(rows, 85))
    assert max(map(len, strips)) < 500 + n and len(pd.concat(strips).drop_duplicates()) == n * (n - 1) // 2


def test_bitmaps_of_tiles_tell_large_sets_apart(words):
    rng = random.Random(6)
    base = words(2600)
    # Two thirds alike, and one linked pair: 512 bits cannot tell sets of this size apart.
    texts = [" ".join(base[:2000] + words(600)) for _ in range(6)] + [" ".join(base)]
    linked = list(base)
    for at in rng.sample(range(2600), 40):
        linked[at] = "new"
    texts.append(" ".join(linked))
    batch = pa.RecordBatch.from_pydict({"id": range(8), "mark": range(8), "text": texts})
    (found,) = ngrams.emit_bitmaps(5)(iter([batch]))
    rows = found.to_pandas()
    assert ngrams.BITMAP < rows["bits"].map(len).max() <= ngrams.TILE_BITMAP
    rows = rows.assign(label=range(8), block=0, low=0, high=0, starts=[True] + [False] * 7)
    pairs = pd.concat(ngrams.all_pairs(rows, 80))
    assert {frozenset(p) for p in pairs.to_numpy().tolist()} == {frozenset(rows["id"][6:8].tolist())}


def test_sets_of_one_tile_may_have_bitmaps_of_several_sizes():
    rng = np.random.default_rng(8)
    sets = []
    for size in (400, 500, 520, 600, 1100):
        base = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
        for gone in (0, 5, 20, 45, 90):
            sets.append(np.setdiff1d(base, rng.choice(base, gone, replace=False)))
    bits = [ngrams.folded(ngrams.fine_bitmap(s), max(8, len(ngrams.fine_bitmap(s)) // 4)).view(np.int64) for s in sets]
    n = len(sets)
    rows = pd.DataFrame({"id": range(n), "n": [len(s) for s in sets], "label": range(n), "block": 0, "low": 0, "high": 0, "bits": bits})
    rows["starts"] = [True] + [False] * (n - 1)
    assert len({len(b) for b in bits}) > 1
    found = {tuple(p) for strip in ngrams.all_pairs(rows, 80) for p in strip.to_numpy().tolist()}
    for a in range(n):
        for b in range(a + 1, n):
            shared = len(np.intersect1d(sets[a], sets[b]))
            if 100 * shared >= 80 * (len(sets[a]) + len(sets[b]) - shared):
                assert (a, b) in found


def test_texts_are_not_shuffled_for_a_few_that_go(spark, docs_of, words):
    base = words(30)
    docs = docs_of([(i, " ".join(base if i < 3 else words(30)), "en", "s") for i in range(9)])
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        kept = ngrams.one_of_each(docs)
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert sorted(r["doc_id"] for r in kept.collect()) == [0, *range(3, 9)]
    finally:
        spark.conf.set(limit, before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_nothing_is_left_in_the_shared_folder(spark, docs_of):
    folder = f"{shared_dir(spark)}/stage"
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    ngrams.near_groups(docs_of([(1, "a b c d e f", "en", "s"), (2, "a b c d e f", "en", "s")])).collect()
    assert len([f for f in set(os.listdir(folder)) - before if f.startswith("ngram")]) == 1
