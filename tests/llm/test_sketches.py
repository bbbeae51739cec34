import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratamart.llm import sketches


def shingles(text):
    words = text.translate({c: c + 32 for c in range(65, 91)}).split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.mark.parametrize("slice_rows", [7, 4_000])
def test_edits_as_one_by_one(docs_of, odd_rows, words, monkeypatch, slice_rows):
    monkeypatch.setattr(sketches, "SLICE_ROWS", slice_rows)
    monkeypatch.setattr("stratamart.llm.arrow_text.RUN_BYTES", 5_000)
    rng = random.Random(1)
    rows = [(10 + i * 3, " ".join(words(rng.randint(0, 400))), "en", "s") for i in range(60)] + list(odd_rows)
    rows += [(400 + i, rows[7][1], "en", "s") for i in range(20)]
    found = sketches.against_next(docs_of(rows)).collect()
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    wanted, exact = [], {}
    for own, after in zip(order, order[1:] + order[:1], strict=True):
        text, other = own[1] or "", after[1] or ""
        cut = len(text) // 4
        edited = text[: len(text) - cut] + other[:cut]
        wanted.append((own[0], len(text), len(shingles(text)), hashlib.sha256(edited.encode()).hexdigest()))
        exact[own[0]] = (jaccard(text, edited), jaccard(text, other), len(shingles(text)))
    assert sorted((tuple(r)[:4] for r in found), key=repr) == sorted(wanted, key=repr)
    for r in found:
        near, after, size = exact[r["doc_id"]]
        room = 4 * (1 / max(1, size / sketches.SHARE)) ** 0.5
        assert abs(r["near_edited"] - near) <= room and abs(r["near_next"] - after) <= room
        assert 0 <= r["near_edited"] <= r["in_edited"] <= 1 or r["n_shingles"] < 40
    long = [r for r in found if r["n_shingles"] > 100]
    assert min(r["near_edited"] for r in long) > 0.3
    by_text = {}
    for r in found:
        by_text.setdefault(next(x[1] or "" for x in rows if x[0] == r["doc_id"]), set()).add(r["fingerprint"])
    assert all(len(v) == 1 for v in by_text.values())
    assert len({p for v in by_text.values() for p in v}) > 60


def test_one_row_and_none(docs_of, none):
    assert sketches.against_next(none).collect() == [] and sketches.fingerprints(none).collect() == []
    row = sketches.against_next(docs_of([(5, "a b c d e f g h", "en", "s")])).first()
    assert row["near_next"] == 1.0 and row["edited_sha256"] == hashlib.sha256(b"a b c d e f a b").hexdigest()


def test_codes_and_comparison():
    rng = np.random.default_rng(4)
    many = np.unique(rng.integers(0, 2**48, 5_000, dtype=np.uint64))
    sketch = sketches.kept(many)
    assert (sketches.decoded(sketches.encoded(sketch)) == sketch).all() and abs(len(sketch) - 625) < 100
    assert sketches.encoded(many[:0]) == "" and len(sketches.decoded("")) == 0
    part = sketches.kept(many[::20])  # 5 % of a text, wholly in it
    assert sketches.compared(part, sketch)[1] == 1.0 and sketches.compared(part, sketch)[0] < 0.1
    assert sketches.compared(many[:0], sketch) == (0.0, 1.0) and sketches.compared(many[:0], many[:0]) == (1.0, 1.0)
    high = many[-1:]
    assert sketches.compared(high, high) == (1.0, 1.0) and sketches.compared(high, sketch) == (0.0, 0.0)


def test_merging_and_groups(docs_of, words):
    texts = [" ".join(words(300)) for _ in range(12)]
    rows = [(i, t, "en", "all") for i, t in enumerate(texts)] + [(100 + i, t, "en", "some") for i, t in enumerate(texts[:3])]
    rows += [(200, "two words", "en", "all"), (201, None, "en", None)]
    prints = sketches.fingerprints(docs_of(rows)).join(docs_of(rows).select("doc_id", "source"), "doc_id")
    whole = sketches.fingerprints(docs_of([(0, texts[0], "en", "s")])).withColumn("group", F.lit("one"))
    held = {r["hash"] for r in sketches.merged(whole, "group").collect()}
    assert held == set(sketches.decoded(whole.first()["fingerprint"]).tolist())
    share = {(r["group"], r["other"]): r["share"] for r in sketches.group_containment(prints, "source").collect()}
    assert share["some", "all"] == 1.0 and abs(share["all", "some"] - 0.25) < 0.08
    pairs = prints.filter("doc_id in (0, 100)").groupBy().pivot("doc_id", [0, 100]).agg(F.first("fingerprint"))
    row = pairs.select(sketches.likeness(F.col("0"), F.col("100")).alias("l"), sketches.containment(F.col("0"), F.lit(None).cast("string")).alias("c")).first()
    assert row["l"] == 1.0 and row["c"] is None
