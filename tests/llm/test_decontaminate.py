import random
import time
from collections import Counter

from pyspark.sql import functions as F

from stratamart.llm import decontaminate


def shingles(words):
    return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def similarity(a, b):
    a, b = shingles(a), shingles(b)
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], "item_id long, text string, shingles string")


def test_passages_as_by_trying_every_window(spark, docs_of):
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    items = {i: [word() for _ in range(rng.randint(12, 45))] for i in range(8)}
    items[8] = ["ring", "a", "ring"] * 8
    docs = {}
    for d in range(60):
        own = [word() for _ in range(rng.randint(0, 40))]
        if d % 2:
            piece = list(items[rng.randrange(9)])
            if d % 4 == 1:
                piece[rng.randrange(len(piece))] = word()
            if d % 5 == 1:
                piece = piece[2:]
            own[rng.randrange(len(own) + 1) : 0] = []
            at = rng.randrange(len(own) + 1)
            own = own[:at] + piece + own[at:]
        docs[d] = own
    rows = [(d, ", ".join(w).title(), "en", "s") for d, w in docs.items()]
    found = decontaminate.passages(docs_of(rows), items_of(spark, [(i, " ".join(w)) for i, w in items.items()]))
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in found.collect()}
    wanted = {}
    for d, own in docs.items():
        for i, item in items.items():
            n = len(item)
            windows = [own[s : s + n] for s in range(max(1, len(own) - n + 1))]
            best = max(similarity(w, item) for w in windows)
            if best >= 0.8:
                wanted[(d, i)] = best
    assert {k: round(v, 9) for k, v in got.items()} == {k: round(v, 9) for k, v in wanted.items()}
    assert len(wanted) > 15


def test_edits_down_to_the_least_similarity(spark, docs_of):
    rng = random.Random(7)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    items, docs = {}, {}
    for i, (n, k) in enumerate([(25, 2), (35, 3), (45, 4), (55, 5), (59, 6), (150, 12), (200, 17)] * 8):
        piece = items[i] = [word() for _ in range(n)]
        fresh = [word() for _ in range(k)]
        if n > 100:
            at = rng.randrange(5, n - k - 5)
            edited = piece[:at] + fresh + piece[at + k :]
        else:
            edited = piece[: n - k] + fresh if i % 2 else fresh + piece[k:]
        docs[i] = [word() for _ in range(20)] + edited + [word() for _ in range(20)]
    # Halves that have changed places are as similar to the item.
    items[100] = [word() for _ in range(60)]
    docs[100] = [word() for _ in range(70)] + items[100][30:] + items[100][:30] + [word() for _ in range(70)]
    rows = [(d, " ".join(w), "en", "s") for d, w in docs.items()]
    found = decontaminate.passages(docs_of(rows), items_of(spark, [(i, " ".join(w)) for i, w in items.items()])).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(docs)
    assert all(r["doc_id"] == r["item_id"] for r in found)
    assert 11 < max(r["distance"] for r in found) <= decontaminate.RADIUS
    for r in found:
        own, item = docs[r["doc_id"]], items[r["item_id"]]
        windows = [similarity(own[s : s + len(item)], item) for s in range(len(own) - len(item) + 1)]
        assert abs(r["similarity"] - max(windows)) < 1e-9 and r["start"] == windows.index(max(windows))


def majority(hashes):
    """The fingerprint bit by bit."""
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_and_blocks(spark):
    rng = random.Random(3)
    rows = [[rng.getrandbits(64) - 2**63 for _ in range(n)] for n in (1, 2, 3, 46, 500, (1 << 14) - 1, 1 << 14, 20_001)]
    rows += [[-1] * ((1 << 14) - 1), [-1, -1, 0], [0] * 7]
    df = spark.createDataFrame([(r,) for r in rows], "w array<long>").withColumn("print", F.expr(decontaminate.fingerprint("w")))
    for row in df.withColumn("blocks", F.expr(decontaminate.blocks("print"))).collect():
        assert row["print"] % 2**64 == majority([h % 2**64 for h in row["w"]])
        bits, at, parts = 0, 0, decontaminate.RADIUS + 1
        for i, block in enumerate(row["blocks"]):
            width = 64 * (i + 1) // parts - 64 * i // parts
            place, value = divmod(block, 1 << 32)
            assert place == i and 0 <= value < 1 << width
            bits |= value << at
            at += width
        assert at == 64 and bits == row["print"] % 2**64


def test_prints_within_the_radius_share_a_block(spark):
    rng = random.Random(4)
    rows = []
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), decontaminate.RADIUS):
            b ^= 1 << bit
        rows.append((a - 2**63, b - 2**63))
    df = spark.createDataFrame(rows, "a long, b long")
    same = F.arrays_overlap(F.expr(decontaminate.blocks("a")), F.expr(decontaminate.blocks("b")))
    assert df.filter(same).count() == 300


def test_long_repetitive_text(spark, docs_of):
    """Windows are looked at one by one: the work grows with the text, not with its square."""
    rng = random.Random(6)
    item = ["".join(rng.choices("abcdefgh", k=4)) for _ in range(50)]
    docs = docs_of([(1, " ".join(item * 400), "en", "s"), (2, "ring a " * 10_000, "en", "s"), (3, "clean words stay in here", "en", "s")])
    items = items_of(spark, [(1, " ".join(item)), (2, "ring a " * 12)])
    start = time.monotonic()
    found = {(r["doc_id"], r["item_id"]): (r["start"], r["similarity"]) for r in decontaminate.passages(docs, items).collect()}
    assert found == {(1, 1): (0, 1.0), (2, 2): (0, 1.0)}
    assert time.monotonic() - start < 60


def test_odd_rows(spark, odd, none, docs_of):
    items = items_of(spark, [(1, None), (2, ""), (3, "too few words"), (4, "tie tie tie tie tie tie"), (4, "tie tie tie tie tie tie"), (None, "tie tie tie tie tie tie")])
    found = decontaminate.passages(odd, items).collect()
    assert sorted((r["doc_id"], r["item_id"] or 0) for r in found) == [(5, 0), (5, 4)]
    kept = decontaminate.without_passages(odd, items)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 2
    assert decontaminate.passages(none, items).collect() == []
    assert decontaminate.without_passages(odd, items.limit(0)).count() == odd.count()
    unnamed = docs_of([(None, "here: tie tie tie, tie tie tie!", "en", "s"), (None, "clean words stay in here", "en", "s")])
    assert [r["text"] for r in decontaminate.without_passages(unnamed, items).collect()] == ["clean words stay in here"]


def test_no_python_on_the_way(spark, docs_of):
    df = decontaminate.passages(docs_of([(1, "a b c d e f", "en", "s")]), items_of(spark, [(1, "a b c d e f")]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
