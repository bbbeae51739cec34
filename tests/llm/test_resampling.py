import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest

from stratamart.llm import resampling


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def features(text, longest=1):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text or ""))
    return len(words), [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def brute(rows, target, longest, buckets, percent, least):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    own = Counter(bucket(f) for r in rows for f in features(r[1], longest)[1])
    wanted = Counter(bucket(f) for t in target for f in features(t, longest)[1])
    s_all, t_all = own.total() + buckets, wanted.total() + buckets
    out = []
    for i, text, *_ in rows:
        n, found = features(text, longest)
        weight = sum(math.floor(1000 * math.log((wanted[b] + 1) * s_all / ((own[b] + 1) * t_all))) for b in map(bucket, found))
        h = int(hashlib.sha256(f"2024:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, n >= least, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    out.sort(key=lambda r: (not r[1], -r[4], r[0] is None, r[0] or 0, r[2]))
    drawn = percent * sum(r[1] for r in out) // 100
    return sorted(((i, n, w, s, k + 1 if k < drawn else None) for k, (i, _, n, w, s) in enumerate(out)), key=repr)


@pytest.mark.parametrize(("longest", "buckets", "percent", "least"), [(1, 10_000, 10, 20), (3, 50, 60, 4)])
def test_as_by_definition(docs_of, odd_rows, monkeypatch, longest, buckets, percent, least):
    monkeypatch.setattr(resampling, "SLICE_ROWS", 20)
    monkeypatch.setattr(resampling, "MATRIX_BYTES", 64)
    rng = random.Random(8)
    words = ["".join(rng.choices("abXé9-", k=rng.randint(1, 6))) for _ in range(90)]
    rows = [(i, ", ".join(rng.choices(words, k=rng.randint(0, 50))), "en", "s") for i in range(200)] + list(odd_rows)
    rows += [(300 + i, rows[7][1], "en", "s") for i in range(30)]
    target = [(i, " ".join(rng.choices(words[:30], k=12)), "en", "s") for i in range(10)] + [(99, None, None, None)]
    found = resampling.resample(docs_of(rows), docs_of(target), longest=longest, buckets=buckets, percent=percent, least_words=least)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute(rows, [t[1] for t in target], longest, buckets, percent, least)


def test_empty_tables(docs_of, none, odd_rows):
    assert resampling.resample(none, docs_of(odd_rows)).collect() == []
    rows = resampling.resample(docs_of(odd_rows), none).collect()
    assert len(rows) == len(odd_rows) and [r["rank"] for r in rows] == [None] * len(rows)


def test_checksums():
    texts = ["", "a", "é", "ab" * 500, "123456789", "a", "😀", "z" * 5_000]
    got = resampling.checksums(pa.array(["left out", *texts])[1:])
    assert got.tolist() == [zlib.crc32(t.encode()) for t in texts]
