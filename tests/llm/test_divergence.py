import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from stratamart.llm import divergence


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows):
    """(lang, source, part, item, value, rank) by the definition, with Python's whole numbers."""
    held, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered(text or ""))
        groups[lang].add(source)
        held[lang].update(set(terms))
        counts[lang, source].update(terms)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in held[lang].items() if n >= 3]
        whole = sum((counts[lang, s] for s in sources), Counter())

        def shares(count, kept=kept):
            n = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 1) // (n + len(kept)) for t in kept}

        q_all = shares(whole)
        p_of = {s: shares(counts[lang, s]) for s in sources}
        for s in sources:
            p = p_of[s]
            pairs = [(o, sum((p[t] - p_of[o][t]) ** 2 // p_of[o][t] for t in kept)) for o in sources if o != s]
            terms = [(t, (p[t] - q_all[t]) ** 2 // q_all[t]) for t in kept if counts[lang, s][t] and p[t] > q_all[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                last = len(found) if part == "pair" else 200
                out += [(lang, s, part, i, v, n + 1) for n, (i, v) in enumerate(found[:last])]
    return sorted(out)


@pytest.fixture
def several(odd_rows):
    rng = random.Random(3)
    words = ["".join(rng.choices("abCDé ß9-", k=rng.randint(1, 5))) for _ in range(300)]
    rows = []
    for i in range(150):
        lang, source = rng.choice(["x", "y", None]), rng.choice(["s1", "s2", "s3", "é", "", None, "only"])
        rows.append((i, " ".join(rng.choices(words, k=rng.randint(0, 60))), lang, source))
    return [*rows, (500, "unlike anything", "z", "a"), (501, None, "z", "b"), *odd_rows]


def found(docs):
    return sorted(tuple(r) for r in divergence.audit(docs).collect())


def test_as_by_definition(docs_of, several):
    assert found(docs_of(several)) == brute(several)


def test_tiles_shards_and_flushes_change_nothing(docs_of, several, monkeypatch):
    wanted = brute(several)
    for name, value in (("TILE", 2), ("SHARD_ROWS", 40), ("CELLS", 16), ("HELD_ROWS", 50)):
        monkeypatch.setattr(divergence, name, value)
    monkeypatch.setattr("stratamart.llm.arrow_text.RUN_BYTES", 200)
    assert found(docs_of(several)) == wanted


def test_empty_and_large_counts(spark, none):
    assert found(none) == []
    x, of = 10**15 - 1, 3 * 10**15
    row = spark.range(1).selectExpr(f"{x}L AS x", f"{of}L AS of").selectExpr(divergence.share("x", "of") + " AS p").first()
    assert row["p"] == 1 + 10**9 * x // of
    assert divergence.shares(np.array([x]), np.array([of])).tolist() == [row["p"]]
