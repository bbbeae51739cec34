import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, shard string, __key long, rank int"


@pytest.fixture
def docs_of(spark):
    """Documents from (doc_id, text, lang, source), with columns whose names operators use as well."""

    def make(rows):
        full = [(i, t, lang, s, len(t or ""), "mine", 7, 1) for i, t, lang, s in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture
def words():
    """Repeatable invented words."""
    rng = random.Random(5)
    return lambda n: ["".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(n)]


ODD_DOCS = [
    (1, None, None, None),
    (2, "", "en", "a"),
    (3, " \t\n ", None, "a"),
    (4, "one", "en", None),
    (5, "tie tie tie tie tie tie", "en", "a"),
    (5, "tie tie tie tie tie tie", "en", "a"),
    (None, "no number here at all, none", None, "b"),
    (7, "long " * 60_000, "en", "b"),
    (-8, "Ünïcode ﬁ 😀 \u0000 ~ çà", "xx", "ü"),
]


@pytest.fixture
def odd_rows():
    return ODD_DOCS


@pytest.fixture
def odd(docs_of):
    return docs_of(ODD_DOCS)


@pytest.fixture
def none(docs_of):
    return docs_of([])
