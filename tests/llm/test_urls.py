import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stratamart.llm import urls

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("a.example.org", "/", "block"), ("com", "/de/", "block")]
URLS = [
    "http://example.org/es/1", "https://www.EXAMPLE.org/es/?q", "http://example.org/en", "http://notexample.org/es/",
    "http://org/", "http://org", "ftp://a.example.org/x", "http://b.a.example.org/es/x#y", "http://x.com/de/2", "http://x.com/De/2",
    "http://x.com?/de/", "no scheme/de/", "", None, "://com/de/", "http://com/de/http://example.org/es/", "x\n://com/de/",
]


def brute(url):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    end = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
    host, rest = rest[:end], rest[end:]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    path = rest.split("?")[0].split("#")[0]
    fits = [(len(h + p), h + p, a) for h, p, a in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *max(fits)[1:]) if fits else (host, path, None, "allow")


def rules_of(spark, rules=RULES):
    return spark.createDataFrame(rules, "host string, path string, action string")


@pytest.mark.parametrize("level_bytes", [urls.LEVEL_BYTES, 0])
def test_every_url_as_by_trying_all_rules(spark, level_bytes, monkeypatch):
    monkeypatch.setattr(urls, "LEVEL_BYTES", level_bytes)  # 0: no filter may be sent
    pages = spark.createDataFrame([(i, u, "mine", "x") for i, u in enumerate(URLS * 2)], "page_id long, url string, host string, __keys string")
    out = {r["page_id"]: tuple(r)[-4:] for r in urls.judge(pages.drop("__keys"), rules_of(spark)).collect()}
    assert out == {i: brute(u) for i, u in enumerate(URLS * 2)}


def test_void_and_repeated_rules_and_no_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    rules = [("b", "/", "allow"), ("b", "/", "block"), (None, "/", "block"), ("b", None, "block"), ("b", "/c", None)]
    assert urls.judge(pages, rules_of(spark, rules)).first()["verdict"] == "block"
    assert urls.judge(pages, rules_of(spark, [])).first()["verdict"] == "allow"
    assert urls.judge(pages.limit(0), rules_of(spark)).collect() == []


@pytest.mark.parametrize("level_bytes", [urls.LEVEL_BYTES, 0])
def test_hosts_and_paths_do_not_run_together(spark, level_bytes, monkeypatch):
    monkeypatch.setattr(urls, "LEVEL_BYTES", level_bytes)
    rules = [("a", "b", "block"), ("zz", "", "allow"), ("c", "/d/", "block"), ("c/d", "/", "block"), ("", "", "block")]
    pages = spark.createDataFrame(list(enumerate(["http://ab/", "http://zz/", "http://c/d//", "http://c/d", "x"])), "page_id long, url string")
    found = [(r["rule"], r["verdict"]) for r in urls.judge(pages, rules_of(spark, rules)).orderBy("page_id").collect()]
    assert found == [(None, "allow"), ("zz", "allow"), ("c/d/", "block"), (None, "allow"), ("", "block")]


def test_cascade_is_exact_for_its_universe(spark):
    keys = spark.range(3000).selectExpr("concat('k', id) as key")
    listed = keys.filter("hash(key) % 5 = 0")
    levels = urls.build(listed, keys)
    assert len(levels) > 1
    rows = keys.select("key", urls.hashes(keys["key"]).alias("h")).select("key", "h.*").toPandas()
    a, b = (rows[c].to_numpy().astype(np.uint64) for c in ("first", "second"))
    wanted = {r["key"] for r in listed.collect()}
    assert (urls.listed(levels, a, b) == rows["key"].isin(wanted).to_numpy()).all()


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 2**63), min_size=1, max_size=30))
def test_positions_stay_in_range(values):
    x = np.array(values, dtype=np.uint64)
    assert (urls.positions(x, x, 3, 77) < 77).all()
