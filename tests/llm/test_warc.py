import gzip
import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stratamart.llm import warc

PAGES = "page_id long, url string, html string, file string, offset long, bytes int"
LONG = "é\r\n\r\nWARC/1.1\r\n" * 100


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "f", 1, 2) for r in rows], PAGES)


ROWS = [
    (1, "http://A.example.org/x?q=1", LONG),
    (2, "http://b.example.org/", LONG),
    (9, "https://user@c.example.com:8080/y z\n", LONG),
    (3, None, "short"),
    (4, "no scheme", "short"),
    (5, "http://b.example.org/", None),
    (6, "http://b.example.org/", ""),
    (7, "http://b.example.org/", "b" * 999),
    (8, "http://b.example.org/", "b" * 999),
    (10, "http://b.example.org/", "c" * 1000),
    (10, "http://b.example.org/", "c" * 1000),
    (None, "http://d/", LONG),
    (11, "http://b.example.org/long", "x" * 3_000_000),
]


def expected(rows):
    last = {}
    for i, _, html in rows:
        if html and len(html.encode()) >= 1000 and i is not None:
            last[html] = max(i, last.get(html, i))
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        to = last.get(html) if i is not None and html in last and i < last[html] else None
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if to else "response", to))
    return sorted(out, key=str)


def test_read_back(spark):
    archive = warc.write_archives(pages_of(spark, ROWS))
    assert sorted((tuple(r) for r in warc.resolved(archive).collect()), key=str) == expected(ROWS)
    empty = warc.write_archives(pages_of(spark, []))
    assert warc.resolved(empty).collect() == []


def test_pages_that_share_a_number_keep_their_own_digest(spark):
    a, b = "a" * 1000, "b" * 1000
    rows = [(5, "http://x/", a), (5, "http://x/", b), (3, "http://y/", a), (2, "http://y/", b), (5, "http://x/", a)]
    archive = warc.write_archives(pages_of(spark, rows))
    assert sorted((tuple(r) for r in warc.resolved(archive).collect()), key=str) == expected(rows)


@pytest.mark.parametrize("per_block", [1, 2, 3000])
def test_lookups_find_every_record(spark, per_block, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", per_block)
    rows = [(i, f"http://h{i % 3}.org/{i % 5}", f"text {i}") for i in range(60)]
    archive = warc.write_archives(pages_of(spark, rows))
    wanted = spark.createDataFrame([(r[1], r[0]) for r in rows] + [("http://none.org/", 1), ("http://h0.org/0", 999)], "url string, page_id long")
    got = warc.read_ranges(warc.find(archive, wanted)).select("page_id", F.decode("payload", "UTF-8")).collect()
    assert sorted(map(tuple, got)) == [(r[0], r[2]) for r in rows]
    firsts = [r[0] for r in archive.directory.select("first").collect()]
    assert archive.directory.agg(F.sum("lines")).first()[0] == 60 and len(set(firsts)) == len(firsts)


def test_runs_of_records(spark, monkeypatch):
    monkeypatch.setattr(warc, "READ_BYTES", 500)
    rows = [(i, "http://x.org/", f"text {i}" * 9) for i in range(40)]
    assert warc.read_archives(warc.write_archives(pages_of(spark, rows))).count() == 40


def test_archives_are_standard_files(spark):
    archive = warc.write_archives(pages_of(spark, ROWS[:4]))
    folder = archive.lines.first()["folder"]
    data = b"".join(gzip.decompress(f.read_bytes()) for f in Path(folder).glob("*.warc.gz"))
    assert data.count(b"WARC-Type: ") == 4 and b"\nWARC-Type: revisit" in data
    assert b"WARC-Target-URI: https://user@c.example.com:8080/y%20z%0A\r\n" in data


def test_keys_sort_by_reversed_host():
    assert warc.url_key("http://u@WWW.Example.org:81/a?b#c") == "org,example,www:81)/a?b#c"
    assert warc.url_key(None) == ")" and warc.url_key("plain") == "plain"
    assert warc.line_key("http://a.b/", 5) < warc.line_key("http://a.b/", 10) < warc.line_key("http://a.b/c", 1)
    assert warc.line_key("http://a.b/", -5) < warc.line_key("http://a.b/", 3)
