import random

from stratamart.llm import groups


def brute(links):
    label = {}
    for a, b in links:
        label.setdefault(a, a), label.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def test_groups_over_many_partitions(spark, monkeypatch):
    monkeypatch.setattr(groups, "LINKS_PER_TASK", 40)
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(300)] + [(rng.randrange(1000, 1400), rng.randrange(1000, 1400)) for _ in range(220)]
    links += [(5000, 5000 + i) for i in range(1, 200)]
    rng.shuffle(links)
    links = [(a, b) for a, b in links if a != b]
    out = groups.connected(spark.createDataFrame(links, "a long, b long"))
    assert {r["node"]: r["label"] for r in out.collect()} == brute(links)


def test_no_links(spark):
    assert groups.connected(spark.createDataFrame([], "a long, b long")).collect() == []
