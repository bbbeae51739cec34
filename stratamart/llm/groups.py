"""Connected groups of a graph given by its links."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratamart.llm.common import Scratch

MAX_ROUNDS = 60
LINKS_PER_TASK = 200_000


def contract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The links of a partition as a star per group: every node with the group's smallest."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while parent[top] != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for rows in batches:
        for a, b in zip(rows["a"].tolist(), rows["b"].tolist(), strict=True):
            parent.setdefault(a, a)
            parent.setdefault(b, b)
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = list(parent)
    yield pd.DataFrame({"node": nodes, "top": [root(x) for x in nodes]}, dtype="int64")


def connected(links: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """``node`` and ``label``, the smallest node of its group, for every node of the links ``a``, ``b``; staged, in
    ``scratch`` if given.

    Links are dealt out evenly, not by node: a node with a third of all links is no task's burden.

    Each round contracts every partition's links to stars, which a partition's own links bound in
    size; a node that several partitions know then links their tops. What is left are links among
    tops, fewer each time and in fewer partitions, so that at last one partition sees all that is left.
    """
    scratch = scratch or Scratch(links.sparkSession)
    labels, rounds = None, 0
    links = scratch.stage(links.select("a", "b").filter("a <> b"), "links")
    left = links.count()
    while left and rounds < MAX_ROUNDS:
        parts = max(1, -(-left // LINKS_PER_TASK))
        stars = scratch.stage(links.repartition(parts).mapInPandas(contract, "node long, top long"), "stars")
        best = scratch.stage(stars.groupBy("node").agg(F.min("top").alias("best")), "tops")
        old = labels
        if old is None:
            labels = scratch.stage(best.select("node", F.col("best").alias("label")), "labels")
        else:
            labels = scratch.stage(
                old.join(best.withColumnRenamed("node", "label"), "label", "left").select(
                    "node", F.coalesce("best", "label").alias("label")
                ),
                "labels",
            )
            scratch.drop(old)
        tops = stars.join(best, "node").filter("top <> best").select(F.col("top").alias("a"), F.col("best").alias("b"))
        more = scratch.stage(tops.distinct(), "links")
        scratch.drop(links, stars, best)
        links = more
        left, rounds = links.count(), rounds + 1
    if left:
        raise RuntimeError(f"groups are not complete after {MAX_ROUNDS} rounds")
    if labels is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("label"))
    scratch.drop(links)
    return labels
