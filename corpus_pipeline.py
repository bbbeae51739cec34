"""The training-data pipeline over `documents`: a list of stages, each by one operator.

Every stage takes nulls in any column, empty and very long texts, repeated rows, empty tables and further columns;
what becomes of them its docstring says, and the operator's in more detail.
"""

from __future__ import annotations

from stratamart.llm import decontaminate, langid, mixing, ngrams, sharding
from stratamart.llm.common import stage, table

SHARDS = 24
# Near duplicates are those by shingles of five words that are 0.8 similar.
SHINGLE, PERCENT = 5, 80


def in_known_languages(spark, docs, sf_dir):
    """Documents in a language that the labelled ones are in, with that language where ``lang`` was null. Null texts
    and texts without letters go, as do longer ones that no language knows more of than pairs of letters."""
    return langid.recognised(docs)


def without_near_copies(spark, docs, sf_dir):
    """One document of each group of near copies, that with the smallest id (a null id last). Texts without words are
    copies of nothing. Rows of one id are judged each by its own text."""
    return ngrams.one_of_each(docs, n=SHINGLE, percent=PERCENT)


def without_benchmark(spark, docs, sf_dir):
    """Documents that hold no passage of the benchmark. Null and short texts hold none; without a benchmark all stay."""
    return decontaminate.without_passages(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark, docs, sf_dir):
    """Sources at their target weights: a row per document and pass that takes any of its words. Texts without words are
    not taken; a null source is a source."""
    return mixing.mixed_texts(docs)


def sharded(spark, docs, sf_dir):
    """Every row, null and repeated ones too, with its shard and its place in the shard; of an empty table none."""
    return sharding.interleave(docs, SHARDS, ties=("n_chars",))


STAGES = [
    ("language ID", in_known_languages),
    ("n-gram Jaccard join", without_near_copies),
    ("benchmark decontamination", without_benchmark),
    ("mixing sources", mixed),
    ("sharding", sharded),
]

# Cross-parsing, permutations and draws have no SQL.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The stages one after the other over all documents; each result but the last is written to
    the shared folder, so a lost executor never sets the work back beyond its stage."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
