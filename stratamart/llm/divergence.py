"""How far the sources of a language are from each other and from the whole language in the terms they use.

Arrow kernels cut texts into terms, encode them and count them by group inside the tasks, so what is shuffled
are partial counts. These are merged, and shards of them, columns of counts by source, give the divergences.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratamart.llm.arrow_text import runs, words
from stratamart.llm.common import stage

BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
LEAST_DOCS = 3
TERM_RANKS = 200
SCALE = 1_000_000_000
# Partial counts that a task holds before it hands them on; counts of a shard; sources of a tile, of which two
# meet in a task; cells of a dense block.
HELD_ROWS = 300_000
SHARD_ROWS = 200_000
TILE = 256
CELLS = 1 << 20
COUNTS = "lang string, source string, term string, n long, docs long"
NAMES = ["lang", "source", "term"]


def counted(run: pa.RecordBatch) -> pa.Table:
    """``n`` occurrences and ``docs`` documents per language, source and term; documents alone for the term ''."""
    lang, source = (pc.fill_null(run[c], "").dictionary_encode() for c in ("lang", "source"))
    n_sources = max(1, len(source.dictionary))
    group = lang.indices.to_numpy().astype(np.int64) * n_sources + source.indices.to_numpy()
    flat, owner = words(run["text"], BETWEEN)
    terms = flat.dictionary_encode()
    per_doc = pa.table({"doc": owner, "term": terms.indices}).group_by(["doc", "term"], use_threads=False).aggregate([([], "count_all")])
    per_group = (
        pa.table({"group": group[per_doc["doc"].to_numpy()], "term": per_doc["term"], "n": per_doc["count_all"]})
        .group_by(["group", "term"], use_threads=False)
        .aggregate([("n", "sum"), ([], "count_all")])
    )
    names, docs = np.unique(group, return_counts=True)
    of = np.concatenate([per_group["group"].to_numpy(), names])
    term = pa.concat_arrays([terms.dictionary.take(per_group["term"].combine_chunks()), pa.array([""] * len(names), pa.string())])
    return pa.table(
        {
            "lang": lang.dictionary.take(pa.array(of // n_sources)),
            "source": source.dictionary.take(pa.array(of % n_sources)),
            "term": term,
            "n": np.concatenate([per_group["n_sum"].to_numpy(), np.zeros(len(names), np.int64)]),
            "docs": np.concatenate([per_group["count_all"].to_numpy(), docs]),
        }
    )


def merged(tables: list[pa.Table]) -> pa.Table:
    both = pa.concat_tables(tables).group_by(NAMES, use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return both.select([*NAMES, "n_sum", "docs_sum"]).rename_columns([*NAMES, "n", "docs"])


def partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, rows, least = [], 0, HELD_ROWS
    for batch in batches:
        for run in runs(batch):
            held.append(counted(run))
            rows += held[-1].num_rows
            if rows >= least:
                held = [merged(held)]
                rows = held[0].num_rows
                if rows > HELD_ROWS // 2:
                    yield from held[0].to_batches()
                    held, rows = [], 0
    if held:
        yield from merged(held).to_batches()


def share(x: str, of: str) -> str:
    """1 + floor(SCALE * x / of) in longs: by three digits of base 1000, so that ``x`` may have 15 digits."""
    first = f"({x} * 1000)"
    second = f"({first} % {of} * 1000)"
    third = f"({second} % {of} * 1000)"
    return f"(1 + {first} div {of} * 1000000 + {second} div {of} * 1000 + {third} div {of})"


def shares(x: np.ndarray, of: np.ndarray) -> np.ndarray:
    out, left = np.zeros_like(x), x
    for _ in range(3):
        digit, left = np.divmod(left * 1000, of)
        out = out * 1000 + digit
    return out + 1


def far(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def shard_divergences(shard: pa.Table) -> pa.Table:
    """Per ordered pair of sources of two tiles: the divergences of a shard's terms, less what they would be if
    neither source had the term; the first shard adds that for all terms. Rows without a term name the sources."""
    header = pc.is_null(shard["term"])
    heads = shard.filter(header).sort_by("place")
    place, of = heads["place"].to_numpy(), heads["total"].to_numpy() + heads["kept"].to_numpy()
    low, high = shard["low"][0].as_py(), shard["high"][0].as_py()
    left, right = np.flatnonzero(place // TILE == low), np.flatnonzero(place // TILE == high)
    absent = shares(np.ones(len(place), np.int64), np.maximum(of, 1))
    forth = np.zeros((len(left), len(right)), np.int64)
    back = np.zeros_like(forth)
    counts = shard.filter(pc.invert(header))
    term = counts["term"].combine_chunks().dictionary_encode()
    n_terms = len(term.dictionary)
    row, column = term.indices.to_numpy(), np.searchsorted(place, counts["place"].to_numpy())
    order = np.argsort(row, kind="stable")
    row, column, n = row[order], column[order], counts["n"].to_numpy()[order]
    step = max(1, CELLS // max(1, len(place)))
    for begin in range(0, n_terms, step):
        at = slice(*np.searchsorted(row, [begin, begin + step]))
        dense = np.ones((min(step, n_terms - begin), len(place)), np.int64)
        dense[row[at] - begin, column[at]] += n[at]
        p = shares(dense, of)
        for i, own in enumerate(left):
            forth[i] += far(p[:, [own]], p[:, right]).sum(axis=0)
            if low != high:
                back[i] += far(p[:, right], p[:, [own]]).sum(axis=0)
    others = n_terms if shard["shard"][0].as_py() else n_terms - int(heads["kept"][0].as_py())
    forth -= others * far(absent[left][:, None], absent[right])
    back -= others * far(absent[right], absent[left][:, None])
    names = heads["source"].combine_chunks()
    a, b = np.repeat(left, len(right)), np.tile(right, len(left))
    sides = [(a, b, forth)] if low == high else [(a, b, forth), (b, a, back)]
    keep = a != b
    found = [(names.take(pa.array(x[keep])), names.take(pa.array(y[keep])), pa.array(v.reshape(-1)[keep])) for x, y, v in sides]
    source, item, value = (pa.chunked_array(c) for c in zip(*found, strict=True))
    return pa.table({"lang": pa.repeat(shard["lang"][0], len(source)), "source": source, "item": item, "value": value})


def term_counts(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    """COUNTS over all documents for the terms that a language keeps, with the language's own count ``whole`` and
    ``first`` on one row per term of a language; documents alone for the term ''. Staged."""
    slim = docs.select(
        F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"), F.col(source).cast("string").alias("source")
    )
    # The tasks have combined their counts; by language and term all later steps find them together.
    own = slim.mapInArrow(partial_counts, COUNTS).repartition("lang", "term")
    of_term = Window.partitionBy("lang", "term")
    return stage(
        own.groupBy(*NAMES)
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        .withColumns(
            {
                "held": F.sum("docs").over(of_term),
                "whole": F.sum("n").over(of_term),
                "first": F.row_number().over(of_term.orderBy("source")) == 1,
            }
        )
        .filter((F.col("term") == "") | (F.col("held") >= LEAST_DOCS))
        .select(*NAMES, "n", "whole", "first"),
        "audit-counts",
    )


def source_groups(counts: DataFrame) -> DataFrame:
    """Every group with its ``total``, its language's ``lang_total`` and ``kept`` terms, the number of the
    language's sources and count rows, and its ``place`` among the sources. Staged."""
    langs = counts.groupBy("lang").agg(
        F.sum("n").alias("lang_total"),
        F.count_if(F.col("first") & (F.col("term") != "")).alias("kept"),
        F.count("*").alias("rows"),
    )
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    own = Window.partitionBy("lang")
    return stage(
        totals.join(langs, "lang").withColumns(
            {
                "place": (F.row_number().over(own.orderBy("source")) - 1).cast("long"),
                "sources": F.count("*").over(own),
                "shards": F.ceil(F.col("rows") / SHARD_ROWS).cast("int"),
            }
        ),
        "audit-groups",
    )


def pair_divergences(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``item`` (another source), ``value``."""
    several = groups.filter("sources > 1")
    tiles = F.explode(F.expr(f"sequence(0L, (sources - 1) div {TILE})")).alias("other")
    met = {
        "low": F.expr(f"least(place div {TILE}, other)"),
        "high": F.expr(f"greatest(place div {TILE}, other)"),
    }
    heads = several.select("*", tiles).select(
        "*", F.explode(F.expr("sequence(0, shards - 1)")).alias("shard"), F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("n")
    )
    rows = (
        counts.filter("term <> ''")
        .select(*NAMES, "n")
        .join(several, ["lang", "source"])
        .select("*", tiles, F.expr("cast(pmod(xxhash64(term), shards) as int)").alias("shard"))
    )
    wanted = ["lang", "shard", "low", "high", "source", "place", "total", "kept", "term", "n"]
    both = heads.withColumns(met).select(*wanted).unionByName(rows.withColumns(met).select(*wanted))
    return (
        both.groupBy("lang", "shard", "low", "high")
        .applyInArrow(shard_divergences, "lang string, source string, item string, value long")
        .groupBy("lang", "source", "item")
        .agg(F.sum("value").alias("value"))
    )


def term_divergences(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``item`` (a term that the group uses more than its language does), ``value``."""
    return (
        counts.filter("term <> ''")
        .select(*NAMES, "n", "whole")
        .join(groups.select("lang", "source", "total", "lang_total", "kept"), ["lang", "source"])
        .withColumns({"p": F.expr(share("(n + 1)", "(total + kept)")), "q": F.expr(share("(whole + 1)", "(lang_total + kept)"))})
        .filter("n > 0 and p > q")
        .select("lang", "source", F.col("term").alias("item"), F.expr("(p - q) * (p - q) div q").alias("value"))
    )


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank`` for every group of ``lang`` and ``source``.

    Terms are runs of letters a-z (A-Z are lower-cased, nothing else is) and of anything beyond ASCII; a language
    keeps those that LEAST_DOCS of its documents hold. Part ``pair`` compares a group with each other source of
    its language over all kept terms, part ``term`` names up to TERM_RANKS terms that set it apart from its whole
    language. Ranks go by value, then by the item's bytes. All arithmetic is exact, in whole numbers.

    Null texts, languages and sources are read as ''; a row counts as a document however often it is repeated.
    Groups without terms have their pairs, of value 0 if their language keeps no term; a language of one source
    has no pairs; an empty table gives no rows. Other columns are not looked at. Counts of all documents are
    used; a term's total may have 15 digits, beyond that Spark reports an overflow.
    """
    counts = term_counts(docs, text, lang, source)
    groups = source_groups(counts)
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    parts = []
    for part, rows in (("pair", pair_divergences(counts, groups)), ("term", term_divergences(counts, groups))):
        rows = rows.withColumn("rank", F.row_number().over(ranked))
        if part == "term":
            rows = rows.filter(F.col("rank") <= TERM_RANKS)  # cut in the tasks before the shuffle as well
        parts.append(rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank"))
    return parts[0].unionByName(parts[1])
