"""Finding benchmark passages in documents, in DataFrame operations alone.

A window of a document is as long as the item it is held against. Windows are looked at where a document shares
one of an item's rarest shingles. Their SimHash fingerprints are cut into more blocks than RADIUS, so that
fingerprints within RADIUS bits agree on a block; of the windows that do, those within RADIUS are verified by
the exact similarity of their shingles, weighted by occurrences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratamart.functions.payload import once
from stratamart.llm.common import stage

SHINGLE = 5
PERCENT = 80
SIMILARITY = PERCENT / 100
# Two windows of m shingles that are 0.8 similar share 8/9 of them, so their fingerprints differ in a bit with a
# probability of some arccos(8/9) / pi = 0.15: in 9.7 of 64 bits, with a deviation of 2.9.
RADIUS = 23
# Rows of two or three numbers that are broadcast: anchors, and documents that meet an item (with the hashed
# relation's overhead some 64 MB); more of them are met by a shuffled join.
BROADCAST_ROWS = 1_000_000


def shingles(words: str) -> str:
    """A hash of every five words in a row, in order."""
    return (
        f"transform(sequence(1, greatest(1, size({words}) - {SHINGLE - 1})), i -> xxhash64(slice({words}, i, {SHINGLE})))"
    )


def majorities(hashes: str, lane: int) -> str:
    """The bits that most of some hashes have set. Sums of ``64 / lane`` bits are taken in one number, which holds
    them side by side in lanes of so many bits; two bits of each stay free, so that nothing overflows."""
    ones = sum(1 << at for at in range(0, 64, lane))
    bits = []
    for k in range(lane):
        counts = f"aggregate({hashes}, 0L, (sum, h) -> sum + (shiftrightunsigned(h, {k}) & {ones}L))"
        over = f"({counts} + ({(1 << (lane - 2)) - 1} - size({hashes}) div 2) * {ones}L) & {ones << (lane - 2)}L"
        bits.append(f"shiftleft(shiftrightunsigned({over}, {lane - 2}), {k})")
    return " | ".join(bits)


def fingerprint(hashes: str) -> str:
    """SimHash of shingles, each counted as often as it occurs."""
    return f"if(size({hashes}) < {1 << 14}, {majorities(hashes, 16)}, {majorities(hashes, 32)})"


def blocks(bits: str) -> str:
    """RADIUS + 1 blocks that make up a fingerprint, each with its place: fingerprints within RADIUS bits have one in
    common."""
    parts = RADIUS + 1
    cuts = [64 * i // parts for i in range(parts + 1)]
    return "array({})".format(
        ", ".join(
            f"{i << 32}L + (shiftrightunsigned({bits}, {low}) & {(1 << (high - low)) - 1}L)"
            for i, (low, high) in enumerate(zip(cuts, cuts[1:], strict=False))
        )
    )


# For a document's and an item's shingles (``m`` of them, ``wanted``): how many a window has.
WIDTH = f"(least(size(shingles), n - {SHINGLE - 1}))"
# The best window ends with a shingle of the item or is the document's first: any other can be moved to the
# left without losing one. So can the first of several best ones.
STARTS = "array_distinct(array_compact(transform(shingles, (x, i) -> if(array_contains(wanted, x), greatest(0, i - width + 1), null))))"
# Shingles that window and item share, each as often as in the one that has fewer.
SHARED = (
    "if(plain, size(array_intersect(wanted, win)), aggregate(array_distinct(wanted), 0, (sum, y) -> sum + "
    "least(size(filter(win, z -> z = y)), size(filter(wanted, z -> z = y)))))"
)


def prepared(rows: DataFrame, text: str) -> DataFrame:
    """Rows of at least five words, with ``words`` - runs of letters and digits in lower case, so that
    marks and blanks make no difference - and ``mark``, a hash of the text."""
    return (
        rows.withColumn("mark", F.xxhash64(text))
        .withColumn("words", F.expr(f"regexp_extract_all(lower({text}), '[\\\\p{{L}}\\\\p{{N}}]+', 0)"))
        .filter(f"size(words) >= {SHINGLE}")
    )


def prepared_items(items: DataFrame, item: str, text: str) -> DataFrame:
    """``item_id``, ``own`` (a hash of the words), ``n``, ``wanted``, ``m`` and ``print`` of every different item."""
    return stage(
        prepared(items.select(F.col(item).alias("item_id"), F.col(text).alias("text")), "text")
        .select(
            "item_id",
            F.xxhash64("words").alias("own"),
            F.size("words").alias("n"),
            F.expr(shingles("words")).alias("wanted"),
        )
        .withColumns({"m": F.size("wanted"), "print": F.expr(fingerprint("wanted"))})
        .distinct(),
        "items",
    )


def sent(rows: DataFrame) -> DataFrame:
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def anchors_of(known: DataFrame) -> DataFrame:
    """``item_id``, ``own`` and ``shingle``: the shingles that documents meet items by. A window may lack 20 % of an
    item's shingles, so it has one of any that are more. Those that the fewest items have are taken, so that a phrase
    of many items does not bring all of them together."""
    each = known.select("item_id", "own", "m", F.explode("wanted").alias("shingle"))
    spread = each.select("item_id", "own", "shingle").distinct().groupBy("shingle").agg(F.count("*").alias("items"))
    rarest = Window.partitionBy("item_id", "own").orderBy("items", "shingle")
    return stage(
        each.join(spread, "shingle")
        .withColumn("turn", F.row_number().over(rarest))
        .filter(f"turn <= {100 - PERCENT} * m div 100 + 1")
        .select("item_id", "own", "shingle")
        .distinct(),
        "anchors",
    )


def windows(docs: DataFrame, known: DataFrame) -> DataFrame:
    """``doc_id``, ``mark``, ``item_id``, ``n``, ``wanted``, ``plain``, ``print``, ``start`` and ``win``, the shingles of
    a window, for the windows of all rows of ``doc_id`` and ``text`` that may hold an item."""
    met = (
        prepared(docs, "text")
        .select("doc_id", "mark", F.explode(F.array_distinct(F.expr(shingles("words")))).alias("shingle"))
        .join(sent(anchors_of(known)), "shingle")
        .select("doc_id", "mark", "item_id", "own")
        .distinct()
    )
    plain = F.expr("size(array_distinct(wanted)) = m").alias("plain")
    per_doc = stage(
        met.alias("p")
        .join(known.alias("i"), F.expr("p.item_id <=> i.item_id and p.own = i.own"))
        .select("doc_id", "mark", F.struct("i.item_id", "n", "wanted", "print", plain).alias("item"))
        .groupBy("doc_id", "mark")
        .agg(F.collect_list("item").alias("items")),
        "met",
    )
    # Only texts that meet an item are shuffled to what they meet, and cut into words again.
    same = F.expr("d.doc_id <=> w.doc_id and own_mark = w.mark")
    hashed = docs.withColumn("own_mark", F.xxhash64("text")).alias("d")
    hashed = hashed.join(sent(per_doc.select("doc_id", "mark")).alias("w"), same, "left_semi").alias("d")
    return (
        prepared(hashed.join(per_doc.alias("w"), same).select("d.doc_id", "text", "items"), "text")
        .select("doc_id", "mark", "items", F.expr(shingles("words")).alias("shingles"))
        .select("doc_id", "mark", "shingles", F.inline("items"))
        .withColumn("width", F.expr(WIDTH))
        .withColumn("starts", F.expr(STARTS))
        .select(
            "doc_id", "mark", "item_id", "n", "wanted", "plain", "print",
            F.inline(F.expr("transform(starts, s -> struct(s as start, slice(shingles, s + 1, width) as win))")),
        )
    )


def held_items(docs: DataFrame, known: DataFrame) -> DataFrame:
    """``doc_id``, ``mark``, ``item_id``, ``start``, ``n``, ``distance`` and ``similarity`` of every window that holds an item."""
    found = once(windows(docs, known), win_print=F.expr(fingerprint("win")))
    near = found.filter(F.arrays_overlap(F.expr(blocks("win_print")), F.expr(blocks("print")))).withColumn(
        "distance", F.bit_count(F.expr("win_print ^ print"))
    )
    return (
        once(near.filter(F.col("distance") <= RADIUS), shared=F.expr(SHARED))
        .withColumn("similarity", F.expr("shared / (size(win) + size(wanted) - shared)"))
        .filter(F.col("similarity") >= SIMILARITY)
        .select("doc_id", "mark", "item_id", "start", "n", "distance", "similarity")
    )


def passages(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``doc_id``, ``mark``, ``item_id``, ``start`` (word, from 0), ``n_words``, ``distance``, ``similarity``:
    the best window of each row of ``docs`` for each item that it holds.

    A window holds an item if their fingerprints are within RADIUS bits and their shingles, weighted by
    occurrences, at least SIMILARITY similar (sum of smaller counts over sum of larger ones); of equally similar
    windows the first. Null or empty texts, and texts of fewer than five words, hold nothing and are held nowhere.
    Repeated rows count once: ``mark`` is a hash of the text, and rows with equal ids and texts share a result.
    Null ids are values like others. Other columns are not looked at.
    """
    own_docs = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    best = F.max(F.struct("similarity", (-F.col("start")).alias("back"), "n", (-F.col("distance")).alias("near"))).alias("best")
    return (
        held_items(own_docs, prepared_items(items, item, item_text))
        .groupBy("doc_id", "mark", "item_id")
        .agg(best)
        .select(
            "doc_id",
            "mark",
            "item_id",
            (-F.col("best.back")).alias("start"),
            F.col("best.n").alias("n_words"),
            (-F.col("best.near")).alias("distance"),
            "best.similarity",
        )
    )


def without_passages(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` less the rows that hold an item, as ``passages`` finds them. Rows with null or short texts stay, rows of one
    id are judged each by its own text, repeated rows stay or go together; without items all stay."""
    own_docs = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    held = held_items(own_docs, prepared_items(items, "item_id", "text"))
    found = stage(held.select("doc_id", "mark").distinct(), "contaminated")
    marked = docs.withColumn("__mark", F.xxhash64(text)).alias("d")
    same = F.expr(f"d.`{key}` <=> c.doc_id and d.__mark = c.mark")
    return marked.join(found.alias("c"), same, "left_anti").drop("__mark")
