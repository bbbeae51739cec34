"""Mixing sources to target weights, in blocks of tokens.

The words of a source, documents in a seeded order, form one long sequence that is packed into
blocks of a fixed number of tokens. Each output shard draws how many slots every source fills
(multinomial over what the sources still have to give); the slots of a source are numbered through all
shards, and a keyed permutation per source and pass maps slot numbers to block numbers. Slots and
blocks then meet in an equi-join on the block's number.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from stratamart.llm.common import (
    marked,
    running_offsets,
    seeded_key,
    slice_of,
    slices_for,
    stage,
    word_count,
)

SEED = "mix-1"
BLOCK = 128
SHARDS = 64
# Weights of sources in order of code points, repeating; and the share of all words to give out.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
PASSES = 2
# Slots that one row of the plan expands to.
EXPAND = 1 << 16
# common.WORD inside a SQL text.
WORD_SQL = r"[^\\x20\\x09-\\x0D]+"


def share_out(sizes: dict[str, int], weights=WEIGHTS, share=SHARE, passes=PASSES) -> dict[str, float]:
    """Target words per source: by weight, none above ``passes`` times its size; what lies above is
    shared among the others by weight, until none is above."""
    names = sorted(sizes)
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    left = share * sum(sizes.values())
    open_names, targets = set(names), {}
    while open_names:
        total = sum(weight[n] for n in open_names)
        above = {n for n in open_names if left * weight[n] / total > passes * sizes[n]}
        if not above:
            targets |= {n: left * weight[n] / total for n in open_names}
            break
        targets |= {n: float(passes * sizes[n]) for n in above}
        left -= sum(passes * sizes[n] for n in above)
        open_names -= above
    return targets


def slots_of(size: int, words: float, block: int = BLOCK) -> tuple[int, int]:
    """Slots a source fills so that they hold ``words`` words in all, and the words of the last.

    A pass over all blocks gives the source's whole size. A last pass that stops early takes as many
    blocks as the rest needs, the last of them only in part; should the source's one short block be
    among them, the source gives less than its target, by less than one block.
    """
    target = round(words)
    blocks = -(-size // block)
    if not target or not blocks:
        return 0, 0
    whole, rest = divmod(target, size)
    if not rest:
        return whole * blocks, block
    return whole * blocks + -(-rest // block), (rest - 1) % block + 1


def draw_counts(slots: np.ndarray, shards: int, seed: int = 9) -> np.ndarray:
    """Slots of each source (columns) in each shard (rows). Shards are of equal size, to one slot.
    Draws are multinomial with the shares of what is left; a source that would give more than it
    has left passes the rest on, so column sums are exactly ``slots``."""
    rng = np.random.Generator(np.random.PCG64(seed))
    left = slots.astype(np.int64).copy()
    total = int(left.sum())
    counts = np.zeros((shards, len(left)), dtype=np.int64)
    for shard in range(shards):
        size = total * (shard + 1) // shards - total * shard // shards
        while size:
            drawn = np.minimum(rng.multinomial(size, left / left.sum()), left)
            counts[shard] += drawn
            left -= drawn
            size -= int(drawn.sum())
    return counts


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A pseudorandom permutation of range(size) at ``index``, elementwise, chosen by ``key``:
    four Feistel rounds on the smallest even-width power of two, walked until inside the range."""
    width = np.ones(len(size), dtype=np.uint64)
    for step in range(1, 32):
        width[size > (1 << (2 * step))] = step + 1
    low = (np.uint64(1) << width) - np.uint64(1)
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        w, m, k = width[todo], low[todo], key[todo].astype(np.uint64)
        left, right = out[todo] >> w, out[todo] & m
        for turn in range(1, 5):
            x = right + k + np.uint64(turn * 0x9E3779B97F4A7C15 % 2**64)
            x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((x ^ (x >> np.uint64(31))) & m)
        out[todo] = (left << w) | right
        todo = todo[out[todo] >= size[todo].astype(np.uint64)]
    return out.astype(np.int64)


def place_slots(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Block number of every slot."""
    for rows in batches:
        blocks = rows["blocks"].to_numpy()
        rows["turn"], index = np.divmod(rows["slot"].to_numpy(), np.maximum(blocks, 1))
        rows["block"] = permuted(index, blocks, rows["key"].to_numpy() + rows["turn"].to_numpy() * 7919)
        yield rows[["__source", "shard", "slot", "turn", "take", "block"]]


PLACED = "__source string, shard int, slot long, turn long, take long, block long"


def row_hash(df: DataFrame, columns: list[str]) -> Column:
    """A 64-bit hash of some columns, nulls told apart from values; maps, which have no order, are left out."""
    held = [F.col(f"`{c}`") for c in columns if not isinstance(df.schema[c].dataType, MapType)]
    nulls = F.concat(*(F.when(c.isNull(), F.lit("1")).otherwise(F.lit("0")) for c in held))
    return F.xxhash64(nulls, *held)


def packed(df: DataFrame, key: str, source: str, text: str, seed: str, identity: list[str]) -> DataFrame:
    """Every row's place in its source's sequence of words: ``__doc``, ``__source``, ``__size``,
    ``__row`` (a hash of the columns ``identity``), ``__start`` (words before it). Written to the shared folder:
    small, and read twice."""
    words = df.select(
        F.col(key).alias("__doc"),
        marked(F.col(source)).alias("__source"),
        word_count(F.col(text)).alias("__size"),
        row_hash(df, identity).alias("__row"),
        seeded_key(F.col(key), seed).alias("__key"),
    )
    words = words.withColumn("__slice", slice_of(F.col("__key"), slices_for(df.count())))
    words = stage(words, "mix-words")
    offsets = running_offsets(words, "__source", "__slice", F.col("__size"))
    before = (
        Window.partitionBy("__source", "__slice")
        .orderBy("__key", "__doc", "__size", "__row")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    places = words.join(offsets, ["__source", "__slice"]).select(
        "__doc",
        "__source",
        "__size",
        "__row",
        (F.col("__before") + F.coalesce(F.sum("__size").over(before), F.lit(0)))
        .cast("long")
        .alias("__start"),
    )
    return stage(places, "mix-places")


def slot_rows(spark, sizes: dict[str, int], targets: dict[str, float], shards: int, block: int):
    """One row per output slot: which block, and how many of its words (``take``). The plan has a row
    per source and shard; slots are numbered and permuted on executors."""
    names = sorted(sizes)
    filled = {n: slots_of(sizes[n], targets[n], block) for n in names}
    counts = draw_counts(np.array([filled[n][0] for n in names], dtype=np.int64), shards)
    starts = np.cumsum(counts, axis=0) - counts
    plan = [
        (n, shard, int(starts[shard, i]), int(counts[shard, i]), -(-sizes[n] // block),
         filled[n][0], filled[n][1], (i + 1) * 1_000_003)
        for i, n in enumerate(names)
        for shard in range(shards)
        if counts[shard, i]
    ]
    schema = "__source string, shard int, first long, n long, blocks long, slots long, last long, key long"
    return (
        spark.createDataFrame(plan, schema)
        .withColumn("low", F.explode(F.expr(f"sequence(0L, n - 1, {EXPAND}L)")))
        .withColumn("at", F.explode(F.expr(f"sequence(low, least(low + {EXPAND - 1}L, n - 1))")))
        .withColumn("slot", F.expr("first + at"))
        .withColumn("take", F.expr(f"if(slot = slots - 1, last, {block}L)"))
        .select("__source", "shard", "slot", "take", "blocks", "key")
        .mapInPandas(place_slots, PLACED)
    )


@dataclass(frozen=True)
class Mixture:
    """``spans``: ``shard``, ``slot``, ``turn`` (the pass), ``__source``, ``__start``, ``first_word``,
    ``n_words`` - which words of which row fill a slot; a block that two passes take occurs twice.
    ``places``: see ``packed``. ``sources``: size and target words per source."""

    spans: DataFrame
    places: DataFrame
    sources: dict[str, tuple[int, float]]


def mix(
    df: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    block: int = BLOCK,
    shards: int = SHARDS,
    seed: str = SEED,
    identity: list[str] | None = None,
) -> Mixture:
    """Rows without words give nothing; a null source is a source, a null key a key; every repeated
    row has its own place. Columns other than the three named are not looked at, unless ``identity`` names them: rows of one key are
    packed in the order of a hash of the columns that it names. An empty table gives an empty mixture. Only a row per source and the plan (sources x shards) pass the driver.
    """
    places = packed(df, key, source, text, seed, identity or [key, source, text])
    sizes = {r[0]: int(r[1]) for r in places.groupBy("__source").agg(F.sum("__size")).collect()}
    targets = share_out(sizes)
    slots = slot_rows(df.sparkSession, sizes, targets, shards, block)
    pieces = (
        places.filter("__size > 0")
        .withColumn(
            "block",
            F.explode(F.expr(f"sequence(__start div {block}L, (__start + __size - 1) div {block}L)")),
        )
        .withColumn("__from", F.expr(f"greatest(__start, block * {block}L)"))
        .withColumn("__to", F.expr(f"least(__start + __size, (block + 1) * {block}L)"))
    )
    spans = (
        pieces.join(slots, ["__source", "block"])
        .withColumn("n_words", F.expr(f"least(__to, block * {block}L + take) - __from"))
        .filter("n_words > 0")
        .withColumn("first_word", F.expr("__from - __start"))
        .select("shard", "slot", "turn", "__source", "__start", "first_word", "n_words")
    )
    return Mixture(spans, places, {n: (sizes[n], targets[n]) for n in sizes})


def words_taken(mixture: Mixture) -> DataFrame:
    """Per row of the mixed table: ``__doc``, ``__source``, ``__size``, ``taken`` (0 if none): every repeated row for
    itself, null keys and sources as they are, rows without words with 0; nothing for an empty table."""
    taken = mixture.spans.groupBy("__source", "__start").agg(F.sum("n_words").alias("taken"))
    full = mixture.places.filter("__size > 0").join(taken, ["__source", "__start"], "left")
    none = mixture.places.filter("__size = 0").withColumn("taken", F.lit(None).cast("long"))
    columns = ["__doc", "__source", "__size", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")]
    return full.select(*columns).unionByName(none.select(*columns))


def mixed_texts(df: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """What the mixture takes, as rows of ``df``: one per row and pass that takes any of its words,
    with the words taken, joined by blanks where some are left out, and else with its text as it is.
    ``n_chars``, where there is such a column, follows the text.

    Rows without words are not taken. Rows are told apart by all of their columns, so rows of one key, null keys
    among them, keep what is theirs; rows equal in all columns are taken each for itself. An empty table gives none."""
    mixture = mix(df, key, source, text, identity=df.columns)
    runs = (
        mixture.spans.groupBy("__source", "__start", "turn")
        .agg(
            F.sort_array(F.collect_list(F.struct("first_word", "n_words"))).alias("__runs"),
            F.sum("n_words").alias("__taken"),
        )
        .join(mixture.places, ["__source", "__start"])
        .filter("__size > 0")
        .select("__doc", "__row", "__size", "__runs", "__taken")
    )
    held = df.columns
    identity = ["__doc", "__row"]
    # Rows without words are in no span, and there may be very many of them.
    worded = df.filter(word_count(F.col(text)) > 0)
    texts = worded.withColumns({"__doc": F.col(key), "__row": row_hash(df, held)}).dropDuplicates(identity)
    met = texts.alias("t").join(
        runs.alias("r"), [F.col(f"t.{c}").eqNullSafe(F.col(f"r.{c}")) for c in identity]
    )
    cut = F.expr(
        f"array_join(flatten(transform(r.__runs, x -> slice(regexp_extract_all(t.`{text}`, "
        f"'{WORD_SQL}', 0), int(x.first_word + 1), int(x.n_words)))), ' ')"
    )
    out = F.when(F.col("r.__taken") < F.col("r.__size"), cut).otherwise(F.col(f"t.{text}"))
    mixed = met.select(*(out.alias(c) if c == text else F.col(f"t.{c}") for c in held))
    if "n_chars" in held:
        mixed = mixed.withColumn("n_chars", F.length(text).cast(df.schema["n_chars"].dataType))
    return mixed
