"""URL rules by a cascade of Bloom filters.

Level 1 holds the listed keys. Keys of the corpus that pass it without being listed go into level 2,
listed keys that pass level 2 into level 3, and so on until none passes wrongly. As every key that
the corpus can ask for took part, the answers are exact for all of them, and asking needs no join.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.llm.common import stage

# Bits of one level that are sent to every task: 64 MB. Beyond it, rules are met by a join.
LEVEL_BYTES = 64 << 20
FIRST_RATE = 1 / 64
LATER_RATE = 1 / 2
MAX_LEVELS = 200


class LevelTooLarge(ValueError):
    """A level is larger than what may be sent to every task."""


@dataclass(frozen=True)
class Level:
    bits: int
    hashes: int
    words: np.ndarray  # uint64


def positions(first: np.ndarray, second: np.ndarray, turn: int, bits: int) -> np.ndarray:
    """Bit number ``turn`` of every key, from two independent 64-bit hashes."""
    with np.errstate(over="ignore"):
        x = first + np.uint64((2 * turn + 1) * 0x9E3779B97F4A7C15 % 2**64) * (second | np.uint64(1))
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        x = x ^ (x >> np.uint64(29))
    return x % np.uint64(bits)


def passes(level: Level, depth: int, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    held = np.ones(len(first), dtype=bool)
    for turn in range(level.hashes):
        at = positions(first, second, depth * 64 + turn, level.bits)
        held &= (level.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
    return held


def listed(levels: list[Level], first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Whether keys are listed: the depth at which a key first fails decides by its parity."""
    answer = np.zeros(len(first), dtype=bool)
    left = np.arange(len(first))
    for depth, level in enumerate(levels):
        held = passes(level, depth, first[left], second[left])
        # Who fails an odd level is not listed, who fails an even one is.
        answer[left[~held]] = depth % 2 == 1
        left = left[held]
    # Who passes all levels belongs to the set that the last one encodes.
    answer[left] = len(levels) % 2 == 1
    return answer


def hash_with(seed: int):
    return lambda key: F.xxhash64(key, F.lit(seed))


def hashes(keys: Column) -> Column:
    return F.struct(hash_with(1)(keys).alias("first"), hash_with(2)(keys).alias("second"))


def turns_for(rate: float) -> int:
    return max(1, round(np.log2(1 / rate)))


def bits_per_key(rate: float) -> float:
    return turns_for(rate) / np.log(2)


def encode(keys: DataFrame, n: int, depth: int) -> Level:
    """A level with the keys (columns ``first``, ``second``). Tasks set bits and combine them word
    by word before the shuffle; the driver gets the filter. Every level is bounded by LEVEL_BYTES;
    a larger one is refused, and rules are then
    met by a join."""
    rate = LATER_RATE if depth else FIRST_RATE
    turns = turns_for(rate)
    bits = max(64, -(-int(n * bits_per_key(rate)) // 64) * 64)
    if bits > 8 * LEVEL_BYTES:
        raise LevelTooLarge(f"level {depth} needs {bits} bits for {n} keys")

    def set_bits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            a = rows["first"].to_numpy().astype(np.uint64)
            b = rows["second"].to_numpy().astype(np.uint64)
            at = np.concatenate([positions(a, b, depth * 64 + t, bits) for t in range(turns)])
            word, back = np.unique(at >> np.uint64(6), return_inverse=True)
            value = np.zeros(len(word), dtype=np.uint64)
            np.bitwise_or.at(value, back, np.uint64(1) << (at & np.uint64(63)))
            yield pd.DataFrame({"word": word.astype(np.int64), "value": value.astype(np.int64)})

    found = (
        keys.select("first", "second")
        .mapInPandas(set_bits, "word long, value long")
        .groupBy("word")
        .agg(F.bit_or("value").alias("value"))
        .toPandas()
    )
    words = np.zeros(bits // 64, dtype=np.uint64)
    words[found["word"].to_numpy()] = found["value"].to_numpy().astype(np.uint64)
    return Level(bits, turns, words)


def build(keys: DataFrame, universe: DataFrame) -> list[Level]:
    """A cascade that is exact for every key in ``universe`` and ``keys`` (text columns ``key``).

    Nulls take no part; repeated keys count once. Without listed keys there are no levels, and
    nothing is listed.
    """
    own = keys.filter("key is not null").distinct()
    rest = universe.filter("key is not null").distinct().join(own, "key", "left_anti")
    sides = [
        stage(side.select(hashes(F.col("key")).alias("h")).select("h.*"), "cascade")
        for side in (own, rest)
    ]
    levels: list[Level] = []
    while (n := sides[0].count()) and len(levels) < MAX_LEVELS:
        depth = len(levels)
        levels.append(encode(sides[0], n, depth))
        level = levels[-1]

        def wrongly(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for rows in batches:
                a = rows["first"].to_numpy().astype(np.uint64)
                b = rows["second"].to_numpy().astype(np.uint64)
                yield rows[passes(level, depth, a, b)]

        # The other side's false positives are what the next level encodes.
        through = sides[1].mapInPandas(wrongly, sides[1].schema)
        sides = [stage(through, "cascade"), sides[0]]
    if n:
        raise ValueError("two keys share both hashes")
    return levels


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: from the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z in lower case. Path: from
    there to ``?``, ``#`` or the end. Both empty for null and for urls without ``://``."""
    rest = F.regexp_extract(url, r"(?s)://(.*)", 1)
    host = lower_ascii(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_key(host: Column, path: Column) -> Column:
    """A host and a path as one text. A slash parts them: no host of a url holds one."""
    return F.concat(host, F.lit("/"), path)


def rule_text(key: Column) -> Column:
    """Host and path of a key, one behind the other."""
    at = F.instr(key, "/")
    return F.concat(F.substring(key, F.lit(1), at - 1), F.substring(key, at + 1, F.length(key)))


def candidates(host: Column, path: Column, lengths: list[int]) -> Column:
    """The keys of every rule that could fit: the host and its parents by labels, each with the path's prefixes
    of the lengths that rules have. Longest first, ties in order of the text."""
    labels = F.split(host, r"\.", -1)
    parents = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    starts = F.filter(
        F.array(*(F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in lengths)),
        lambda p: p.isNotNull(),
    )
    pairs = F.flatten(F.transform(parents, lambda h: F.transform(starts, lambda p: rule_key(h, p))))
    ranked = F.transform(pairs, lambda k: F.struct((-F.length(k)).alias("n"), k.alias("k")))
    return F.transform(F.array_sort(F.array_distinct(ranked)), lambda r: r["k"])


def by_join(parts: DataFrame, rules: DataFrame, url: str) -> DataFrame:
    """The same verdicts where a filter would be too large to send: every url's keys meet the rules in
    an equi-join, once per different url."""
    keys = parts.select(F.col(url).alias("__url"), "__keys").dropDuplicates(["__url"])
    met = keys.select("__url", F.posexplode("__keys").alias("__place", "key")).join(rules, "key")
    first = met.groupBy("__url").agg(F.min(F.struct("__place", "key", "block")).alias("__first"))
    return parts.join(first, F.col(url).eqNullSafe(F.col("__url")), "left").select(
        parts["*"],
        rule_text(F.col("__first.key")).alias("rule"),
        F.when(F.col("__first.block"), "block").otherwise("allow").alias("verdict"),
    )


def judge(urls: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """``urls`` with ``host``, ``path``, ``rule`` and ``verdict`` (columns of these names are replaced).

    Rules: ``host``, ``path`` (a prefix, by characters), ``action`` (allow or block); a null host, path or
    action makes a rule void, as does a host with a slash, question mark or hash, which no url has, and of repeated rules that disagree, block holds. The longest fitting
    rule decides, of equally long ones the first by text. Where none fits, ``rule`` is null and the
    verdict allow: the cascade has shown that the url is not listed.
    """
    spark: SparkSession = urls.sparkSession
    rules = (
        rules.filter("host is not null and path is not null and action is not null and not host rlike '[/?#]'")
        .groupBy(lower_ascii(F.col("host")).alias("host"), "path")
        .agg(F.max(F.col("action") == "block").alias("block"))
        .withColumn("key", rule_key(F.col("host"), F.col("path")))
    )
    lengths = sorted(r[0] for r in rules.select(F.length("path")).distinct().collect())
    held = [c for c in urls.columns if c not in ("host", "path", "rule", "verdict")]
    host, path = host_and_path(F.col(url))
    parts = urls.select(*held, host.alias("host"), path.alias("path")).withColumn(
        "__keys", candidates(F.col("host"), F.col("path"), lengths) if lengths else F.array().cast("array<string>")
    )
    universe = parts.select(F.explode("__keys").alias("key"))
    try:
        both = [build(rules.select("key"), universe), build(rules.filter("block").select("key"), rules.select("key"))]
    except LevelTooLarge:
        return by_join(parts, rules, url).select(*held, "host", "path", "rule", "verdict")
    # Plain values: the workers need no class of ours to unpack them.
    sent = spark.sparkContext.broadcast([[(x.bits, x.hashes, x.words) for x in levels] for levels in both])

    @F.pandas_udf("place int, block boolean")
    def first_listed(first: pd.Series, second: pd.Series) -> pd.DataFrame:
        known, blocked = ([Level(*x) for x in levels] for levels in sent.value)
        sizes = first.map(len).to_numpy(dtype=np.int64)
        none = np.zeros(0, np.int64)
        a = np.concatenate([*first, none]).astype(np.int64).view(np.uint64)
        b = np.concatenate([*second, none]).astype(np.int64).view(np.uint64)
        hit = np.flatnonzero(listed(known, a, b))
        ends = np.cumsum(sizes)
        row, at = np.unique(np.searchsorted(ends, hit, side="right"), return_index=True)
        place = np.zeros(len(sizes), dtype=np.int32)
        place[row] = hit[at] - (ends - sizes)[row] + 1
        block = np.zeros(len(sizes), dtype=bool)
        block[row] = listed(blocked, a[hit[at]], b[hit[at]])
        return pd.DataFrame({"place": place, "block": block})

    hashed = [F.transform("__keys", hash_with(n)) for n in (1, 2)]
    return parts.withColumn("__hit", first_listed(*hashed)).select(
        *held,
        "host",
        "path",
        F.when(F.col("__hit.place") > 0, rule_text(F.get("__keys", F.col("__hit.place") - 1))).alias("rule"),
        F.when(F.col("__hit.block"), "block").otherwise("allow").alias("verdict"),
    )
