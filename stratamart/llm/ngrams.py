"""Similarity join on word n-grams: documents whose shingle sets have a Jaccard similarity of at least
a threshold, and the groups that they form.

Sizes of linked sets differ by the threshold at most, so sets are handled in bands of sizes. In a
band, the space of hashes is cut into more parts than two linked sets can differ in elements: they
agree on some part entirely. Sets that agree on a part (same band, part and contents) meet in a tile.
There, bitmaps bound the overlap from above: each set's elements flip bits of 512, and two bitmaps
differ in no more bits than the sets in elements. Finer bitmaps, four bits an element, do the same
for the pairs that are left. Pairs that pass are decided by intersecting the sorted arrays of the sets.

Groups of copies stay cheap: equal sets are one set; in each tile neighbours are decided first, then the
closest sets of different groups, and only tiles that still hold different groups are searched in full, by bitmaps
that grow with the sets. Tiles of two sets hold no more than the neighbours that were decided first.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratamart.llm.arrow_text import runs
from stratamart.llm.common import Scratch, stage
from stratamart.llm.groups import connected

N = 4
PERCENT = 85
BANDS = 1.5
BITMAP = 8  # words of 64 bits
TILE_BITMAP = 128  # words at most that a set brings to a tile
SEEDS = 3
# Bytes of text that are hashed at once, sets of one side of a tile, ids that are broadcast (16 bytes
# each in the hashed relation, some 64 MB in all); beyond it ids are met by a shuffled join.
BATCH_BYTES = 1 << 19
TILE = 2_048
# Pairs of a tile that are held before they are handed on.
STRIP = 100_000
BROADCAST_IDS = 2_000_000

BLANKS = np.zeros(256, dtype=bool)
BLANKS[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
# Random numbers per place in a word and byte: sums of them tell words apart.
WORD_TABLE = np.random.Generator(np.random.PCG64(4)).integers(0, 2**64, (256, 256), dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A scrambling of 64-bit numbers, one to one."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A hash per word, A-Z taken as a-z, and the text each word is in."""
    data = LOWER[np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)]
    blank = BLANKS[data]
    first = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
    if not len(first):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    inside = np.flatnonzero(~blank)
    last = np.flatnonzero(blank & np.concatenate([[False], ~blank[:-1]]))
    lengths = last - first
    starts = np.cumsum(lengths) - lengths
    place = np.arange(len(inside)) - np.repeat(starts, lengths)
    values = WORD_TABLE[place & 255, data[inside]]
    if lengths.max() > 256:
        values = values * (2 * (place >> 8) + 1).astype(np.uint64)
    ends = np.cumsum([len(t) + 1 for t in texts])
    return mixed(np.add.reduceat(values, starts)), np.searchsorted(ends, first, "right")


def shingle_sets(texts: list[bytes], n: int = N) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text: of ``n`` words each, of all words if fewer."""
    words, owner = word_hashes(texts)
    counts = np.bincount(owner, minlength=len(texts))
    size = np.minimum(counts, n)[owner]
    place = np.arange(len(words)) - (np.cumsum(counts) - counts)[owner]
    whole = np.flatnonzero(place + size <= counts[owner])
    out = mixed(size[whole].astype(np.uint64))
    for step in range(n):
        held = size[whole] > step
        out[held] = mixed(out[held] * np.uint64(3) + words[whole[held] + step])
    owner = owner[whole]
    order = np.lexsort((out, owner))
    out, owner = out[order], owner[order]
    new = np.ones(len(out), dtype=bool)
    new[1:] = (out[1:] != out[:-1]) | (owner[1:] != owner[:-1])
    return np.split(out[new], np.searchsorted(owner[new], np.arange(1, len(texts))))


def batches_of(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Runs of some BATCH_BYTES of text and their sets; a null text's set is empty."""
    for batch in batches:
        for run in runs(batch, most=BATCH_BYTES):
            yield run, shingle_sets([(t or "").encode() for t in run["text"].to_pylist()], n)


def name_of(hashes: np.ndarray) -> np.uint64:
    """What tells a set from others."""
    return mixed(hashes).sum()


def signed(values: list[np.uint64]) -> np.ndarray:
    return np.array(values, dtype=np.uint64).view(np.int64)


@dataclass(frozen=True)
class Band:
    low: int  # smallest size
    high: int  # largest size
    parts: int
    spare: int  # empty parts that a set may have


def bands(largest: int, percent: int = PERCENT) -> list[Band]:
    """Bands of sizes up to ``largest``. Two linked sets of at most ``high`` elements differ in
    ``differ`` elements at most, hence agree on all but ``differ`` parts; with ``spare`` more parts
    they agree on a part that is not empty, unless both have more than ``spare`` empty ones."""
    out, low = [], 1
    while low <= largest:
        high = max(low, int(low * BANDS) - 1)
        differ = (100 - percent) * 2 * high // (100 + percent)
        spare = 1
        for _ in range(3):
            mean = (differ + 1 + spare) * np.exp(-low / (differ + 1 + spare))
            spare = int(np.ceil(mean + 3 * np.sqrt(mean)))
        out.append(Band(low, high, differ + 1 + spare if differ else 0, spare))
        low = high + 1
    return out


def part_keys(hashes: np.ndarray, band: Band, last_seed: int = SEEDS) -> np.ndarray:
    """What a set has in the parts of a band, a number for each part that is not empty. Sets with
    more empty parts than the band allows for are cut in other ways as well, and state their empty
    parts in the end, so no two linked sets can miss each other."""
    keys = []
    for seed in range(last_seed):
        own = hashes if not seed else np.sort(mixed(hashes + np.uint64(seed)))
        part = ((own >> np.uint64(32)) * np.uint64(band.parts)) >> np.uint64(32)
        starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        sums = np.add.reduceat(mixed(own), starts)
        name = np.uint64((seed << 56) + (band.parts << 28)) + part[starts]
        keys.append(mixed(sums ^ mixed(name)))
        if band.parts - len(starts) <= band.spare:
            return np.concatenate(keys)
    empty = np.setdiff1d(np.arange(band.parts, dtype=np.uint64), part)
    keys.append(mixed(mixed(empty + np.uint64((seed << 56) + (band.parts << 28)))))
    return np.concatenate(keys)


def keys_of(hashes: np.ndarray, table: list[Band], percent: int = PERCENT) -> np.ndarray:
    """Keys of a set in its own band and, where it may link with larger sets there, in the next."""
    size = len(hashes)
    at = next(i for i, b in enumerate(table) if size <= b.high)
    keys = [part_keys(hashes, table[at])] if table[at].parts else []
    if 100 * size >= percent * table[at + 1].low and table[at + 1].parts:
        keys.append(part_keys(hashes, table[at + 1]))
    return np.concatenate(keys) if keys else np.zeros(0, np.uint64)


def bitmap(hashes: np.ndarray, words: int = BITMAP) -> np.ndarray:
    """Bits of which each is flipped by the elements that fall on it; ``words`` is a power of two."""
    bits = (hashes >> np.uint64(7)) & np.uint64(64 * words - 1)
    odd = np.bincount(bits.astype(np.int64), minlength=64 * words) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64)


def fine_bitmap(hashes: np.ndarray) -> np.ndarray:
    """A bitmap of four bits an element at least, so that it tells large sets apart as well."""
    words = BITMAP
    while 64 * words < 4 * len(hashes):
        words *= 2
    return bitmap(hashes, words)


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """The smaller bitmap of the same set: each of its bits is flipped by what flips those it stands for."""
    while len(bits) > words:
        half = len(bits) // 2
        bits = bits[:half] ^ bits[half:]
    return bits


def describe(n: int):
    """Per document: size of its set, two hashes of the set, its bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, sets in batches_of(batches, n):
            yield pa.RecordBatch.from_pydict(
                {
                    "id": rows["id"],
                    "mark": rows["mark"],
                    "n": pa.array([len(own) for own in sets], pa.int64()),
                    "first": signed([name_of(own) for own in sets]),
                    "second": signed([name_of(own ^ np.uint64(0xA5A5)) for own in sets]),
                    "bits": pa.array([bitmap(own).view(np.int64) for own in sets], pa.list_(pa.int64())),
                }
            )

    return run


def emit_keys(n: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = bands(1_000, percent)
        for _, sets in batches_of(batches, n):
            for own in sets:
                if len(own):
                    while table[-1].low <= 2 * len(own):
                        table = bands(4 * len(own), percent)
                    found = keys_of(own, table, percent)
                    if len(found):
                        yield pa.RecordBatch.from_pydict(
                            {"key": found.view(np.int64), "first": np.full(len(found), name_of(own)).view(np.int64)}
                        )

    return run


def emit_arrays(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sets in batches_of(batches, n):
            yield pa.RecordBatch.from_pydict(
                {"id": signed([name_of(own) for own in sets]), "array": pa.array([own.tobytes() for own in sets], pa.binary())}
            )

    return run


def emit_bitmaps(n: int):
    """Fine bitmaps, and those of a bit an element that sets bring to tiles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sets in batches_of(batches, n):
            fine = [fine_bitmap(own) for own in sets]
            bits = [folded(own, min(max(BITMAP, len(own) // 4), TILE_BITMAP)) for own in fine]
            yield pa.RecordBatch.from_pydict(
                {
                    "id": signed([name_of(own) for own in sets]),
                    "n": pa.array([len(own) for own in sets], pa.int64()),
                    "fine": pa.array([own.tobytes() for own in fine], pa.binary()),
                    "bits": pa.array([own.view(np.int64) for own in bits], pa.list_(pa.int64())),
                }
            )

    return run


def bound(percent: int):
    """Pairs whose fine bitmaps, at the size of the smaller one, leave room for the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            close = []
            sizes = np.add(rows["n_a"].to_numpy(), rows["n_b"].to_numpy())
            for a, b, total in zip(rows["fine_a"], rows["fine_b"], sizes.tolist(), strict=True):
                a, b = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                words = min(len(a), len(b))
                most = (total - int(np.bitwise_count(folded(a, words) ^ folded(b, words)).sum())) // 2
                close.append(100 * most >= percent * (total - most))
            yield rows.select(["a", "b"]).filter(pa.array(close, pa.bool_()))

    return run


def decide(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            linked = []
            for a, b in zip(rows["array_a"], rows["array_b"], strict=True):
                # Views of the batch: the arrays are not copied.
                a, b = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                shared = len(np.intersect1d(a, b, assume_unique=True))
                linked.append(100 * shared >= percent * (len(a) + len(b) - shared))
            yield rows.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return run


def open_pairs(rows: pd.DataFrame, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of rows of a tile that belong to different groups and that the bitmaps do not rule out, and
    how far apart they are at least. All tiles are worked on at once: each row with the next of its
    tile, then with the one after that, until no tile has rows that far apart."""
    tile = np.cumsum(rows["starts"].to_numpy())
    sizes, labels = rows["n"].to_numpy(), rows["label"].to_numpy()
    blocks, low, high = (rows[c].to_numpy() for c in ("block", "low", "high"))
    bits = [np.asarray(own).view(np.uint64) for own in rows["bits"]]
    width = np.array([len(own) for own in bits])
    # Per width the bitmaps of all rows that have as many words, folded to it, and where each row's is.
    levels = {}
    for words in np.unique(width).tolist():
        wide = width >= words
        levels[words] = np.cumsum(wide) - 1, np.stack([folded(bits[i], words) for i in np.flatnonzero(wide)])
    for apart in range(1, len(rows)):
        at = np.flatnonzero(tile[:-apart] == tile[apart:])
        if not len(at):
            break
        to = at + apart
        # Two blocks meet in a tile of their own; pairs inside a block belong to the tile of that block.
        wanted = (labels[at] != labels[to]) & ((low[at] == high[at]) | (blocks[at] != blocks[to]))
        at, to = at[wanted], to[wanted]
        total = sizes[at] + sizes[to]
        differ, narrow = np.zeros(len(at), np.int64), np.minimum(width[at], width[to])
        for words, (place, level) in levels.items():
            of = narrow == words
            if of.any():
                differ[of] = np.bitwise_count(level[place[at[of]]] ^ level[place[to[of]]]).sum(axis=1, dtype=np.int64)
        most = (total - differ) // 2
        ok = 100 * most >= percent * (total - most)
        yield at[ok], to[ok], differ[ok] / total[ok]


def as_pairs(a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame(np.unique(np.sort(np.column_stack([a, b]), axis=1), axis=0), columns=["a", "b"])


def all_pairs(rows: pd.DataFrame, percent: int) -> Iterator[pd.DataFrame]:
    """Every open pair of whole tiles, STRIP of them at a time."""
    names, held, n = rows["id"].to_numpy(), [], 0
    for at, to, _ in open_pairs(rows, percent):
        held.append((names[at], names[to]))
        n += len(at)
        if n >= STRIP:
            yield as_pairs(*(np.concatenate(side) for side in zip(*held, strict=True)))
            held, n = [], 0
    if n:
        yield as_pairs(*(np.concatenate(side) for side in zip(*held, strict=True)))


def closest_pairs(rows: pd.DataFrame, percent: int) -> Iterator[pd.DataFrame]:
    """For each group in each of some whole tiles, the open pair that brings it closest to another one."""
    names, labels, tile = rows["id"].to_numpy(), rows["label"].to_numpy(), np.cumsum(rows["starts"].to_numpy())
    far, partner = np.full(len(rows), np.inf), np.full(len(rows), -1)
    for at, to, differ in open_pairs(rows, percent):
        for own, other in ((at, to), (to, at)):  # a row occurs once on either side
            closer = differ < far[own]
            far[own[closer]], partner[own[closer]] = differ[closer], other[closer]
    order = np.lexsort((names, far, labels, tile))
    first = np.ones(len(order), dtype=bool)
    first[1:] = (tile[order][1:] != tile[order][:-1]) | (labels[order][1:] != labels[order][:-1])
    best = order[first]
    best = best[partner[best] >= 0]
    yield as_pairs(names[best], names[partner[best]])


def of_whole_tiles(batches: Iterator[pd.DataFrame], search, percent: int) -> Iterator[pd.DataFrame]:
    """``search`` over rows in order of tiles, which may go over several batches."""
    held = None
    for rows in batches:
        names = rows[["key", "low", "high"]]
        rows["starts"] = (names != names.shift()).any(axis=1)
        if held is not None:
            rows.loc[rows.index[0], "starts"] = bool(
                (names.iloc[0] != held[["key", "low", "high"]].iloc[-1]).any()
            )
            rows = pd.concat([held, rows], ignore_index=True)
        cut = np.flatnonzero(rows["starts"].to_numpy())[-1] if len(rows) else 0
        if cut:
            yield from search(rows.iloc[:cut], percent)
        held = rows.iloc[cut:]
    if held is not None and len(held):
        yield from search(held, percent)


def search_all(percent: int):
    def every_open_pair(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from of_whole_tiles(batches, all_pairs, percent)

    return every_open_pair


def search_closest(percent: int):
    def closest_open_pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from of_whole_tiles(batches, closest_pairs, percent)

    return closest_open_pairs


def within_bound(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a``, ``b`` whose bitmaps leave room for the similarity."""
    side = classes.select("id", "n", "bits")
    both = pairs.join(side.toDF("a", "n_a", "bits_a"), "a").join(side.toDF("b", "n_b", "bits_b"), "b")
    differ = F.expr("aggregate(zip_with(bits_a, bits_b, (x, y) -> bit_count(x ^ y)), 0, (x, y) -> x + y)")
    return (
        both.withColumn("total", F.expr("n_a + n_b"))
        .withColumn("most", (F.col("total") - differ) / 2)
        .filter(f"100 * floor(most) >= {percent} * (total - floor(most))")
        .select("a", "b")
    )


def finer(pairs: DataFrame, fine: DataFrame, percent: int) -> DataFrame:
    side = fine.select("id", "n", "fine")
    both = pairs.join(side.toDF("a", "n_a", "fine_a"), "a").join(side.toDF("b", "n_b", "fine_b"), "b")
    return both.mapInArrow(bound(percent), "a long, b long")


def decided(scratch: Scratch, slim: DataFrame, classes: DataFrame, pairs: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs that link, by intersecting the arrays. Staged: links are used more than once."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    arrays = scratch.stage(of_classes(slim, classes.join(ids, "id", "left_semi"), emit_arrays(n), "id long, array binary", scratch), "ngram-arrays")
    left, right = arrays.toDF("a", "array_a"), arrays.toDF("b", "array_b")
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "array_a", "array_b")
    links = scratch.stage(both.mapInArrow(decide(percent), "a long, b long"), "ngram-links")
    scratch.drop(arrays)
    return links


def relabelled(scratch: Scratch, classes: DataFrame, links: DataFrame) -> DataFrame:
    """``id`` and ``label`` of every class."""
    groups = connected(links, scratch)
    found = classes.select("id").join(groups.withColumnRenamed("node", "id"), "id", "left")
    return scratch.stage(found.select("id", F.coalesce("label", "id").alias("label")), "ngram-labels")


def apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose ends are not yet in one group."""
    both = pairs.join(labels.toDF("a", "label_a"), "a").join(labels.toDF("b", "label_b"), "b")
    return both.filter("label_a <> label_b").select("a", "b")


def tiles(members: DataFrame, sets: DataFrame, labels: DataFrame, search) -> DataFrame:
    """Pairs worth deciding in the tiles that hold sets of different groups, by ``search``. A tile of many sets is cut
    into blocks by size; each two blocks are a task of their own. ``sets``: ``id``, ``n`` and ``bits``, which are sent
    once, to where the pairs are looked for."""
    known = members.join(labels.join(sets.select("id", "n"), "id"), "id")
    mixed_tiles = (
        known.groupBy("key")
        .agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("sets"))
        .filter("low <> high")
        .select("key", "sets")
    )
    order = Window.partitionBy("key").orderBy("n", "id")
    blocks = (
        known.join(mixed_tiles, "key")
        .withColumn("block", F.floor((F.row_number().over(order) - 1) / TILE).cast("int"))
        .withColumn("blocks", F.ceil(F.col("sets") / TILE).cast("int"))
    )
    whole = blocks.withColumn(
        "pair",
        F.explode(
            F.expr(
                "transform(sequence(0, int(blocks - 1)), i -> struct(least(i, block) as low, greatest(i, block) as high))"
            )
        ),
    )
    return (
        whole.select("key", "pair.low", "pair.high", "id", "n", "label", "block")
        .join(sets.select("id", "bits"), "id")
        .repartition("key", "low", "high")
        .sortWithinPartitions("key", "low", "high", "block", "n", "id")
        .mapInPandas(search, "a long, b long")
        .distinct()
    )


def of_classes(slim: DataFrame, classes: DataFrame, make, schema: str, scratch: Scratch) -> DataFrame:
    """What ``make`` makes of one text of each of some classes, known by its id and mark. It is made again where it
    is needed: to keep the arrays of all documents would take more than the texts."""
    wanted = scratch.stage(classes.select("doc", F.col("mark").alias("text_mark")), "ngram-wanted")
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    same = F.expr("id <=> doc and mark = text_mark")
    return slim.join(wanted, same, "left_semi").mapInArrow(make, schema)


def described(docs: DataFrame, text: str, key: str, n: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """The texts with ids and marks, hashes of the texts; and what is known of each row's set, staged."""
    slim = docs.select(
        F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"), F.xxhash64(text).alias("mark")
    )
    rows = slim.mapInArrow(describe(n), "id long, mark long, n long, first long, second long, bits array<long>")
    return slim, scratch.stage(rows, "ngram-rows")


def linked_classes(slim: DataFrame, rows: DataFrame, n: int, percent: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """The classes of equal sets that are not empty, each named by its first hash, with the smallest id it occurs
    under; and the links between them. Staged."""
    best = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "mark"))
    classes = scratch.stage(
        rows.filter("n > 0")
        .groupBy("n", "first", "second")
        .agg(best.alias("best"), F.min("bits").alias("bits"))
        .select(F.col("first").alias("id"), "n", "bits", F.col("best.id").alias("doc"), "best.mark"),
        "ngram-classes",
    )
    # Equal rows would bring a class's text several times.
    twice = rows.filter("n > 0").groupBy("id", "mark").count().filter("count > 1").head(1)
    one = (lambda df: df.dropDuplicates(["id"])) if twice else (lambda df: df)
    # A class states its keys once, however many rows have its set.
    keys = of_classes(slim, classes, emit_keys(n, percent), "key long, first long", scratch)
    keys = keys.distinct() if twice else keys
    order = Window.partitionBy("key").orderBy("first")
    meetings = scratch.stage(
        keys.withColumns({"before": F.lag("first").over(order), "others": F.coalesce(F.lag("first", 2).over(order), F.lead("first").over(order))})
        .filter("before <> first")
        .select("key", F.least("before", "first").alias("a"), F.greatest("before", "first").alias("b"), F.expr("others is not null").alias("crowded")),
        "ngram-meetings",
    )
    counted = scratch.stage(meetings.groupBy("a", "b").agg(F.count("*").alias("times")), "ngram-counted")
    members = meetings.filter("crowded").select("key", F.explode(F.array("a", "b")).alias("id")).distinct()
    members = scratch.stage(members, "ngram-members")
    scratch.drop(meetings)
    met = counted.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    fine = of_classes(slim, classes.join(met, "id", "left_semi"), emit_bitmaps(n), "id long, n long, fine binary, bits array<long>", scratch)
    fine = scratch.stage(one(fine), "ngram-fine")
    room = finer(within_bound(counted.select("a", "b"), classes, percent), fine, percent)
    pairs = scratch.stage(room.join(counted, ["a", "b"]), "ngram-pairs")

    # First every set with the one neighbour it meets most often; then the neighbours that this left
    # apart; then, in tiles that still hold different groups, the closest sets of each; then all sets of
    # tiles that hold different groups even so.
    best = pairs.groupBy("b").agg(F.max_by("a", F.struct("times", "a")).alias("a")).select("a", "b")
    best = scratch.stage(best, "ngram-best")
    links = decided(scratch, slim, classes, best, n, percent)
    labels = relabelled(scratch, classes, links)
    more = apart(pairs.select("a", "b").join(best, ["a", "b"], "left_anti"), labels)
    more = scratch.stage(more, "ngram-more")
    links = links.unionByName(decided(scratch, slim, classes, more, n, percent))
    scratch.drop(labels, pairs, best, more)
    labels = relabelled(scratch, classes, links)
    looked_at = counted.select("a", "b")
    for search, sets in ((search_closest(percent), classes), (search_all(percent), fine)):
        rest = tiles(members, sets, labels, search).join(looked_at, ["a", "b"], "left_anti")
        rest = scratch.stage(finer(rest, fine, percent), "ngram-rest")
        links = links.unionByName(decided(scratch, slim, classes, rest, n, percent))
        scratch.drop(labels)
        labels = relabelled(scratch, classes, links)
        looked_at = looked_at.unionByName(rest)
    scratch.drop(labels, members, fine)
    return classes, links


def near_groups(
    docs: DataFrame, text: str = "text", key: str = "doc_id", n: int = N, percent: int = PERCENT
) -> DataFrame:
    """``id``, ``n_shingles`` and ``component_id`` for every row of ``docs``.

    A row's set: its distinct shingles of ``n`` words; with fewer words all of them as one; empty
    without words or text, and then linked with nothing. Two rows link if their sets' Jaccard
    similarity is ``percent`` hundredths at least. ``component_id`` is the smallest ``key`` that links
    lead to, a row's own included. Rows with one key count as one node, whatever their texts; a null key
    gets a null component. Other columns are not looked at; an empty table gives an empty result.

    Sets are told apart by 64-bit hashes of shingles. No pair, component or set passes the driver.
    """
    scratch = Scratch(docs.sparkSession)
    slim, rows = described(docs, text, key, n, scratch)
    classes, links = linked_classes(slim, rows, n, percent, scratch)
    # Different sets under one key are one node.
    named = rows.filter("n > 0 and id is not null").select("id", "first").distinct()
    shared = named.groupBy("id").agg(F.min("first").alias("a"), F.max("first").alias("b")).filter("a <> b").select("id", "a")
    links = links.unionByName(named.join(shared, "id").select("a", F.col("first").alias("b")))
    labels = relabelled(scratch, classes, links)
    own = classes.select("id", "doc").join(labels, "id")
    smallest = own.groupBy("label").agg(F.min("doc").alias("component"))
    found = own.join(smallest, "label").select(F.col("id").alias("first"), "component")
    result = rows.join(found, ["first"], "left").select(
        "id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id"),
    )
    kept = stage(result, "ngram-groups")
    scratch.drop_all()
    return kept


def surplus_rows(docs: DataFrame, text: str, key: str, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """``id`` and ``mark`` (a hash of the text) of all rows that a group does without: all but those with its smallest
    key. And of the rows that are kept, those whose id and text are there several times. Staged."""
    scratch = Scratch(docs.sparkSession)
    slim, rows = described(docs, text, key, n, scratch)
    classes, links = linked_classes(slim, rows, n, percent, scratch)
    labels = relabelled(scratch, classes, links)
    own = (
        rows.filter("n > 0").groupBy("id", "mark", "first").agg(F.count("*").alias("times")).join(labels.withColumnRenamed("id", "first"), "first")
    )
    best = own.groupBy("label").agg(F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "mark")).alias("best"))
    judged = own.join(best, "label").withColumn("stays", F.expr("id <=> best.id and mark = best.mark"))
    judged = stage(judged.filter("not stays or times > 1").select("id", "mark", "stays"), "ngram-judged")
    scratch.drop_all()
    return judged.filter("not stays").select("id", "mark"), judged.filter("stays").select("id", "mark")


def one_of_each(docs: DataFrame, text: str = "text", key: str = "doc_id", n: int = N, percent: int = PERCENT) -> DataFrame:
    """One row of every group of linked texts: that with the smallest ``key``, null keys last, then by a hash of the
    text; of rows with equal key and text any one. Rows without a word are in no group and all stay. A row is
    judged by its own text, whatever other rows have its key. Only keys and hashes are joined; rows are not
    gathered by group, and not shuffled as long as the keys and hashes of those that go are few enough to be sent to
    all tasks."""
    surplus, repeated = (
        F.broadcast(rows) if rows.count() <= BROADCAST_IDS else rows for rows in surplus_rows(docs, text, key, n, percent)
    )
    marked = docs.withColumns({"__id": F.col(key).cast("long"), "__mark": F.xxhash64(text)})
    same = F.expr("__id <=> id_of and __mark = mark_of")
    kept = marked.join(surplus.toDF("id_of", "mark_of"), same, "left_anti")
    if repeated.head(1):
        again = kept.join(repeated.toDF("id_of", "mark_of"), same, "left_semi").dropDuplicates(["__id", "__mark"])
        kept = kept.join(repeated.toDF("id_of", "mark_of"), same, "left_anti").unionByName(again)
    return kept.select(*docs.columns)
