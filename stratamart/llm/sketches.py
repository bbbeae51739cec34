"""Fingerprints of documents of any size: every shingle hash below a fixed limit.

A sketch holds the same share of a short and of a long text, so sketches of very unequal texts still tell how
much of one is in the other, and the sketch of several texts together is the union of theirs. A text of which
no hash is below the limit keeps its smallest one, so that only empty texts have empty sketches; in a union it
counts as long as no hash below the limit is there.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratamart.llm.arrow_text import runs
from stratamart.llm.common import stage
from stratamart.llm.ngrams import shingle_sets

SHINGLE = 5
# One of so many hashes is kept; a kept hash is stated by its first 48 bits.
SHARE = 8
BITS = 48
LIMIT = (1 << BITS) // SHARE
# Bytes of text that are hashed at once; rows of a slice of the order, and keys that a task sorts to find slices.
HASHED_BYTES = 1 << 19
SLICE_ROWS = 4_000
SORTED_ROWS = 1_000_000
LAST_KEY = 2**63 - 1


def kept(hashes: np.ndarray) -> np.ndarray:
    """The sketch of sorted distinct numbers of BITS bits."""
    return hashes[: max(int(np.searchsorted(hashes, LIMIT)), 1)]


def sketches(texts: list[str], shingle: int = SHINGLE) -> tuple[list[np.ndarray], list[int]]:
    """Sketch and number of distinct shingles of every text."""
    out, sizes, low = [], [], 0
    while low < len(texts):
        high, held = low, []
        size = 0
        while high < len(texts) and (high == low or size + len(texts[high]) <= HASHED_BYTES):
            size += len(texts[high])
            held.append(texts[high].encode())
            high += 1
        for own in shingle_sets(held, shingle):
            sizes.append(len(own))
            out.append(np.unique(kept(own >> np.uint64(64 - BITS))))
        low = high
    return out, sizes


def encoded(sketch: np.ndarray) -> str:
    """A sketch as text: six bytes a hash, in order, in base 64."""
    return base64.b64encode(sketch.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - BITS // 8 :].tobytes()).decode()


def decoded(fingerprint: str) -> np.ndarray:
    held = np.frombuffer(base64.b64decode(fingerprint), np.uint8).reshape(-1, BITS // 8)
    whole = np.zeros((len(held), 8), np.uint8)
    whole[:, 8 - BITS // 8 :] = held
    return whole.reshape(-1).view(">u8").astype(np.uint64)


def compared(a: np.ndarray, b: np.ndarray) -> tuple[float, float]:
    """The estimated Jaccard similarity of two texts, and how much of the first is in the second. Empty texts are
    alike, and wholly in any other."""
    both = kept(np.union1d(a, b))
    shared = len(np.intersect1d(np.intersect1d(a, b, assume_unique=True), both, assume_unique=True))
    own = np.intersect1d(a, both, assume_unique=True)
    # A text that only has its smallest hash is judged by that one, even beside hashes below the limit.
    inside = shared / len(own) if len(own) else float(not len(a))
    return (shared / len(both) if len(both) else 1.0), inside


def likeness(a: Column, b: Column) -> Column:
    """The estimated Jaccard similarity of the texts of two fingerprints, 0 to 1; null if either is null."""
    return by_pairs(0)(a, b)


def containment(a: Column, b: Column) -> Column:
    """The estimated share of the first text's shingles that the second has, 0 to 1; null if either is null."""
    return by_pairs(1)(a, b)


def by_pairs(which: int):
    @F.pandas_udf("double")
    def of_pairs(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(
            [None if x is None or y is None else compared(decoded(x), decoded(y))[which] for x, y in zip(a, b, strict=True)],
            dtype="float64",
        )

    return of_pairs


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``n_shingles`` (different ones) and ``fingerprint`` of every row's whole text.

    Shingles are runs of ``shingle`` words with A-Z as a-z, all words if there are fewer. Null and empty texts and
    texts of blanks have an empty fingerprint; equal texts have equal ones. Other columns are not looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in runs(batch):
                found, sizes = sketches([t or "" for t in part["text"].to_pylist()], shingle)
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": part["doc_id"], "n_shingles": pa.array(sizes, pa.int64()), "fingerprint": [encoded(s) for s in found]}
                )

    slim = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id long, n_shingles long, fingerprint string")


def merged(prints: DataFrame, group: str, fingerprint: str = "fingerprint") -> DataFrame:
    """``group`` and ``hash``: the sketch of all texts of a group together, a row per hash, so that a group of any
    size is spread out. It is again a sketch: merging sketches of parts gives that of the whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [decoded(f or "") for f in batch["fingerprint"].to_pylist()]
            names = batch["group"].take(pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found])))
            yield pa.RecordBatch.from_pydict({"group": names, "hash": np.concatenate([*found, np.zeros(0, np.uint64)]).astype(np.int64)})

    slim = prints.select(F.col(group).cast("string").alias("group"), F.col(fingerprint).alias("fingerprint"))
    hashes = stage(slim.mapInArrow(run, "group string, hash long").distinct(), "sketch-hashes")
    least = hashes.groupBy("group").agg(F.min("hash").alias("least"))
    same = F.expr("h.group <=> l.group")
    return hashes.alias("h").join(least.alias("l"), same).filter(f"hash < {LIMIT} or hash = least").select("h.group", "hash")


def group_containment(prints: DataFrame, group: str, fingerprint: str = "fingerprint") -> DataFrame:
    """``group``, ``other`` and ``share``: how much of a group's shingles another group has, for all groups that
    share any hash. A hash is met by the groups that have it, not by documents."""
    own = stage(merged(prints, group, fingerprint), "sketch-groups")
    sizes = own.groupBy("group").agg(F.count("*").alias("size"))
    shared = (
        own.alias("a")
        .join(own.alias("b"), F.expr("a.hash = b.hash and not a.group <=> b.group"))
        .groupBy(F.col("a.group").alias("group"), F.col("b.group").alias("other"))
        .agg(F.count("*").alias("shared"))
    )
    return shared.alias("s").join(sizes.alias("n"), F.expr("s.group <=> n.group")).select("s.group", "other", F.expr("shared / size").alias("share"))


def slice_bounds(keys: DataFrame) -> np.ndarray:
    """The first key of each slice of the order: one number for SLICE_ROWS rows passes the driver."""

    def firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            at = np.arange(-seen % SLICE_ROWS, batch.num_rows, SLICE_ROWS)
            seen += batch.num_rows
            yield batch.take(pa.array(at))

    parts = max(1, -(-keys.count() // SORTED_ROWS))
    dealt = keys.repartitionByRange(parts, "key").sortWithinPartitions("key")
    return np.unique(dealt.mapInArrow(firsts, "key long").toArrow()["key"].to_numpy())


def with_next(docs: DataFrame, text: str, key: str) -> DataFrame:
    """All rows in slices of the order by ``key``, each slice ended by a copy of the next one's first row (of the
    very first, for the last): ``doc_id``, ``text``, ``extra``, in order. Every text is shuffled once."""
    slim = docs.select(
        F.col(key).cast("long").alias("doc_id"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col(key).cast("long"), F.lit(LAST_KEY)).alias("key"),
    )
    bounds = slice_bounds(slim.select("key"))

    @F.pandas_udf("array<long>")
    def places(keys: pd.Series) -> pd.Series:
        at = np.searchsorted(bounds, keys.to_numpy(), "right") - 1
        begins = bounds[at] == keys.to_numpy()
        before = (at - 1) % len(bounds)
        return pd.Series([[2 * i, 2 * j + 1] if b else [2 * i] for i, j, b in zip(at.tolist(), before.tolist(), begins, strict=True)])

    return (
        slim.withColumn("place", F.explode(places("key")))
        .select("doc_id", "text", "key", F.expr("place div 2").alias("slice"), F.expr("place % 2 = 1").alias("extra"))
        .repartition("slice")
        .sortWithinPartitions("slice", "extra", "key", F.asc_nulls_last("doc_id"), "text")
        .select("doc_id", "text", "extra")
    )


def edits(rows: pa.RecordBatch, shingle: int) -> pa.RecordBatch:
    """What ``against_next`` states about all but the last of some rows in order."""
    texts, real = rows["text"].to_pylist(), ~rows["extra"].to_numpy(zero_copy_only=False)[:-1]
    own, n_shingles = sketches(texts, shingle)
    at = np.flatnonzero(real)
    changed = []
    for i in at:
        cut = len(texts[i]) // 4
        changed.append(texts[i][: len(texts[i]) - cut] + texts[i + 1][:cut])
    new, _ = sketches(changed, shingle)
    near = np.array([compared(own[i], edited) for i, edited in zip(at, new, strict=True)]).reshape(-1, 2)
    after = np.array([compared(own[i], own[i + 1]) for i in at]).reshape(-1, 2)
    return pa.RecordBatch.from_pydict(
        {
            "doc_id": rows["doc_id"].take(pa.array(at)),
            "n_chars": pa.array([len(texts[i]) for i in at], pa.int64()),
            "n_shingles": pa.array([n_shingles[i] for i in at], pa.int64()),
            "edited_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
            "fingerprint": pa.array([encoded(own[i]) for i in at], pa.string()),
            "edited_fingerprint": pa.array([encoded(s) for s in new], pa.string()),
            "near_edited": near[:, 0],
            "near_next": after[:, 0],
            "in_edited": near[:, 1],
            "in_next": after[:, 1],
        }
    )


FOUND = (
    "doc_id long, n_chars long, n_shingles long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, in_edited double, in_next double"
)


def against_next(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE) -> DataFrame:
    """Every row's fingerprint beside that of its edited text and that of the next row's text.

    The next row is that of the next ``key``, null keys last, equal ones by text; after the last comes the first, so
    a single row follows itself. The edited text has its last quarter of code points replaced by the first as many
    of the next text, or all if it has fewer. ``near_*`` estimate the Jaccard similarity of the texts' shingles,
    ``in_*`` the share of the row's own shingles that the other text has. Null texts are empty; see
    ``fingerprints`` and ``compared``. Repeated rows are rows. An empty table gives no rows. Other columns are not
    looked at. Rows of one key are sorted by one task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            for part in runs(batch):
                rows = part if held is None else pa.concat_batches([held, part])
                yield edits(rows, shingle)
                held = rows.slice(rows.num_rows - 1)

    return with_next(docs, text, key).mapInArrow(run, FOUND)
