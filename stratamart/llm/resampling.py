"""Importance resampling of documents towards a target collection.

Features of a text are runs of words, hashed into buckets. What a bucket is worth is how much more frequent it
is in the target than in the documents; a document's weight is the worth of all of its features, and the
highest weights with seeded Gumbel noise are drawn, which is sampling without replacement by weight.

Buckets come from CRC-32. Distinct features are grouped by length into matrices of bytes, whose checksums are
all updated column by column, and scattered back to where the features stand.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratamart.llm.arrow_text import runs, words
from stratamart.llm.common import stage

BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LONGEST = 1
BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 10
SEED = "2024"
# Bytes of one matrix, and rows of a slice that is ranked by one task.
MATRIX_BYTES = 4 << 20
SLICE_ROWS = 200_000


def checksum_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> np.uint32(1)) ^ np.where(table & np.uint32(1), np.uint32(0xEDB88320), np.uint32(0))
    return table


CHECKSUMS = checksum_table()


def checksums(texts: pa.StringArray) -> np.ndarray:
    """The unsigned CRC-32 of every text's UTF-8 bytes."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset :][: len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    lengths = np.diff(offsets)
    out = np.zeros(len(texts), np.uint32)
    order = np.argsort(lengths, kind="stable")
    for length, begin, n in zip(*np.unique(lengths[order], return_index=True, return_counts=True), strict=True):
        step = max(1, MATRIX_BYTES // max(1, int(length)))
        for low in range(begin, begin + n, step):
            rows = order[low : min(begin + n, low + step)]
            matrix = data[offsets[rows, None] + np.arange(length)]
            crc = np.full(len(rows), 0xFFFFFFFF, np.uint32)
            for column in matrix.T:
                crc = CHECKSUMS[(crc ^ column) & np.uint32(0xFF)] ^ (crc >> np.uint32(8))
            out[rows] = ~crc
    return out


def feature_buckets(texts: pa.Array, longest: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For runs of 1, 2, ... ``longest`` words: the bucket of every run and the row of the text it is in."""
    flat, owner = words(texts, BETWEEN)
    for n in range(1, longest + 1):
        starts = np.flatnonzero(owner[: len(owner) - n + 1] == owner[n - 1 :]) if len(owner) >= n else np.zeros(0, np.int64)
        run = flat.take(pa.array(starts))
        for step in range(1, n):
            run = pc.binary_join_element_wise(run, flat.take(pa.array(starts + step)), " ")
        coded = run.dictionary_encode()
        yield (checksums(coded.dictionary) % np.uint32(buckets)).astype(np.int64)[coded.indices.to_numpy()], owner[starts]


def count_buckets(longest: int, buckets: int):
    """Features per bucket in all texts of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in runs(batch):
                for found, _ in feature_buckets(part["text"], longest, buckets):
                    counts += np.bincount(found, minlength=buckets)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"bucket": held, "n": counts[held]})

    return run


def weigh(longest: int, gains: np.ndarray):
    """Words, features and their summed gains per text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in runs(batch):
                rows = part.num_rows
                n_words, n_features, weight = (np.zeros(rows, np.int64) for _ in range(3))
                for n, (found, owner) in enumerate(feature_buckets(part["text"], longest, len(gains)), 1):
                    counted = np.bincount(owner, minlength=rows)
                    n_words += counted if n == 1 else 0
                    n_features += counted
                    np.add.at(weight, owner, gains[found])
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": part["doc_id"], "n_words": n_words, "n_features": n_features, "weight": weight}
                )

    return run


def bucket_counts(docs: DataFrame, text: str, longest: int, buckets: int) -> DataFrame:
    slim = docs.select(F.col(text).cast("string").alias("text"))
    return slim.mapInArrow(count_buckets(longest, buckets), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, text: str, longest: int, buckets: int) -> np.ndarray:
    """What a feature of each bucket is worth; as many numbers as there are buckets pass the driver."""
    own, wanted = (np.zeros(buckets, np.int64) for _ in range(2))
    for rows, counts in ((docs, own), (target, wanted)):
        for bucket, n in bucket_counts(rows, text, longest, buckets).collect():
            counts[bucket] = n
    s_all, t_all = float(own.sum() + buckets), float(wanted.sum() + buckets)
    return np.array(
        [
            math.floor(1000 * math.log(float(t + 1) * s_all / (float(s + 1) * t_all)))
            for s, t in zip(own.tolist(), wanted.tolist(), strict=True)
        ],
        np.int64,
    )


def noisy(seed: str) -> str:
    """``weight`` and Gumbel noise by the document's id, null being an id of its own."""
    h = f"double(conv(substring(sha2(concat('{seed}:', coalesce(string(doc_id), 'null')), 256), 1, 8), 16, 10))"
    return f"weight + floor(-1000 * ln(-ln(({h} + 0.5D) / 4294967296D)))"


def ranked(scored: DataFrame, percent: int, least_words: int) -> DataFrame:
    """``scored`` with ``rank`` where drawn. Rows are dealt to ranges of the order, which is kept with them; each
    range is ranked by itself, after as many as all earlier ranges hold."""
    able = F.col("n_words") >= least_words
    rows, of = scored.agg(F.count("*"), F.count_if(able)).first()
    order = [F.desc("able"), F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features")]
    dealt = scored.withColumn("able", able).repartitionByRange(max(1, -(-rows // SLICE_ROWS)), *order)
    dealt = stage(dealt.withColumn("slice", F.spark_partition_id()), "resampling-order")
    before = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)  # a row per slice
    offsets = dealt.groupBy("slice").count().select("slice", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("slice").orderBy(*order)) + F.col("before")
    return dealt.join(offsets, "slice").withColumn("place", place).withColumn(
        "rank", F.when(F.col("able") & (F.col("place") <= percent * of // 100), F.col("place"))
    )


def resample(
    docs: DataFrame,
    target: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    longest: int = LONGEST,
    buckets: int = BUCKETS,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: str = SEED,
) -> DataFrame:
    """``doc_id``, ``n_features``, ``weight``, ``score``, ``rank`` for every row of ``docs``; ``rank`` counts the
    ``percent`` hundredths of the rows of ``least_words`` words that have the highest scores, ties to the smaller id,
    and is null for all others.

    Words are runs of a-z (A-Z are lower-cased, nothing else is), 0-9 and anything beyond ASCII. Null texts hold
    none: 0 features, weight 0. A null id is drawn after all others of its score. Repeated rows count and are
    drawn each on its own; rows of one id have the same noise. An empty target or table is counted as such; an
    empty table gives no rows. Other columns are not looked at. Counts and ranks are over all rows.
    """
    gains = bucket_gains(docs, target, text, longest, buckets)
    slim = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    weighed = slim.mapInArrow(weigh(longest, gains), "doc_id long, n_words long, n_features long, weight long")
    scored = stage(weighed.withColumn("score", F.expr(noisy(seed)).cast("long")), "resampling-scores")
    return ranked(scored, percent, least_words).select("doc_id", "n_features", "weight", "score", F.col("rank").cast("long"))
