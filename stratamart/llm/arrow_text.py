"""Texts of Arrow batches as words, by Arrow's own kernels."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text that are cut into words at once; a longer text is a run of its own.
RUN_BYTES = 4 << 20


def runs(batch: pa.RecordBatch, text: str = "text", most: int | None = None) -> Iterator[pa.RecordBatch]:
    """Slices of some ``most`` bytes of text (RUN_BYTES if not stated), one row at least."""
    most = RUN_BYTES if most is None else most
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch[text]), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    low, done = 0, 0
    while low < batch.num_rows:
        high = max(low + 1, int(np.searchsorted(ends, done + most, "right")))
        yield batch.slice(low, high - low)
        low, done = high, ends[high - 1]


def words(texts: pa.Array, between: str) -> tuple[pa.Array, np.ndarray]:
    """All words of texts (null: empty) with A-Z as a-z, and the row each one is in. ``between`` matches what
    separates words."""
    lists = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), pattern=between)
    flat, owner = pc.list_flatten(lists), pc.list_parent_indices(lists)
    full = pc.not_equal(pc.binary_length(flat), 0)  # a separator at either end leaves an empty piece
    return flat.filter(full), owner.filter(full).to_numpy()
