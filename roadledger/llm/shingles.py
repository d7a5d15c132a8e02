"""Word shingles of whole texts, hashed by numpy over Arrow batches (helpers that run inside tasks)."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

WORDS = 5
#: Text bytes worked on at a time; a longer text is worked on alone.
SLICE_BYTES = 2 << 20
# Odd multipliers for the places of a shingle; any fixed odd numbers do.
PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
                  dtype=np.uint64)


def give_back() -> None:
    """Returns freed memory to the system, so that a worker that waits holds no more than it needs."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None
    if trim is not None:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts batches where about ``limit`` bytes of ``column`` are reached; every part has a row.

    Parts are copies: some string functions of Arrow read a slice that doesn't start at 0 wrongly.
    """
    for batch in batches:
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            base = sizes[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(sizes, base + limit, side="right")))
            yield batch if stop - start == batch.num_rows else batch.take(pa.array(np.arange(start, stop)))
            start = stop
        give_back()


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(33))


def word_lists(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words (A-Z lowered, cut at ASCII white space) in order, and how many each text has."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words, owner = lists.flatten(), pc.list_parent_indices(lists).to_numpy()
    full = pc.greater(pc.binary_length(words), 0)
    counts = np.bincount(owner[full.to_numpy(zero_copy_only=False)], minlength=len(texts))
    return words.filter(full), counts


def shingle_sets(words: pa.Array, counts: np.ndarray) -> Iterator[np.ndarray]:
    """For each text its sorted distinct 64-bit shingle hashes.

    A text of fewer than five words has one shingle, its whole sequence; one without words has none.
    """
    coded = words.dictionary_encode()
    known = np.array([xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()], dtype=np.uint64)
    hashed = known[coded.indices.to_numpy()] if len(words) else np.zeros(0, np.uint64)
    reach = len(hashed) - WORDS + 1
    rolled = np.zeros(max(reach, 0), np.uint64)
    for place in range(WORDS if reach > 0 else 0):
        rolled += hashed[place:place + reach] * PLACES[place]
    rolled = mixed(rolled)
    start = 0
    for count in counts.tolist():
        if count >= WORDS:
            yield np.unique(rolled[start:start + count - WORDS + 1])
        elif count:
            yield mixed(np.array([(hashed[start:start + count] * PLACES[:count]).sum()], dtype=np.uint64))
        else:
            yield np.zeros(0, np.uint64)
        start += count
