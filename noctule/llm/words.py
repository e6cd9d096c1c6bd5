"""Words and hashes of Arrow string batches, whole arrays at a time. Used inside tasks.

A batch of texts is one byte array with row offsets. Words, word hashes and hashes of word
windows come from prefix sums over it, so the work per byte and per word is a few numpy
operations. Hashes are polynomials modulo 2^64 over a mixed alphabet; where equal hashes decide a
result, two independent ones are taken together (128 bits).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .frames import drop_held

U64 = np.uint64
# Odd multipliers of the hash polynomials: (bytes of a word, words of a window), twice.
BASES = ((0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93), (0xC2B2AE3D27D4EB4F, 0xA0761D6478BD642F))
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)

# Text bytes handled at once: bounds the working arrays of a task (about 60 bytes per byte).
BLOCK_BYTES = 1 << 19


def space_words() -> np.ndarray:
    """Bytes of words ``[^\\x20\\x09-\\x0D]+``."""
    inside = np.ones(256, bool)
    inside[[0x20, *range(0x09, 0x0E)]] = False
    return inside


def alnum_words() -> np.ndarray:
    """Bytes of words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z were lower-cased."""
    inside = np.zeros(256, bool)
    inside[0x30:0x3A] = inside[0x61:0x7B] = inside[0x80:] = True
    return inside


def lower_ascii() -> np.ndarray:
    """A byte table that lower-cases A-Z."""
    table = np.arange(256, dtype=np.uint8)
    table[0x41:0x5B] += 32
    return table


class Texts(NamedTuple):
    """Bytes of all texts of a block and where each text starts (one more entry than texts)."""

    data: np.ndarray
    starts: np.ndarray


class Words(NamedTuple):
    """First byte and end byte of each word; ``rows`` is the first word of each text, one more entry than texts."""

    first: np.ndarray
    end: np.ndarray
    rows: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.rows)

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.rows) - 1), self.counts)


def texts_of(column: pa.Array) -> Texts:
    """The bytes of a string column; null counts as the empty text."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return Texts(raw[starts[0] : starts[-1]], starts - starts[0])


def blocks(batch: pa.RecordBatch, text: str, limit: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Slices of a batch with at most ``limit`` bytes of text each, one row at least."""
    drop_held()
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(starts, starts[at] + limit, "right")) - 1)
        part = batch.slice(at, to - at)
        yield part, texts_of(part.column(text))
        at = to


def split_words(texts: Texts, inside: np.ndarray) -> Words:
    """Maximal runs of ``inside`` bytes; no word spans two texts."""
    data, starts = texts
    hit = inside[data]
    begin, last = hit.copy(), hit.copy()
    begin[1:] &= ~hit[:-1]
    last[:-1] &= ~hit[1:]
    filled = starts[:-1] < starts[1:]
    at, to = starts[:-1][filled], starts[1:][filled] - 1
    begin[at], last[to] = hit[at], hit[to]
    first = np.flatnonzero(begin)
    return Words(first, np.flatnonzero(last) + 1, np.searchsorted(first, starts))


@lru_cache(maxsize=8)
def _powers(base: int, size: int) -> np.ndarray:
    step = np.full(size, base, U64)
    step[0] = 1
    return np.multiply.accumulate(step)


def powers(base: int, n: int) -> np.ndarray:
    """``base ** 0..n`` modulo 2^64; sizes are rounded up so that few tables are kept."""
    return _powers(base, 1 << max(12, int(n).bit_length()))[: n + 1]


def inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits in which every bit depends on every other."""
    h = (h ^ (h >> U64(30))) * U64(MIX[0])
    h = (h ^ (h >> U64(27))) * U64(MIX[1])
    return h ^ (h >> U64(31))


def prefix_sums(values: np.ndarray, base: int) -> np.ndarray:
    out = np.zeros(len(values) + 1, U64)
    np.cumsum(values * powers(base, len(values))[:-1], out=out[1:])
    return out


def span_hashes(sums: np.ndarray, first: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Hash of the values first..end-1, the same wherever they stand."""
    back = powers(inverse(base), len(sums))
    return mix((sums[end] - sums[first]) * back[first])


def byte_sums(data: np.ndarray, which: int = 0) -> np.ndarray:
    return prefix_sums(data.astype(U64) + U64(257), BASES[which][0])


def word_hashes(data: np.ndarray, words: Words, which: int = 0) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    return span_hashes(byte_sums(data, which), words.first, words.end, BASES[which][0])


def window_hashes(hashes: np.ndarray, first: np.ndarray, n: int, which: int = 0) -> np.ndarray:
    """Hash of the ``n`` words from each of ``first`` on."""
    base = BASES[which][1]
    return span_hashes(prefix_sums(hashes, base), first, first + n, base)


def window_starts(words: Words, n: int) -> np.ndarray:
    """First words of all windows of ``n`` words within one text."""
    room = np.repeat(words.rows[1:], words.counts) - np.arange(words.rows[-1])
    return np.flatnonzero(room >= n)


def covered(length: int, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which of ``length`` places lie in any of the spans first..end-1."""
    change = np.zeros(length + 1, np.int64)
    np.add.at(change, first, 1)
    np.add.at(change, end, -1)
    return np.cumsum(change[:-1]) > 0


def signed(h: np.ndarray) -> np.ndarray:
    """The same bits as Spark's BIGINT."""
    return h.view(np.int64)
