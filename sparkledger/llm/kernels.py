"""Vectorised text kernels that run inside Spark tasks (numpy over Arrow buffers).

A *block* is a slice of an Arrow batch with a bounded number of text bytes (a longer
document is a block of its own). Words are found on the UTF-8 bytes of a whole block at
once; they never cross documents. Hashes are 64-bit and depend on content alone.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
BLOCK_BYTES = 1 << 19
PIECE = 1 << 18

#: ``[^\x20\x09-\x0D]``: word bytes of whitespace-separated words.
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` after lower-casing A-Z: ASCII letters, digits, non-ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser, element by element."""
    x = np.asarray(x, U64)
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def stream(seed: int, n: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers of a seed."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed))


_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) mod 2**64; short tables are kept."""
    kept = _POWERS.get(base)
    if kept is None or len(kept) < n:
        size = max(n, 1 << 12)
        steps = np.full(size, base & (2**64 - 1), U64)
        steps[0] = 1
        kept = np.multiply.accumulate(steps)
        if size <= 1 << 21:
            _POWERS[base] = kept
    return kept[:n]


def byte_codes(seed: int, lower: bool) -> np.ndarray:
    """A random 64-bit number for each byte; A-Z share those of a-z if ``lower``."""
    codes = stream(seed, 256)
    if lower:
        codes[65:91] = codes[97:123]
    return codes


class Block(NamedTuple):
    """``data``: the UTF-8 bytes; document d is data[offsets[d]:offsets[d+1]]."""

    batch: pa.RecordBatch
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def text(self, d: int) -> bytes:
        return self.data[self.offsets[d]:self.offsets[d + 1]].tobytes()


def text_block(batch: pa.RecordBatch, column: str) -> Block:
    """The bytes and offsets of a string column; null is the empty text."""
    col = batch.column(column)
    if pa.types.is_large_string(col.type) or pa.types.is_string(col.type):
        pass
    else:
        col = pc.cast(col, pa.string())
    if col.null_count:
        col = pc.fill_null(col, "")
    kind = np.int64 if pa.types.is_large_string(col.type) else np.int32
    _, offs, data = col.buffers()
    if len(col) == 0:
        return Block(batch, np.empty(0, np.uint8), np.zeros(1, np.int64))
    offsets = np.frombuffer(offs, kind)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return Block(batch, raw[offsets[0]:offsets[-1]], offsets - offsets[0])


def text_blocks(batches: Iterable[pa.RecordBatch], column: str,
                limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Blocks of at most ``limit`` text bytes, or of one longer document."""
    for batch in batches:
        whole = text_block(batch, column)
        at, n = 0, len(whole)
        while at < n:
            end = int(np.searchsorted(whole.offsets, whole.offsets[at] + limit, "right")) - 1
            end = min(n, max(at + 1, end))
            lo, hi = whole.offsets[at], whole.offsets[end]
            yield Block(batch.slice(at, end - at), whole.data[lo:hi],
                        whole.offsets[at:end + 1] - lo)
            at = end


class Words(NamedTuple):
    """Byte spans of words; document d has words offsets[d]:offsets[d+1]."""

    start: np.ndarray
    end: np.ndarray
    offsets: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)


def find_words(block: Block, word_bytes: np.ndarray = SPACED) -> Words:
    data, offsets = block.data, block.offsets
    inside = word_bytes[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    starts = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[starts] = inside[starts]
    ends = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    last[ends] = inside[ends]
    start = np.flatnonzero(first)
    return Words(start, np.flatnonzero(last) + 1, np.searchsorted(start, offsets))


def hash_words(data: np.ndarray, words: Words, codes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes, whatever its place."""
    out = np.empty(len(words.start), U64)
    at, n = 0, len(out)
    while at < n:
        lo = words.start[at]
        to = max(at + 1, int(np.searchsorted(words.end, lo + PIECE, "right")))
        hi = words.end[to - 1]
        sums = np.empty(hi - lo + 1, U64)
        sums[0] = 0
        np.cumsum(codes[data[lo:hi]] * powers(_BASE, hi - lo), out=sums[1:])
        s, e = words.start[at:to] - lo, words.end[at:to] - lo
        out[at:to] = (sums[e] - sums[s]) * powers(_INVERSE, hi - lo)[s]
        at = to
    return mix(out + (words.end - words.start).astype(U64) * U64(0xD6E8FEB86659FD93))


def ngrams(hashes: np.ndarray, n: int, seed: int = 11) -> np.ndarray:
    """Hash of each run of ``n`` hashes; one for every start (len - n + 1 of them)."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.empty(0, U64)
    factors = stream(seed, n) | U64(1)
    if n <= 8:
        out = hashes[:m] * factors[0]
        for j in range(1, n):
            out = out + hashes[j:j + m] * factors[j]
        return mix(out)
    out = np.empty(m, U64)
    base = int(factors[0])
    inverse = pow(base, -1, 1 << 64)
    for lo in range(0, m, PIECE):
        hi = min(m, lo + PIECE)
        part = hashes[lo:hi + n - 1]
        sums = np.zeros(len(part) + 1, U64)
        np.cumsum(part * powers(base, len(part)), out=sums[1:])
        out[lo:hi] = (sums[n:] - sums[:-n]) * powers(inverse, hi - lo)
    return mix(out + U64(seed))


def doc_of(offsets: np.ndarray) -> np.ndarray:
    """The document of each element, from element offsets."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def full_starts(offsets: np.ndarray, n: int) -> np.ndarray:
    """Element numbers at which a run of ``n`` elements of one document starts."""
    counts = np.maximum(np.diff(offsets) - n + 1, 0)
    return ranges(offsets[:-1], counts)


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All of starts[i] .. starts[i]+counts[i]-1, one range after the other."""
    total = int(counts.sum())
    if not total:
        return np.empty(0, np.int64)
    before = np.cumsum(counts) - counts
    return np.arange(total, dtype=np.int64) + np.repeat(starts - before, counts)


def covered(size: int, starts: np.ndarray, length) -> np.ndarray:
    """Mask of the places covered by [start, start+length)."""
    steps = np.zeros(size + 1, np.int32)
    np.add.at(steps, starts, 1)
    np.add.at(steps, np.minimum(starts + length, size), -1)
    return np.cumsum(steps[:-1]) > 0


def binary_list(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())
