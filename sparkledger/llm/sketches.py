"""Count-min sketches of hashes: partial sketches of partitions, merged range by range.

The merged sketch only tells which cells were counted twice or more, and overestimates: a
hash that occurs twice is always reported. It has CELLS_EACH cells for each hash expected, up
to a bound on what is broadcast; beyond that more hashes share a cell, and the exact pass
behind the sketch gets more to do, but loses nothing.

A bit filter tells which hashes of a table are certainly absent, within the same bounds.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .common import partitions

#: DEPTH rows of counters (0, 1, 2 or more), merged in ranges: up to 2**RANGES_BITS of them a
#: row, none of fewer than 2**RANGE_BITS cells.
DEPTH = 2
CELLS_EACH = 16
#: At most 2**MOST_CELL_BITS cells a row: 32 MB of bits in all.
MOST_CELL_BITS = 27
RANGE_BITS = 16
RANGES_BITS = 8
#: Bits of a filter for each hash, and at most 2**MOST_FILTER_BITS (16 MB).
FILTER_EACH = 32
MOST_FILTER_BITS = 27
#: Hashes counted in a task before they are summed up.
FLUSH = 1 << 19

Hashes = Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]]


def cell_bits(expected: int) -> int:
    """Bits of a cell's number, for so many hashes."""
    wanted = math.ceil(math.log2(max(1, CELLS_EACH * expected)))
    return min(MOST_CELL_BITS, max(RANGE_BITS, wanted))


def range_bits(bits: int) -> int:
    return max(RANGE_BITS, bits - RANGES_BITS)


def _cells(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    mask = K.U64((1 << bits) - 1)
    return [((K.mix(hashes + K.U64(r)) if r else hashes) & mask).astype(np.uint32)
            for r in range(DEPTH)]


def _coded(cells: np.ndarray) -> bytes:
    return zlib.compress(np.diff(cells, prepend=np.uint32(0)).astype("<u4").tobytes(), 1)


def _decoded(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(data), "<u4"), dtype=np.int64)


def _summed(seen: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    cells = np.concatenate([c for c, _ in seen])
    order = np.argsort(cells, kind="stable")
    cells = cells[order]
    counts = np.concatenate([n for _, n in seen])[order]
    first = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]]))
    return cells[first], np.minimum(np.add.reduceat(counts, first), 2).astype(np.uint8)


def _partial(hashes: Iterator[np.ndarray], bits: int):
    """A partition's sketch: of each row and range, the cells counted once and more."""
    seen: list[list] = [[] for _ in range(DEPTH)]
    pending = 0
    for found in hashes:
        if not len(found):
            continue
        for r, cells in enumerate(_cells(found, bits)):
            seen[r].append((cells, np.ones(len(cells), np.uint8)))
        pending += len(found)
        if pending >= FLUSH:
            for r in range(DEPTH):
                seen[r] = [_summed(seen[r])]
            pending = 0
    keys, once, more = [], [], []
    for r in range(DEPTH):
        if not seen[r]:
            continue
        cells, counts = _summed(seen[r])
        inner = range_bits(bits)
        ranges = cells >> inner
        cuts = np.flatnonzero(np.concatenate([[True], ranges[1:] != ranges[:-1], [True]]))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            inside = cells[a:b] & np.uint32((1 << inner) - 1)
            keys.append(int(r << (bits - inner) | ranges[a]))
            once.append(_coded(inside[counts[a:b] == 1]))
            more.append(_coded(inside[counts[a:b] > 1]))
    yield pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.int32()), K.binary_list(once), K.binary_list(more)],
        names=["range", "once", "more"])


def _merge(batches: Iterator[pa.RecordBatch], size: int):
    """Ranges with a bit for each cell counted twice or more."""
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        for key, once, more in zip(batch.column("range").to_pylist(),
                                   batch.column("once").to_pylist(),
                                   batch.column("more").to_pylist(), strict=True):
            have = held.setdefault(key, np.zeros(size, np.uint8))
            cells = _decoded(once)
            have[cells] = np.minimum(have[cells] + 1, 2)
            have[_decoded(more)] = 2
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(held), pa.int32()),
         K.binary_list([zlib.compress(np.packbits(h > 1).tobytes(), 1) for h in held.values()])],
        names=["range", "bits"])


def sketch(docs: DataFrame, hashes: Hashes, expected: int) -> bytes:
    """The merged sketch of all hashes, about ``expected`` of them: a bit for each cell."""
    bits = cell_bits(expected)
    size = 1 << (range_bits(bits) - 3)
    parts = docs.mapInArrow(lambda b: _partial(hashes(b), bits),
                            "range int, once binary, more binary")
    merged = parts.repartition(partitions(docs.sparkSession), "range") \
        .mapInArrow(lambda b: _merge(b, 8 * size), "range int, bits binary") \
        .collect()  # bounded: MOST_CELL_BITS
    out = np.zeros(DEPTH << (bits - 3), np.uint8)
    for r in merged:
        out[r["range"] * size:(r["range"] + 1) * size] = \
            np.frombuffer(zlib.decompress(r["bits"]), np.uint8)
    return out.tobytes()


def repeated(hashes: np.ndarray, sketched: bytes) -> np.ndarray:
    """Mask of the hashes whose estimated count is above 1."""
    table = np.frombuffer(sketched, np.uint8)
    bits = (len(table) // DEPTH).bit_length() + 2
    high = np.ones(len(hashes), bool)
    for r, cells in enumerate(_cells(hashes, bits)):
        byte = table[(r << (bits - 3)) + (cells >> 3).astype(np.int64)]
        high &= (byte >> (7 - (cells & 7)).astype(np.uint8)) & 1 == 1
    return high


def _filter_places(hashes: np.ndarray, size: int) -> list[np.ndarray]:
    mask = K.U64((1 << size) - 1)
    return [(hashes >> K.U64(s) & mask).astype(np.int64) for s in (0, 32)]


def _filter_of(batches: Iterator[pa.RecordBatch], size: int):
    """Byte numbers and bits of the filter that this partition's hashes set."""
    for batch in batches:
        hashes = np.asarray(batch.column("hash")).view(K.U64)
        bits = np.unique(np.concatenate(_filter_places(hashes, size)))
        byte, where = np.unique(bits >> 3, return_index=True)
        value = np.bitwise_or.reduceat((1 << (7 - (bits & 7))).astype(np.uint8), where) \
            if len(bits) else np.empty(0, np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array(byte.astype(np.int32)),
                                          pa.array(value.astype(np.int32))],
                                         names=["byte", "bits"])


def bit_filter(hashes: DataFrame) -> bytes:
    """A filter of (hash long) rows, which are staged; ``maybe_held`` reads it."""
    size = min(MOST_FILTER_BITS, max(12, (FILTER_EACH * hashes.count()).bit_length()))
    filled = hashes.mapInArrow(lambda b: _filter_of(b, size), "byte int, bits int") \
        .groupBy("byte").agg(F.bit_or("bits").alias("bits")).toArrow()  # bounded: size
    out = np.zeros(1 << (size - 3), np.uint8)
    out[np.asarray(filled.column("byte"))] = np.asarray(filled.column("bits"))
    return out.tobytes()


def maybe_held(hashes: np.ndarray, bits: bytes) -> np.ndarray:
    """Mask of the hashes that may be in the filter; those left out are not."""
    have = np.frombuffer(bits, np.uint8)
    out = np.ones(len(hashes), bool)
    for b in _filter_places(hashes, len(have).bit_length() + 2):
        out &= have[b >> 3] >> (7 - (b & 7)).astype(np.uint8) & 1 == 1
    return out
