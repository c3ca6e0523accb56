"""Removal of repeated byte strings by prefix doubling on synchronised positions.

Prefix doubling names the string of length h at every position, then the one of length 2h
by the pair of names at distance h, dropping positions whose name is unique. Here the
positions are anchors: the place of the smallest hash in every SPAN consecutive GRAM-byte
strings. Equal strings have equal anchors, so a repeated string of LENGTH bytes holds only
repeated anchors, and far fewer positions are named. Round r names 2**r consecutive anchors
by a pair of names of round r - 1; uniques are told by merged count sketches (never wrong
about a repeat). The last round is past the threshold and exact:

* all windows of LENGTH bytes that share their first and last anchor form a run. Runs are
  grouped by a 128-bit name of all their bytes; a name that occurs twice settles its run.
* a run whose name is unique, though the part between its anchors is not, is contested: the
  windows of such runs and of all runs with the same inner part are grouped one by one.

Documents get only the places whose names are unique; everything else repeats. So a string
with any number of copies is pre-aggregated where it is read and never meets in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernels as K
from .common import id_and_text, partitions, staged, table
from .sketches import bit_filter, maybe_held, repeated, sketch

LENGTH = 400
GRAM = 32
SPAN = 128
#: Doubling rounds before the exact one: 1 and 2 consecutive anchors.
ROUNDS = 2
#: Places of a span, on average, among which its smallest hash is looked for.
CANDIDATES = 8
#: Rounds in which those between two smaller ones nearby are left out.
PRUNED = 4
#: Rows summed up at once.
FLUSH = 1 << 18
_BASES = (0xD1342543DE82EF95, 0xAF251AF3B0F025B5)
_SEED = 301
_NO_ID = (1 << 63) - 1


class Positions:
    """Anchors of a block and the runs of windows between them.

    Only hashes are made for every place. The smallest of a span is among its places below
    a bound, CANDIDATES of them on average, or anywhere in it if none is below; it changes
    only where such a place leaves the span or enters it. So all the rest is as sparse."""

    def __init__(self, block: K.Block, length: int, gram: int, span: int):
        self.block, self.length, n = block, length, len(block.data)
        size = np.diff(block.offsets)
        own = np.flatnonzero(size >= length)  # the documents that have windows
        self.anchors = self.begins = np.empty(0, np.int64)
        self.runs = (self.anchors,) * 4
        self.kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        if not len(own):
            return
        o, end = block.offsets[:-1][own], block.offsets[1:][own]
        sums, inverse = self._sums(0)
        hashes = sums[gram:] - sums[:-gram]
        hashes *= inverse[:len(hashes)]
        maybe = np.ones(len(hashes), bool) if span <= CANDIDATES \
            else hashes < K.U64((1 << 64) * CANDIDATES // span)
        places = np.flatnonzero(maybe)
        edges = np.concatenate([[-1], places, [len(hashes)]])
        gaps = np.flatnonzero(np.diff(edges) > span)
        if len(gaps):
            maybe[K.ranges(edges[gaps] + 1, edges[gaps + 1] - edges[gaps] - 1)] = True
            places = np.flatnonzero(maybe)
        # the place in the low bits breaks ties to the left
        low = (K.U64(1) << K.U64(max(24, n.bit_length()))) - K.U64(1)
        order = (hashes[places] & ~low) | places.astype(K.U64)
        for _ in range(PRUNED):
            up = order[1:] > order[:-1]
            over = np.zeros(len(order), bool)  # every span over it has a smaller one beside it
            over[1:-1] = up[:-1] & ~up[1:] & (places[2:] - places[:-2] <= span)
            places, order = places[~over], order[~over]
        # where the smallest may change, in the spans of documents that have windows
        at = np.sort(np.concatenate([places + 1, places - span + 1, o]), kind="stable")
        at = at[np.searchsorted(at, o[0]):]
        at = at[at <= end[_owners(o, at)] - span - gram + 1]
        place = (_least(order, np.searchsorted(places, at), np.searchsorted(places, at + span))
                 & low).astype(np.int64)
        new = np.ones(len(at), bool)
        new[1:] = place[1:] != place[:-1]
        #: anchors, and the first of the spans that each is the smallest of
        self.anchors, self.begins = place[new], at[new]
        reach = length - (span + gram - 1)
        doc = _owners(o, self.begins)
        start = np.sort(np.concatenate(
            [self.begins[self.begins <= end[doc] - length],  # a document's first span too
             self.begins[self.begins - reach > o[doc]] - reach]), kind="stable")
        start = start[np.append(True, start[1:] != start[:-1])]
        stop = np.minimum(np.append(start[1:], n), end[_owners(o, start)] - length + 1)
        self.runs = (start, stop - start, np.searchsorted(self.begins, start, "right") - 1,
                       np.searchsorted(self.begins, start + reach, "right") - 1)

    def _sums(self, which: int) -> tuple[np.ndarray, np.ndarray]:
        """Prefix sums of the bytes' codes by the powers of a base; made when first needed."""
        if which not in self.kept:
            base, n = _BASES[which], len(self.block.data)
            terms = K.byte_codes(_SEED, False)[self.block.data]
            terms *= K.powers(base, n)
            sums = np.zeros(n + 1, K.U64)
            np.cumsum(terms, out=sums[1:])
            self.kept[which] = sums, K.powers(pow(base, -1, 1 << 64), n + 1)
        return self.kept[which]

    def name(self, start: np.ndarray, size, which: int = 0) -> np.ndarray:
        s, inverse = self._sums(which)
        return K.mix((s[start + size] - s[start]) * inverse[start]
                     + np.asarray(size).astype(K.U64))


def _owners(begin: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The last of the sorted ``begin`` that each of the sorted ``at`` is not before."""
    cuts = np.concatenate([np.searchsorted(at, begin), [len(at)]])
    return np.repeat(np.arange(len(begin)), np.diff(cuts))


def _least(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The smallest of values[begin[i]:end[i]] for each i, none of them empty."""
    size = end - begin
    out = np.empty(len(begin), values.dtype)
    width, least = 1, values  # least[k] is that of values[k:k+width]
    while True:
        here = np.flatnonzero((size >= width) & (size < 2 * width))
        out[here] = np.minimum(least[begin[here]], least[end[here] - width])
        if not len(size) or 2 * width > size.max():
            return out
        least = np.minimum(least[:-width], least[width:])
        width *= 2


def _rounds(pos: Positions, gram: int, sketches: list[bytes]):
    """Names of the next round, and which anchors are still alive in each finished one."""
    names, alive, step = K.mix(pos.name(pos.anchors, gram) + K.U64(gram)), [], 1
    ok = np.ones(len(names), bool)
    for r, bits in enumerate([*sketches, None]):
        if r:
            gap = pos.anchors[step:] - pos.anchors[:-step]
            new = np.zeros(len(names), K.U64)
            new[:-step] = K.mix(names[:-step] * K.U64(3) + names[step:] * K.U64(5)
                                + gap.astype(K.U64))
            both = np.zeros(len(names), bool)
            both[:-step] = ok[:-step] & ok[step:]
            names, ok = new, both
            step *= 2
        if bits is not None:
            ok = ok & repeated(names, bits)
            alive.append(ok)
    return names, ok, alive


def _names(batches: Iterator[pa.RecordBatch], length: int, gram: int, span: int,
           sketches: list[bytes]):
    for block in K.text_blocks(batches, "text"):
        pos = Positions(block, length, gram, span)
        if len(pos.anchors):
            names, ok, _ = _rounds(pos, gram, sketches)
            yield names[ok]


def _runs(pos: Positions, gram: int, sketches: list[bytes]):
    """Runs of windows that share their first and last anchor, all of whose anchors are
    alive after the doubling rounds: (first window, windows, first anchor, last anchor)."""
    start, count, first, last = pos.runs
    kept = np.ones(len(start), bool)
    for r, ok in enumerate(_rounds(pos, gram, sketches)[2]):
        dead = np.concatenate([[0], np.cumsum(~ok)])
        end = last + 2 - (1 << r)  # one past the last anchor whose name is inside the run
        kept &= (end <= first) | (dead[np.maximum(end, first)] == dead[first])
    return start[kept], count[kept], first[kept], last[kept]


def _inner(pos: Positions, gram: int, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    a = pos.anchors[first]
    return pos.name(a, pos.anchors[last] + gram - a)


class _Counted:
    """Rows summed up inside a task by (h1, h2): number (2 or more as 2) and one place.

    Sorted by h1 alone: equal names that another one parts stay two rows, summed up later."""

    def __init__(self, extra: list[str]):
        self.names = ["h1", "h2", *extra, "doc", "place"]
        self.parts: list[list[np.ndarray]] = []
        self.size = 0

    def add(self, *columns: np.ndarray) -> None:
        self.parts.append(list(columns))
        self.size += len(columns[0])

    def flush(self) -> pa.RecordBatch:
        columns = [np.concatenate(x) for x in zip(*self.parts, strict=True)]
        order = np.argsort(columns[0])
        columns = [c[order] for c in columns]
        h1, h2 = columns[:2]
        first = np.flatnonzero(np.concatenate(
            [[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]))
        n = np.minimum(np.diff(np.append(first, len(h1))), 2).astype(np.int32)
        self.parts, self.size = [], 0
        arrays = [pa.array(c[first].view(np.int64) if c.dtype == K.U64 else c[first])
                  for c in columns]
        return pa.RecordBatch.from_arrays([*arrays, pa.array(n)], names=[*self.names, "n"])


def _run_rows(batches: Iterator[pa.RecordBatch], length: int, gram: int, span: int,
              sketches: list[bytes]):
    held = _Counted(["inner"])
    for block in K.text_blocks(batches, "text"):
        pos = Positions(block, length, gram, span)
        start, count, first, last = _runs(pos, gram, sketches)
        if not len(start):
            continue
        doc = np.searchsorted(block.offsets, start, "right") - 1
        size = count + length - 1
        held.add(pos.name(start, size), pos.name(start, size, 1),
                 _inner(pos, gram, first, last),
                 np.asarray(block.batch.column("doc_id"))[doc], start - block.offsets[doc])
        if held.size >= FLUSH:
            yield held.flush()
    if held.size:
        yield held.flush()


def _window_rows(batches: Iterator[pa.RecordBatch], length: int, gram: int, span: int,
                 sketches: list[bytes], contested: bytes):
    held = _Counted([])
    for block in K.text_blocks(batches, "text"):
        pos = Positions(block, length, gram, span)
        start, count, first, last = _runs(pos, gram, sketches)
        open_runs = maybe_held(_inner(pos, gram, first, last), contested)
        windows = K.ranges(start[open_runs], count[open_runs])
        if not len(windows):
            continue
        doc = np.searchsorted(block.offsets, windows, "right") - 1
        held.add(pos.name(windows, length), pos.name(windows, length, 1),
                 np.asarray(block.batch.column("doc_id"))[doc], windows - block.offsets[doc])
        if held.size >= FLUSH:
            yield held.flush()
    if held.size:
        yield held.flush()


def _removed(batches: Iterator[pa.RecordBatch], length: int, gram: int, span: int,
             sketches: list[bytes], contested: bytes, with_text: bool):
    for block in K.text_blocks(batches, "text"):
        pos = Positions(block, length, gram, span)
        start, count, first, last = _runs(pos, gram, sketches)
        by_window = maybe_held(_inner(pos, gram, first, last), contested)

        def unique_places(column: str, block=block) -> np.ndarray:
            lists = block.batch.column(column)
            sizes = np.asarray(pc.fill_null(pc.list_value_length(lists), 0))
            return np.asarray(lists.flatten()) + np.repeat(block.offsets[:-1], sizes)

        whole = ~by_window & ~np.isin(start, unique_places("runs"))
        windows = K.ranges(start[by_window], count[by_window])
        windows = windows[~np.isin(windows, unique_places("windows"))]
        n = len(block.data)
        steps = np.zeros(n + 1, np.int32)
        np.add.at(steps, start[whole], 1)
        np.add.at(steps, start[whole] + count[whole] + length - 1, -1)
        np.add.at(steps, windows, 1)
        np.add.at(steps, windows + length, -1)
        gone = np.cumsum(steps[:-1]) > 0
        begins = gone.copy()
        begins[1:] &= ~gone[:-1]
        inner = block.offsets[:-1][block.offsets[:-1] < block.offsets[1:]]
        begins[inner] = gone[inner]
        removed = np.concatenate([[0], np.cumsum(gone)])[block.offsets]
        spans = np.concatenate([[0], np.cumsum(begins)])[block.offsets]
        kept = block.data[~gone]
        at = block.offsets - removed
        parts = [kept[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [block.batch.column("id"), pa.array(np.diff(block.offsets)),
             pa.array(np.diff(removed)), pa.array(np.diff(spans)),
             pa.array([hashlib.sha256(p).hexdigest() for p in parts]),
             K.binary_list(parts if with_text else [None] * len(parts))],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def remove_repeated_strings(docs: DataFrame, length: int = LENGTH, gram: int = GRAM,
                            span: int = SPAN, rounds: int = ROUNDS,
                            with_text: bool = False) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if wanted, kept:
    the remaining bytes, concatenated.

    A byte goes if a string of ``length`` bytes over it also starts anywhere else, in the
    same document too. Null and empty texts, and shorter ones, lose nothing. Rows that
    repeat a doc_id are documents of their own whose strings repeat each other; a place
    unique in one of them counts as unique in all. An empty table gives no rows. Other
    columns are not read."""
    assert length >= span + gram - 1
    spark = docs.sparkSession
    sc = spark.sparkContext
    own = id_and_text(docs).select(F.coalesce("doc_id", F.lit(_NO_ID)).alias("doc_id"),
                                   F.col("doc_id").alias("id"), "text")
    sent: list = []
    total = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    for _ in range(rounds):
        done = list(sent)
        # one position in about half a span is an anchor
        sent.append(sc.broadcast(sketch(own.select("text"), lambda b, done=done: _names(
            b, length, gram, span, [x.value for x in done]), 2 * total // span)))

    def sketches() -> list[bytes]:
        return [x.value for x in sent]

    n = partitions(spark)
    named = own.select("doc_id", "text").mapInArrow(
        lambda b: _run_rows(b, length, gram, span, sketches()),
        "h1 long, h2 long, inner long, doc long, place long, n int")
    # one row a name: its number (capped at 2), and its place if it has only one
    runs = staged(named.groupBy("h1", "h2").agg(
        F.sum("n").alias("n"), F.min("inner").alias("inner"), F.min("doc").alias("doc"),
        F.min("place").alias("place")), "runs")
    inner = runs.groupBy("inner").agg(F.sum("n").alias("total"), F.min("n").alias("least"))
    open_inner = staged(inner.filter((F.col("total") > 1) & (F.col("least") == 1))
                        .select("inner"), "contested")
    contested = sc.broadcast(bit_filter(open_inner.select(F.col("inner").alias("hash"))))
    windows = own.select("doc_id", "text").mapInArrow(
        lambda b: _window_rows(b, length, gram, span, sketches(), contested.value),
        "h1 long, h2 long, doc long, place long, n int")
    lone_windows = windows.groupBy("h1", "h2").agg(
        F.sum("n").alias("n"), F.min("doc").alias("doc"), F.min("place").alias("place")) \
        .filter(F.col("n") == 1).select("doc", F.lit(None).cast("long").alias("run"), "place")
    lone_runs = runs.filter(F.col("n") == 1).join(open_inner, "inner", "left_anti") \
        .select("doc", F.col("place").alias("run"), F.lit(None).cast("long").alias("place"))
    lists = staged(lone_runs.unionByName(lone_windows).repartition(n, "doc").groupBy("doc").agg(
        F.collect_list("run").alias("runs"), F.collect_list("place").alias("windows")),
        "unique-places")
    joined = own.join(lists, own["doc_id"] == lists["doc"], "left") \
        .select("id", "text", "runs", "windows")
    return joined.mapInArrow(
        lambda b: _removed(b, length, gram, span, sketches(), contested.value, with_text),
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
        "kept binary")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_strings(table(spark, sf_dir, "documents")).drop("kept")
