"""Language-model scores from a log-frequency Bloom filter of n-gram counts.

Counts of words and word pairs of the training documents are quantised to levels (level q:
2**(q-1) to 2**q - 1 occurrences); an n-gram of level q is inserted with 1, 2, .. q. The
filter has a fixed number of bits for each token and is cut into segments by n-gram hash,
each filled by one task. Inside its segment an n-gram is known by the next 32 bits of its
hash; a segment holds at most MAX_SEGMENT / 6 n-grams, so few share them at any size. A count
is read back by probing level after level until one is missing. It may come out too high,
never too low.

Scoring leaves the filter where it is, whatever its size: the distinct n-grams of each run of
documents are sent to their segments, sorted, as one row for each segment; their levels (a
byte each) meet the run, which is sent there directly, and its documents are scored.
``fit`` gathers a filter of at most MAX_FILTER_BITS.

The base score needs exact word counts. Words of at least 1 / HOT_WORDS of all tokens, of
which there are at most HOT_WORDS, are broadcast; the rest are joined, one row for each
distinct word of a document, so no key has more than a bounded share of the rows.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernels as K
from .common import partitions, staged, table

#: Filter bits for each training token at every size (the number of insertions is at most
#: that of tokens for pairs, and less for words), and the largest filter that is gathered
#: (64 MB, 45 million tokens).
BITS_PER_TOKEN = 12
MAX_FILTER_BITS = 1 << 29
#: There are 2**SEGMENT_BITS segments, and more if one would exceed MAX_SEGMENT bits.
SEGMENT_BITS = 12
MAX_SEGMENT = 1 << 23
PROBES = 4
HOT_WORDS = 1 << 20
FLUSH = 1 << 21
#: Tokens of the documents whose n-grams are sent to the segments together.
RUN = 1 << 21
_SEED = 701
_END, _BEGIN = (np.uint64(x) for x in (0x5851F42D4C957F2D, 0x14057B7EF767814F))


def held_out(doc_id: Column) -> Column:
    """Documents that nothing is learned from; one without id is a training document."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(7)) == 2, F.lit(False))


def tokens_of(block: K.Block) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all documents' words, an end after each document, and their offsets."""
    words = K.find_words(block)
    hashes = K.hash_words(block.data, words, K.byte_codes(_SEED, True))
    offsets = words.offsets + np.arange(len(words.offsets))
    out = np.empty(offsets[-1], K.U64)
    is_end = np.zeros(len(out), bool)
    is_end[offsets[1:] - 1] = True
    out[~is_end] = hashes
    out[is_end] = _END
    return out, offsets


def pair_hashes(tokens: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each token's history (the token before it, or a beginning) and their pair's hash."""
    history = np.empty_like(tokens)
    history[1:] = tokens[:-1]
    history[offsets[:-1][np.diff(offsets) > 0]] = _BEGIN
    return history, K.mix(history * K.U64(3) + tokens * K.U64(5) + K.U64(77))


def _summed(hashes: Iterator[np.ndarray]):
    """(hashes, counts) summed up inside the task as far as FLUSH hashes go."""
    held, size = [], 0
    for found in hashes:
        held.append(found)
        size += len(found)
        if size >= FLUSH:
            yield np.unique(np.concatenate(held), return_counts=True)
            held, size = [], 0
    if size:
        yield np.unique(np.concatenate(held), return_counts=True)


def _words(batches: Iterator[pa.RecordBatch]):
    for values, n in _summed(tokens_of(b)[0] for b in K.text_blocks(batches, "text")):
        yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(n)],
                                         names=["hash", "n"])


def _cuts(hashes: np.ndarray, segment_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Segments of sorted hashes and where each begins."""
    segments = (hashes >> K.U64(64 - segment_bits)).astype(np.int32)
    first = np.flatnonzero(np.concatenate([[True], segments[1:] != segments[:-1]]))
    return segments[first], first


def _short(hashes: np.ndarray, segment_bits: int) -> np.ndarray:
    """What an n-gram is known by inside its segment."""
    return ((hashes << K.U64(segment_bits)) >> K.U64(32)).astype(np.uint32)


def _planes(values: np.ndarray) -> bytes:
    """The lowest bytes of all numbers, then the next ones: small numbers compress well."""
    kind = values.dtype.newbyteorder("<")
    return np.ascontiguousarray(values.astype(kind).view(np.uint8)
                                .reshape(len(values), kind.itemsize).T).tobytes()


def _of_planes(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T) \
        .view(np.dtype(kind).newbyteorder("<"))[:, 0].astype(kind)


def _steps(shorts: np.ndarray) -> bytes:
    """Ascending numbers by their distances."""
    return _planes(np.diff(shorts, prepend=np.uint32(0)))


def _of_steps(data: bytes) -> np.ndarray:
    return np.cumsum(_of_planes(data, np.uint32), dtype=np.uint32)


def _packed(hashes: np.ndarray, counts: np.ndarray, segment_bits: int) -> pa.RecordBatch:
    """Sorted hashes and their counts, one row for each segment."""
    segments, first = _cuts(hashes, segment_bits)
    return pa.RecordBatch.from_arrays(
        [pa.array(segments),
         K.binary_list([_steps(x) for x in np.split(_short(hashes, segment_bits), first[1:])]),
         K.binary_list([_planes(x) for x in np.split(counts.astype(np.int64), first[1:])])],
        names=["segment", "data", "counts"])


def _pairs(batches: Iterator[pa.RecordBatch], segment_bits: int):
    for values, n in _summed(pair_hashes(*tokens_of(b))[1]
                             for b in K.text_blocks(batches, "text")):
        yield _packed(values, n, segment_bits)


def _counted_words(batches: Iterator[pa.RecordBatch], segment_bits: int):
    """Words with their counts, packed as far as FLUSH words go."""
    held, size = [], 0

    def packed():
        hashes, n = (np.concatenate([x[i] for x in held]) for i in (0, 1))
        order = np.argsort(hashes)
        return _packed(hashes[order], n[order], segment_bits)

    for batch in batches:
        held.append((np.asarray(batch.column("hash")).view(K.U64), np.asarray(batch.column("n"))))
        size += len(batch)
        if size >= FLUSH:
            yield packed()
            held, size = [], 0
    if size:
        yield packed()


def levels_of(counts: np.ndarray) -> np.ndarray:
    return np.frexp(counts.astype(np.float64))[1]


def count_of(levels: np.ndarray) -> np.ndarray:
    """The count that a level stands for."""
    return np.where(levels > 1, np.ldexp(4 / 3, levels - 1), levels)


def _places(shorts: np.ndarray, level: int, probe: int, segment_size: int) -> np.ndarray:
    return (K.mix(shorts + K.U64((level * 64 + probe + 1) * 0x9FB21C651E98DF25 % 2**64))
            >> K.U64(32)) % K.U64(segment_size)


def _filled(batches: Iterator[pa.RecordBatch], segment_size: int):
    """Segments of the filter from packed rows sorted by segment; a segment also tells how
    many n-grams it holds, how many of them occurred once, and all occurrences."""
    current, held = -1, []

    def finished():
        shorts = np.concatenate([_of_steps(x) for x, _ in held])
        shorts, which = np.unique(shorts, return_inverse=True)
        counts = np.bincount(which, np.concatenate([_of_planes(x, np.int64)
                                                    for _, x in held])).astype(np.int64)
        shorts, levels = shorts.astype(K.U64), levels_of(counts)
        bits = np.zeros(segment_size, bool)
        for q in range(1, int(levels.max(initial=0)) + 1):
            some = shorts[levels >= q]
            for p in range(PROBES):
                bits[_places(some, q, p, segment_size).astype(np.int64)] = True
        stats = (len(counts), (counts == 1).sum(), counts.sum())
        return pa.RecordBatch.from_arrays(
            [pa.array([current], pa.int32()), K.binary_list([np.packbits(bits).tobytes()]),
             *(pa.array([int(x)], pa.int64()) for x in stats)],
            names=["segment", "bits", "ngrams", "singles", "total"])

    for batch in batches:
        for segment, data, counts in zip(*(batch.column(c).to_pylist() for c in
                                           ("segment", "data", "counts")), strict=True):
            if segment != current:
                if held:
                    yield finished()
                current, held = segment, []
            held.append((data, counts))
    if held:
        yield finished()


def _levels(shorts: np.ndarray, base: np.ndarray | int, table: np.ndarray,
            segment_size: int) -> np.ndarray:
    """Levels by repeated membership probes in packed ``table``, whose segments begin at bit
    ``base``; each goes on until one is missing."""
    shorts = shorts.astype(K.U64)
    out = np.zeros(len(shorts), np.int64)
    alive, level = np.arange(len(shorts)), 0
    base = np.broadcast_to(base, len(shorts))
    while len(alive):
        level += 1
        for p in range(PROBES):
            at = base[alive] + _places(shorts[alive], level, p, segment_size).astype(np.int64)
            alive = alive[table[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1 == 1]
        out[alive] = level
        if level > 63:
            break
    return out


class Model:
    """What scoring needs; ``parts`` are plain values that can be broadcast. ``bits`` is
    None if the filter is too large for that."""

    def __init__(self, tokens: int, words: int, documents: int, bits: bytes | None,
                 segment_bits: int, segment_size: int, weight: float, hot: np.ndarray,
                 hot_counts: np.ndarray):
        self.parts = (tokens, words, documents, bits, segment_bits, segment_size, weight, hot,
                      hot_counts)
        self.tokens, self.words, self.documents, self.bits = tokens, words, documents, bits
        self.segment_bits, self.segment_size, self.weight, self.hot, self.hot_counts = \
            segment_bits, segment_size, weight, hot, hot_counts
        self.table = None if bits is None else np.frombuffer(bits, np.uint8)

    def levels(self, hashes: np.ndarray) -> np.ndarray:
        base = (hashes >> K.U64(64 - self.segment_bits)).astype(np.int64) * self.segment_size
        return _levels(_short(hashes, self.segment_bits), base, self.table, self.segment_size)


def _layout(tokens: int) -> tuple[int, int]:
    """Segments (as a power of two) and bits of each, for so many tokens."""
    wanted = max(1 << 18, tokens * BITS_PER_TOKEN)
    segment_bits = max(SEGMENT_BITS, math.ceil(math.log2(wanted / MAX_SEGMENT)))
    return segment_bits, max(64, (wanted >> segment_bits) // 8 * 8)


def _fit(docs: DataFrame, gather: bool) -> tuple[Model, DataFrame, DataFrame]:
    """The model of (text) rows, the table of exact word counts (hash, n), and that of the
    filter's segments (segment, bits). The model gets the bits only if they are gathered."""
    spark = docs.sparkSession
    words = staged(docs.mapInArrow(_words, "hash long, n long")
                   .groupBy("hash").agg(F.sum("n").alias("n")), "vocabulary")
    tokens, types = words.agg(F.sum("n"), F.count(F.lit(1))).first()
    tokens = tokens or 0
    documents = (words.filter(F.col("hash") == int(_END.view(np.int64)))
                 .agg(F.sum("n")).first()[0]) or 0
    segment_bits, segment_size = _layout(tokens)
    size = segment_size << segment_bits
    packed = "segment int, data binary, counts binary"
    counted = docs.mapInArrow(lambda b: _pairs(b, segment_bits), packed).unionByName(
        words.mapInArrow(lambda b: _counted_words(b, segment_bits), packed))
    filled = staged(counted.repartition(partitions(spark), "segment")
                    .sortWithinPartitions("segment")
                    .mapInArrow(lambda b: _filled(b, segment_size),
                                "segment int, bits binary, ngrams long, singles long, "
                                "total long"), "filter")
    singles, total = filled.agg(F.sum("singles"), F.sum("total")).first()
    bits = None
    if gather and size <= MAX_FILTER_BITS:
        bits = np.zeros(size // 8, np.uint8)
        for batch in filled.select("segment", "bits").toArrow().to_batches(1024):
            for s, part in zip(batch.column("segment").to_pylist(), batch.column("bits"),
                               strict=True):
                bits[s * segment_size // 8:(s + 1) * segment_size // 8] = \
                    np.frombuffer(part.as_buffer(), np.uint8)
    # Good-Turing: the share of occurrences that were seen before
    weight = min(0.99, max(0.01, 1 - (singles or 0) / max(total or 0, 1)))
    hot = words.filter(F.col("n") * HOT_WORDS >= tokens).toArrow()  # at most HOT_WORDS rows
    hashes = np.asarray(hot.column("hash")).view(K.U64)
    order = np.argsort(hashes)
    model = Model(tokens, types, documents, None if bits is None else bits.tobytes(),
                  segment_bits, segment_size, weight, hashes[order],
                  np.asarray(hot.column("n"))[order])
    return model, words, filled.select("segment", "bits")


def fit(docs: DataFrame) -> tuple[Model, DataFrame]:
    """The model of (text) rows, and the table of exact word counts (hash, n)."""
    return _fit(docs, True)[:2]


def _look_up(words: np.ndarray, model: Model) -> np.ndarray:
    """Counts of the hot words, 0 for others."""
    if not len(model.hot):
        return np.zeros(len(words), np.int64)
    at = np.minimum(np.searchsorted(model.hot, words), len(model.hot) - 1)
    return np.where(model.hot[at] == words, model.hot_counts[at], 0)


_ROWS = ("row long, doc_id long, held_out boolean, n_tokens long, hash long, tf long, "
         "known long, base double, score double")


def _scored(row: int, ids: pa.Array, held: pa.Array, kinds: np.ndarray, which: np.ndarray,
            offsets: np.ndarray, levels: Callable[[np.ndarray], np.ndarray], model: Model):
    """Rows of documents numbered from ``row``, whose tokens are kinds[which]."""
    uniform = model.tokens + model.words + 1
    tokens = kinds[which]
    doc, n = K.doc_of(offsets), len(offsets) - 1
    hot = _look_up(kinds, model)
    base = np.bincount(doc, np.log10(hot + 1.0)[which], minlength=n)
    known = np.bincount(doc, (hot > 0)[which], minlength=n).astype(np.int64)
    count = count_of(levels(kinds))[which]
    before = np.empty(len(tokens))
    before[1:] = count[:-1]
    before[offsets[:-1]] = model.documents
    _, pairs = pair_hashes(tokens, offsets)
    both = count_of(levels(pairs))
    seen = np.minimum(both, before) / np.maximum(before, 1)
    p = model.weight * seen + (1 - model.weight) * (count + 1) / uniform
    p = np.where(before > 0, p, (count + 1) / uniform)
    score = np.bincount(doc, np.log10(p), minlength=n)
    rare = (hot == 0)[which]
    at, keys, tf = _distinct(doc[rare], which[rare])
    keys = kinds[keys]
    rows = row + np.arange(n)
    m = len(at)
    nothing = pa.nulls(m, pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate([rows, rows[at]])),
         pa.concat_arrays([ids, nothing]),
         pa.concat_arrays([held, pa.nulls(m, pa.bool_())]),
         pa.concat_arrays([pa.array(np.diff(offsets)), nothing]),
         # a document's own row has a key that no word is likely to have
         pa.array(np.concatenate([K.mix(rows.astype(K.U64) + K.U64(_SEED)), keys])
                  .view(np.int64)),
         pa.array(np.concatenate([np.zeros(n, np.int64), tf])),
         pa.array(np.concatenate([known, np.zeros(m, np.int64)])),
         pa.array(np.concatenate([base, np.zeros(m)])),
         pa.array(np.concatenate([score, np.zeros(m)]))],
        names=["row", "doc_id", "held_out", "n_tokens", "hash", "tf", "known", "base",
               "score"])


#: What is sent to the segments: their bits, n-grams of a run, and what the run's n-grams are
#: told by. Rows of the last kind have these places in ``start``.
_BITS, _GRAMS, _TOLD = range(3)
_SENT = "segment int, kind int, run long, start long, data binary"
_READ = "run long, start long, data binary"
_ITSELF, _MARK = -2, -1


def _sorted(hashes: np.ndarray) -> np.ndarray:
    """Distinct hashes in order; one sort takes less time than np.unique's hash table."""
    hashes = np.sort(hashes)
    new = np.ones(len(hashes), bool)
    new[1:] = hashes[1:] != hashes[:-1]
    return hashes[new]


def _grams(kinds: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Distinct n-grams of a run by hash, that is, also by segment."""
    return _sorted(np.concatenate([kinds, pairs]))


def _found(grams: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places of hashes among ``grams``, looked up in order, which is faster."""
    order = np.argsort(wanted)
    out = np.empty(len(wanted), np.int64)
    out[order] = np.searchsorted(grams, wanted[order])
    return out


def _mark(grams: np.ndarray) -> bytes:
    """Tells the n-grams of a run from those of another."""
    return K.mix(grams).sum(dtype=K.U64).tobytes() + len(grams).to_bytes(8, "little")


def _runs(batches: Iterator[pa.RecordBatch]):
    """Runs of documents: number, ids, held-out flags, tokens and their offsets. Reading the
    same partition again gives the same runs."""
    run, held, size = None, [], 0

    def joined():
        ids, flags = (pa.concat_arrays([x[i] for x in held]) for i in (0, 1))
        offsets = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(x[3])
                                                                 for x in held]))])
        return run, ids, flags, np.concatenate([x[2] for x in held]), offsets

    for block in K.text_blocks(batches, "text"):
        if run is None:
            run = block.batch.column("part")[0].as_py() << 40
        held.append((block.batch.column("doc_id"), block.batch.column("held_out"),
                     *tokens_of(block)))
        size += len(held[-1][2])
        if size >= RUN:
            found = joined()
            held, size = [], 0
            yield found
            run += len(found[1])
    if held:
        yield joined()


def _ask(batches: Iterator[pa.RecordBatch], segment_bits: int):
    """One row of n-grams for each segment and run, and one with the run's mark."""
    for run, _, _, tokens, offsets in _runs(batches):
        grams = _grams(_sorted(tokens), pair_hashes(tokens, offsets)[1])
        segments, first = _cuts(grams, segment_bits)
        n = len(first)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(segments,
                                int(K.mix(np.array([run], K.U64))[0]) >> (64 - segment_bits))
                      .astype(np.int32)),
             pa.array([_GRAMS] * n + [_TOLD], pa.int32()), pa.array([run] * (n + 1), pa.int64()),
             pa.array(np.append(first, _MARK).astype(np.int64)),
             K.binary_list([*(_steps(x) for x in
                              np.split(_short(grams, segment_bits), first[1:])), _mark(grams)])],
            names=["segment", "kind", "run", "start", "data"])


def _themselves(batches: Iterator[pa.RecordBatch]):
    """Each run as one row."""
    for run, ids, flags, tokens, offsets in _runs(batches):
        kinds, which = np.unique(tokens, return_inverse=True)
        n = np.bincount(which, minlength=len(kinds))
        order = np.argsort(-n, kind="stable")  # small numbers, which compress well
        number = np.empty(len(kinds), np.uint32)
        number[order] = np.arange(len(kinds))
        itself = zstandard.ZstdCompressor(level=1).compress(pickle.dumps(
            (ids.to_pylist(), flags.to_pylist(), kinds[order], _planes(number[which]),
             offsets), 5))
        yield pa.RecordBatch.from_arrays(
            [pa.array([run], pa.int64()), pa.array([_ITSELF], pa.int64()),
             K.binary_list([itself])], names=["run", "start", "data"])


def _answer(batches: Iterator[pa.RecordBatch], segment_size: int):
    """Levels, as bytes, in place of n-grams, and marks as they are; from rows sorted by
    segment and kind. A segment that nothing was inserted into has no bits."""
    current, table = -1, None
    for batch in batches:
        segments = np.asarray(batch.column("segment"))
        kinds = np.asarray(batch.column("kind"))
        data = batch.column("data")
        out = [None] * len(segments)
        new = np.ones(len(segments), bool)
        new[1:] = (segments[1:] != segments[:-1]) | (kinds[1:] != kinds[:-1])
        cuts = np.flatnonzero(new)
        for a, b in zip(cuts, [*cuts[1:], len(segments)], strict=True):
            if segments[a] != current:
                current, table = segments[a], None
            if kinds[a] == _BITS:
                table = np.frombuffer(data[int(a)].as_py(), np.uint8)
            elif kinds[a] == _TOLD:
                out[a:b] = data.slice(a, b - a).to_pylist()
            else:
                parts = [_of_steps(x) for x in data.slice(a, b - a).to_pylist()]
                shorts = np.concatenate(parts)
                levels = np.zeros(len(shorts), np.int64) if table is None else \
                    _levels(shorts, 0, table, segment_size)
                ends = np.cumsum([len(x) for x in parts])
                out[a:b] = [x.tobytes() for x in np.split(levels.astype(np.uint8), ends[:-1])]
        keep = np.flatnonzero(kinds != _BITS)
        yield pa.RecordBatch.from_arrays(
            [batch.column("run").take(pa.array(keep)), batch.column("start").take(pa.array(keep)),
             K.binary_list([out[i] for i in keep])], names=["run", "start", "data"])


def _score_runs(batches: Iterator[pa.RecordBatch], model: Model):
    """Rows of documents and of their words that are not hot, from runs, their marks and the
    levels of their n-grams sorted by run and start."""
    run, itself, mark, answers = -1, None, None, []

    def scored():
        if itself is None:
            raise RuntimeError("the documents were not the same rows when they were read again")
        ids, flags, kinds, planes, offsets = pickle.loads(
            zstandard.ZstdDecompressor().decompress(itself))
        which = _of_planes(planes, np.uint32)
        grams = _grams(kinds, pair_hashes(kinds[which], offsets)[1])
        read = np.frombuffer(b"".join(answers), np.uint8).astype(np.int64)
        if len(read) != len(grams) or mark != _mark(grams):
            raise RuntimeError(f"{len(read)} levels of {len(grams)} n-grams: the documents "
                               "were not the same rows when they were read again")
        return _scored(run, pa.array(ids, pa.int64()), pa.array(flags, pa.bool_()), kinds, which,
                       offsets, lambda x: read[_found(grams, x)], model)

    for batch in batches:
        for r, start, data in zip(*(batch.column(c).to_pylist()
                                    for c in ("run", "start", "data")), strict=True):
            if r != run:
                if run >= 0:
                    yield scored()
                run, itself, mark, answers = r, None, None, []
            if start == _ITSELF:
                itself = data
            elif start == _MARK:
                mark = data
            else:
                answers.append(data)
    if run >= 0:
        yield scored()


def _sent(own: DataFrame, filled: DataFrame, model: Model) -> DataFrame:
    """Rows of documents and their words, with the filter left in its segments. The values
    that go to all tasks do not grow with the input."""
    n = partitions(own.sparkSession)
    # the number of the partition that is read, whatever else its task's stage reads
    own = own.withColumn("part", F.spark_partition_id())
    segment_bits, segment_size = model.segment_bits, model.segment_size
    nothing = F.lit(0).cast("long")
    bits = filled.select("segment", F.lit(_BITS).cast("int").alias("kind"),
                         nothing.alias("run"), nothing.alias("start"),
                         F.col("bits").alias("data"))
    asked = own.mapInArrow(lambda b: _ask(b, segment_bits), _SENT).unionByName(bits)
    answers = (asked.repartition(n, "segment").sortWithinPartitions("segment", "kind")
               .mapInArrow(lambda b: _answer(b, segment_size),
                           _READ)
               .unionByName(own.mapInArrow(_themselves, _READ)))
    sent = own.sparkSession.sparkContext.broadcast(model.parts)
    return (answers.repartition(n, "run").sortWithinPartitions("run", "start")
            .mapInArrow(lambda b: _score_runs(b, Model(*sent.value)), _ROWS))


def _distinct(doc: np.ndarray, which: np.ndarray):
    """Distinct pairs of a document and a token's number, and how often each occurs."""
    pairs, n = np.unique(doc.astype(np.int64) << 32 | which.astype(np.int64),
                         return_counts=True)
    return pairs >> 32, pairs & 0xFFFFFFFF, n


def score_documents(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the documents that are not held out. A null or empty text is its end token
    alone. Rows that repeat a doc_id are scored one by one; those without one are training
    documents. Without training documents every count is 0. Other columns are not read.
    ``docs`` is read several times and must give the same rows in the same partitions each
    time, as a table does; if it does not, the query fails."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                      held_out(F.col("doc_id")).alias("held_out"),
                      F.col("text").cast("string").alias("text"))
    model, words, filled = _fit(own.filter(~F.col("held_out")).select("text"), False)
    rows = _sent(own, filled, model)
    joined = rows.join(words.withColumnRenamed("hash", "h"), F.col("hash") == F.col("h"), "left")
    n = F.coalesce("n", F.lit(0))
    per = joined.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"),
        F.max("n_tokens").alias("n_tokens"),
        F.sum(F.col("known") + F.when(n > 0, F.col("tf")).otherwise(0)).alias("n_known"),
        F.sum(F.col("base") + F.col("tf") * F.log10(n + 1.0)).alias("logs"),
        F.sum("score").alias("score"))
    share = math.log10(model.tokens + model.words + 1)
    return per.select("doc_id", "held_out", "n_tokens", "n_known",
                      F.lit(model.tokens).cast("long").alias("train_tokens"),
                      (F.col("logs") - F.col("n_tokens") * share).alias("base_score"), "score")


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))
