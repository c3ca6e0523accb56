"""Near-duplicate documents: SuperMinHash signatures, banding, verification, components.

SuperMinHash gives every element one random permutation of the signature's slots and a
rank for each step along it: r + j at step j. A slot keeps the smallest rank. All elements
of a document advance step by step together; a document stops once each slot has a value,
because later steps only bring larger ones. Equal sets form classes first; only the
classes' representatives are banded. Links are confirmed on the full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernels as K
from .common import id_and_text, staged, table
from .components import components, joined
from .sketches import bit_filter, maybe_held

SHINGLE = 5
#: Linked from this similarity, in hundredths.
PERCENT = 75
#: 28 bands of 4 slots: a pair at the threshold is missed with probability 2e-5.
BANDS, ROWS = 28, 4
#: Slots in all; the bands take the first ones, the estimate of a similarity all of them.
SLOTS = 224
#: Pairs of a lower estimate are not confirmed. A pair at the threshold is estimated so far
#: below it, 4.5 standard deviations, with probability 3e-6.
SLACK = 0.13
#: Members of a bucket that are compared with each other in one task.
BLOCK = 512
_SEED = 101
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_sets(block: K.Block, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each document, and their offsets.

    A document of fewer than n words has its whole word sequence as its only shingle."""
    words = K.find_words(block)
    hashes = K.hash_words(block.data, words, K.byte_codes(_SEED, True))
    counts = words.counts
    per_doc = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    starts = K.ranges(words.offsets[:-1], per_doc)
    out = np.empty(len(starts), K.U64)
    offsets = np.concatenate([[0], np.cumsum(per_doc)])
    long = np.repeat(counts >= n, per_doc)
    out[long] = K.ngrams(hashes, n, _SEED)[starts[long]] if long.any() else 0
    for m in range(1, n):
        short = np.flatnonzero(counts == m)
        if len(short):
            out[offsets[short]] = K.ngrams(hashes, m, _SEED + m)[words.offsets[short]]
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        out[a:b].sort()
    doc = K.doc_of(offsets)
    new = np.ones(len(out), bool)
    new[1:] = (out[1:] != out[:-1]) | (doc[1:] != doc[:-1])
    kept = np.concatenate([[0], np.cumsum(new)])
    return out[new], kept[offsets]


def superminhash(elements: np.ndarray, offsets: np.ndarray, m: int) -> np.ndarray:
    """One row of m slots for each set: the step in the top bits, the random rank below."""
    sets = len(offsets) - 1
    slots = np.full(sets * m, _EMPTY, K.U64)
    doc = K.doc_of(offsets)
    step_bits = K.U64(64 - max(1, (m - 1).bit_length()))
    places = None  # each active element's permutation so far
    for j in range(m):
        if not len(elements):
            break
        drawn = K.mix(elements + K.U64((2 * j + 1) * 0xA24BAED4963EE407 % 2**64))
        pick = j + ((drawn >> K.U64(32)) % K.U64(m - j)).astype(np.int64)
        if places is None:
            slot = pick
        else:
            row = np.arange(len(places))
            slot = places[row, pick].astype(np.int64)
            places[row, pick] = places[:, j]
            places[:, j] = slot
        rank = (K.U64(j) << step_bits) | (K.mix(drawn) >> (K.U64(64) - step_bits))
        np.minimum.at(slots, doc * m + slot, rank)
        open_sets = (slots.reshape(sets, m) == _EMPTY).any(1)
        active = open_sets[doc]
        if places is None and active.any():
            places = np.tile(np.arange(m, dtype=np.uint8 if m <= 256 else np.int32),
                             (int(active.sum()), 1))
            row, first = np.arange(len(places)), pick[active]
            places[row, first] = 0
            places[:, 0] = first
        elif places is not None:
            places = places[active]
        elements, doc = elements[active], doc[active]
    return slots.reshape(sets, m)


def _band_keys(slots: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.zeros((len(slots), bands), K.U64)
    for r in range(rows):
        keys = K.mix(keys + slots[:, r::rows][:, :bands])
    return K.mix(keys + np.arange(bands, dtype=K.U64) * K.U64(0x9E3779B97F4A7C15))


def _set_sums(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit fingerprints of each set."""
    out = []
    for seed in (1, 2):
        sums = np.concatenate([np.zeros(1, K.U64), np.cumsum(K.mix(values * K.U64(2 * seed + 1)
                                                                   + K.U64(seed)))])
        out.append((sums[offsets[1:]] - sums[offsets[:-1]]).view(np.int64))
    return out[0], out[1]


def _signatures(batches: Iterator[pa.RecordBatch], shingle: int, bands: int, rows: int,
                slots: int):
    for block in K.text_blocks(batches, "text"):
        values, offsets = shingle_sets(block, shingle)
        n = np.diff(offsets)
        signed = superminhash(values, offsets, slots)
        keys = _band_keys(signed[:, :bands * rows], bands, rows)
        short = K.mix(signed).astype(np.uint8)  # a byte a slot is enough for an estimate
        f1, f2 = _set_sums(values, offsets)
        lists = pa.ListArray.from_arrays(
            pa.array(np.arange(len(n) + 1, dtype=np.int32) * bands),
            pa.array(keys.ravel().view(np.int64)))
        yield pa.RecordBatch.from_arrays(
            [block.batch.column("doc_id"), pa.array(n.astype(np.int64)), pa.array(f1),
             pa.array(f2), lists, K.binary_list([x.tobytes() for x in short])],
            names=["doc_id", "n_shingles", "f1", "f2", "bands", "sig"])


def _bytes(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), width)


def _estimate(equal: np.ndarray, slots: int) -> np.ndarray:
    """Similarity from the number of equal slot bytes, less those equal by chance."""
    return (equal / slots - 1 / 256) / (1 - 1 / 256)


def _estimated(batches: Iterator[pa.RecordBatch], slots: int, least: float):
    for batch in batches:
        a, b = (_bytes(batch.column(c), slots) for c in ("ga", "gb"))
        similar = _estimate((a == b).sum(1), slots)
        yield pa.RecordBatch.from_arrays(
            [batch.column("rep"), batch.column("centre"), pa.array(similar)],
            names=["rep", "centre", "similar"]).filter(pa.array(similar >= least))


def _likely(rows: pa.Table, slots: int, least: float, percent: int):
    """For each member of one bucket's block pair, the members of other components that it
    is likely linked to; a pair counts only in the first bucket that both are in."""
    key, i, j = (rows.column(c)[0].as_py() for c in ("key", "i", "j"))
    own, rep, n, c = (np.asarray(rows.column(x).combine_chunks()) for x in
                      ("own", "rep", "n", "c"))
    sig = _bytes(rows.column("sig").combine_chunks(), slots)
    bands = rows.column("bands").combine_chunks().flatten().to_numpy().reshape(len(rep), -1)
    left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
    for x in left:
        y = right[(rep[right] > rep[x]) if i == j else (rep[right] != rep[x])]
        y = y[c[y] != c[x]]
        y = y[100 * np.minimum(n[y], n[x]) >= percent * np.maximum(n[y], n[x])]
        if not len(y):
            continue
        y = y[_estimate((sig[y] == sig[x]).sum(1), slots) >= least]
        yield x, y[bands[x][(bands[y] == bands[x]).argmax(1)] == key]


def _likely_members(rows: pa.Table, slots: int, least: float, percent: int) -> pa.Table:
    """The members of a block pair that have a likely link to another component."""
    marked = np.zeros(rows.num_rows, bool)
    for x, y in _likely(rows, slots, least, percent):
        if len(y):
            marked[x] = True
            marked[y] = True
    return rows.select(["key", "rep"]).filter(pa.array(marked))


def _links_across(rows: pa.Table, slots: int, least: float, percent: int) -> pa.Table:
    """Components of a block pair that a confirmed link joins, as few pairs as join them."""
    sets = [np.frombuffer(x.as_buffer(), K.U64) for x in rows.column("shingles")]
    root = {c: c for c in rows.column("c").to_pylist()}
    c = rows.column("c").to_pylist()

    def find(v: int) -> int:
        while root[v] != v:
            root[v] = v = root[root[v]]
        return v

    out = []
    for x, ys in _likely(rows, slots, least, percent):
        for y in ys:
            a, b = find(c[x]), find(c[y])
            if a != b and _linked(sets[x], sets[y], percent):
                root[max(a, b)] = min(a, b)
                out.append((c[x], c[y]))
    return pa.table({"a": pa.array([x for x, _ in out], pa.int64()),
                     "b": pa.array([x for _, x in out], pa.int64())})


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(both) - common)


def _sets(batches: Iterator[pa.RecordBatch], shingle: int, wanted: bytes):
    """Sets of the rows whose hash may be in the filter ``wanted``."""
    rows = (b.filter(pa.array(maybe_held(np.asarray(b.column("hash")).view(K.U64), wanted)))
            for b in batches)
    for block in K.text_blocks(rows, "text"):
        values, offsets = shingle_sets(block, shingle)
        sets = [values[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [block.batch.column("doc_id"), *(pa.array(f) for f in _set_sums(values, offsets)),
             K.binary_list(sets)], names=["doc_id", "f1", "f2", "shingles"])


def _confirm(batches: Iterator[pa.RecordBatch], percent: int):
    for batch in batches:
        linked = [_linked(*(np.frombuffer(s.as_buffer(), K.U64) for s in pair), percent)
                  for pair in zip(batch.column("sa"), batch.column("sb"), strict=True)]
        yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))


def full_sets(reps: DataFrame, docs: DataFrame, classes: DataFrame, shingle: int) -> DataFrame:
    """(rep, shingles): the sorted shingle hashes of the given classes.

    Texts stay where they are read: a filter of the classes' leads tells which of them may be
    wanted, and what it lets through in vain goes in the join of the sets."""
    wanted = staged(reps.distinct().join(classes.select("rep", "lead", "f1", "f2"), "rep"),
                    "wanted")
    leads = docs.sparkSession.sparkContext.broadcast(
        bit_filter(wanted.select(F.xxhash64("lead").alias("hash"))))
    texts = docs.filter(F.col("doc_id").isNotNull()).select(
        "doc_id", "text", F.xxhash64("doc_id").alias("hash"))
    sets = staged(texts.mapInArrow(lambda b: _sets(b, shingle, leads.value),
                                   "doc_id long, f1 long, f2 long, shingles binary"), "sets")
    return staged(sets.join(wanted.withColumnRenamed("lead", "doc_id"), ["doc_id", "f1", "f2"])
                  .dropDuplicates(["rep"]).select("rep", "shingles"), "own-sets")


def confirmed(pairs: DataFrame, docs: DataFrame, classes: DataFrame, shingle: int,
              percent: int) -> DataFrame:
    """The pairs (a, b) that are similar enough, judged on their full sets."""
    sets = full_sets(pairs.select(F.col("a").alias("rep"))
                     .unionByName(pairs.select(F.col("b").alias("rep"))), docs, classes, shingle)
    a = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("sb"))
    return staged(pairs.join(a, "a").join(b, "b").select("a", "b", "sa", "sb")
                  .mapInArrow(lambda x: _confirm(x, percent), "a long, b long"), "confirmed")


def _block_pairs(held: DataFrame, block: int) -> DataFrame:
    """(key, rep, ..) -> a row for each pair of blocks of its bucket that the member's own
    block is in, with the numbers i <= j of the blocks; no block exceeds about ``block``."""
    sizes = staged(held.groupBy("key").agg(F.count(F.lit(1)).alias("size")), "sizes")
    blocks = F.ceil(F.col("size") / F.lit(block)).cast("int")
    placed = held.join(sizes, "key").select(
        *held.columns, blocks.alias("_blocks"),
        F.pmod(F.xxhash64("rep", F.lit(3)), blocks).cast("int").alias("own"))
    return placed.select("*", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
                         .alias("_with")).select(
        *held.columns, "own", F.least("own", "_with").alias("i"),
        F.greatest("own", "_with").alias("j"))


def _across(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """(a, b, ca, cb): the pairs whose ends are not in one component yet, and those of each."""
    ca = found.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    cb = found.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    return staged(pairs.join(ca, "a", "left").join(cb, "b", "left").select(
        "a", "b", F.coalesce("ca", "a").alias("ca"), F.coalesce("cb", "b").alias("cb"))
        .filter(F.col("ca") != F.col("cb")), "across")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT,
                    bands: int = BANDS, rows: int = ROWS, slots: int = SLOTS) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept, class_id (smallest doc_id with
    the same shingle set; null without shingles).

    Null and empty texts, and those without words, have no shingles and stand alone, as do
    rows without a doc_id (component null, kept). Rows that repeat a doc_id are judged by
    their own text, and only links join them.
    An empty table gives no rows. Other columns are not read."""
    own = id_and_text(docs)
    least = percent / 100 - SLACK
    signed = staged(own.mapInArrow(
        lambda b: _signatures(b, shingle, bands, rows, slots),
        "doc_id long, n_shingles long, f1 long, f2 long, bands array<long>, sig binary"),
        "signatures")
    usable = signed.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    # a class of equal sets goes by a name of its set; its lead is its smallest doc_id
    classes = staged(usable.groupBy("f1", "f2", "n_shingles").agg(F.min("doc_id").alias("lead"))
                     .withColumn("rep", F.xxhash64("f1", "f2", "n_shingles")), "classes")
    leads = staged(usable.join(classes.withColumnRenamed("lead", "doc_id"),
                               ["doc_id", "f1", "f2", "n_shingles"])
                   .select("rep", F.col("n_shingles").alias("n"), "bands", "sig")
                   .dropDuplicates(["rep"]), "leads")
    banded = leads.select("rep", "n", F.explode("bands").alias("key"))
    # a bucket's centre is another member in each band, so a member meets several centres
    centres = staged(banded.groupBy("key").agg(
        F.min_by("rep", F.xxhash64("key", "rep")).alias("centre"),
        F.min("rep").alias("lo"), F.max("rep").alias("hi"))
        .filter(F.col("lo") != F.col("hi")).select("key", "centre"), "centres")
    members = staged(banded.join(centres, "key"), "members")
    met = members.filter(F.col("rep") != F.col("centre")).select("rep", "centre").distinct()
    a, b = leads.select("rep", F.col("n"), F.col("sig").alias("ga")), leads.select(
        F.col("rep").alias("centre"), F.col("n").alias("nb"), F.col("sig").alias("gb"))
    fits = 100 * F.least("n", "nb") >= percent * F.greatest("n", "nb")
    met = staged(met.join(a, "rep").join(b, "centre").filter(fits)
                 .mapInArrow(lambda x: _estimated(x, slots, least),
                             "rep long, centre long, similar double"), "met")
    # 1: each member and the centre it is most like
    best = met.groupBy("rep").agg(F.max_by("centre", F.col("similar")).alias("centre"))
    links = confirmed(_ordered(best), own, classes, shingle, percent)
    found = staged(components(links), "components")
    # 2: all centres of other components that it is like
    across = _across(_ordered(met), found)
    links = confirmed(across.select("a", "b"), own, classes, shingle, percent)
    found = staged(joined(found, across.join(links, ["a", "b"], "left_semi")
                          .select(F.col("ca").alias("a"), F.col("cb").alias("b"))), "components")
    # 3: in buckets that still hold several components, blocks of members against blocks
    held = staged(members.select("key", "rep").join(found.withColumnRenamed("node", "rep"),
                                                    "rep", "left")
                  .select("key", "rep", F.coalesce("component", "rep").alias("c")), "held")
    mixed = staged(held.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"))
                   .filter(F.col("lo") != F.col("hi")).select("key"), "mixed")
    held = staged(held.join(mixed, "key"), "mixed-members")
    signs = leads.select("rep", "n", "sig", "bands")
    marked = staged(_block_pairs(held, BLOCK).join(signs, "rep").groupBy("key", "i", "j")
                    .applyInArrow(lambda t: _likely_members(t, slots, least, percent),
                                  "key long, rep long"), "marked").distinct()
    held = staged(held.join(marked, ["key", "rep"], "left_semi"), "marked-members")
    sets = full_sets(held.select("rep"), own, classes, shingle)
    across = _block_pairs(held, BLOCK).join(signs.join(sets, "rep"), "rep") \
        .groupBy("key", "i", "j").applyInArrow(
            lambda t: _links_across(t, slots, least, percent), "a long, b long")
    found = staged(joined(found, staged(across, "across-links")), "components")
    grouped = staged(classes.join(found.withColumnRenamed("node", "rep"), "rep", "left")
                     .select("f1", "f2", F.col("n_shingles").alias("n"), "lead",
                             F.coalesce("component", "rep").alias("group")), "grouped")
    smallest = grouped.groupBy("group").agg(F.min("lead").alias("component"))
    named = staged(grouped.join(smallest, "group").select("f1", "f2", "n", "lead", "component"),
                   "named")
    out = signed.drop("bands", "sig").join(
        named, (signed["f1"] == named["f1"]) & (signed["f2"] == named["f2"])
        & (signed["n_shingles"] == named["n"]), "left")
    alone = F.col("doc_id").isNull()
    return out.select(
        "doc_id", "n_shingles",
        F.when(~alone, F.coalesce("component", "doc_id")).alias("component_id"),
        (alone | (F.col("doc_id") == F.coalesce("component", "doc_id"))).alias("kept"),
        F.when(~alone, F.col("lead")).alias("class_id"))


def _ordered(met: DataFrame) -> DataFrame:
    return met.select(F.least("rep", "centre").alias("a"),
                      F.greatest("rep", "centre").alias("b")).distinct()


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, but for documents that are near-duplicates of one
    with a smaller doc_id in their group."""
    gone = staged(near_duplicates(docs).filter(~F.col("kept"))
                  .select(F.col("doc_id").alias("_gone")).distinct(), "gone")
    return docs.join(gone, docs["doc_id"].cast("long") == gone["_gone"], "left_anti")


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("class_id")


SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i
        FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*)::BIGINT AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT c.a, c.b FROM common c JOIN sizes x ON x.doc_id = c.a JOIN sizes y ON y.doc_id = c.b
  WHERE 100 * c.k >= 75 * (x.n + y.n - c.k)),
reach(doc_id, r) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT p.doc_id, l.b FROM reach p JOIN links l ON p.r = l.a)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, min(p.r) AS component_id,
       min(p.r) = d.doc_id AS kept
FROM documents d JOIN reach p USING (doc_id) LEFT JOIN sizes s USING (doc_id)
GROUP BY d.doc_id, s.n
"""
