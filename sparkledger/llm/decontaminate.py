"""Benchmark decontamination with training suffix arrays.

Each task builds suffix arrays over blocks of training words (sparse: only suffixes that
start like some benchmark suffix) and binary-searches every benchmark suffix in them, one
word deeper at a time: the interval of suffixes that agree narrows until it is empty (the
longest match ends there) or a whole window is matched. Benchmark items are read in
batches of a bounded size; documents carry what earlier batches found, so no batch needs
a shuffle and the broadcast never grows with the benchmark.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernels as K
from .common import id_and_text, staged, table

WINDOW = 13
#: A document is contaminated from this share of hit words: hits * RATIO >= words.
RATIO = 20
#: Text bytes of one broadcast batch of items (a longer item is a batch of its own).
BATCH_BYTES = 16 << 20
#: Text bytes of the documents of one suffix array.
ARRAY_BYTES = 1 << 20
_SEED = 901


class Suffixes(NamedTuple):
    """Benchmark suffixes to be searched: window i is words[start[i]:start[i]+length[i]]."""

    items: list[str]
    words: np.ndarray
    start: np.ndarray
    length: np.ndarray
    item: np.ndarray
    heads: np.ndarray  # bitmap of hashed first word pairs (or first words, of one-word items)
    bits: int


def benchmark_suffixes(items: list[str], texts: list[str], window: int = WINDOW) -> Suffixes:
    """Windows of ``window`` words of each item; a shorter item is one window."""
    block = K.text_block(pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())}),
                         "text")
    found = K.find_words(block, K.ALNUM)
    words = K.hash_words(block.data, found, K.byte_codes(_SEED, True))
    n = found.counts
    per_item = np.where(n >= window, n - window + 1, np.minimum(n, 1))
    start = K.ranges(found.offsets[:-1], per_item)
    item = np.repeat(np.arange(len(items)), per_item)
    length = np.minimum(n, window)[item]
    bits = max(16, math.ceil(math.log2(max(len(start), 1) * 32)))
    heads = np.zeros(1 << bits, bool)
    heads[(_heads(words, start, length) >> K.U64(64 - bits)).astype(np.int64)] = True
    return Suffixes(items, words, start, length, item, heads, bits)


def _heads(words: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Hash of the first two words, or of the only one."""
    second = np.where(length > 1, words[np.minimum(start + 1, len(words) - 1)], 0) \
        if len(words) else words
    return K.mix(words[start] * K.U64(3) + second) if len(start) else np.empty(0, K.U64)


def search(words: np.ndarray, offsets: np.ndarray, tests: Suffixes):
    """Longest match of every test window in a block's suffix array, and the places of
    whole matches: (longest, test numbers, word positions)."""
    n, m = len(words), len(tests.start)
    longest = np.zeros(m, np.int64)
    none = np.empty(0, np.int64)
    if not n or not m:
        return longest, none, none
    doc = K.doc_of(offsets)
    pair = np.zeros(n, K.U64)
    pair[:-1] = np.where(doc[1:] == doc[:-1], words[1:], 0)
    shift = K.U64(64 - tests.bits)
    likely = tests.heads[(K.mix(words * K.U64(3) + pair) >> shift).astype(np.int64)]
    if (tests.length == 1).any():
        likely |= tests.heads[(K.mix(words * K.U64(3)) >> shift).astype(np.int64)]
    place = np.flatnonzero(likely)
    if not len(place):
        return longest, none, none
    depth = int(tests.length.max())
    room = offsets[doc[place] + 1] - place  # words left in the document
    # one column a word: codes of the block's suffixes, 0 past the document's end
    reach = place[:, None] + np.arange(depth)
    inside = np.arange(depth) < room[:, None]
    symbols, codes = np.unique(words[np.minimum(reach, n - 1)], return_inverse=True)
    codes = np.where(inside, codes.reshape(reach.shape) + 1, 0)
    order = np.lexsort(codes.T[::-1])
    codes, place = codes[order], place[order]  # the sparse suffix array
    rank = np.zeros(len(place), np.int64)  # of the prefix read so far
    at = np.zeros(m, np.int64)  # the same rank, of each test that still matches
    alive, lo, hi = np.arange(m), np.zeros(m, np.int64), np.full(m, len(place))
    size = len(symbols) + 1
    for d in range(depth):
        alive = alive[tests.length[alive] > d]
        if not len(alive):
            break
        word = tests.words[tests.start[alive] + d]
        code = np.minimum(np.searchsorted(symbols, word), len(symbols) - 1)
        known = symbols[code] == word
        alive, code = alive[known], code[known] + 1
        keys = rank * size + codes[:, d]
        wanted = at[alive] * size + code
        lo[alive] = np.searchsorted(keys, wanted, "left")
        hi[alive] = np.searchsorted(keys, wanted, "right")
        alive = alive[lo[alive] < hi[alive]]
        longest[alive] = d + 1
        rank = np.concatenate([[0], np.cumsum(keys[1:] != keys[:-1])])
        at[alive] = rank[lo[alive]]
    whole = np.flatnonzero((longest == tests.length) & (tests.length > 0))
    counts = hi[whole] - lo[whole]
    return longest, np.repeat(whole, counts), place[K.ranges(lo[whole], counts)]


#: What a document carries from batch to batch, in one column of a name of its own.
_MATCH = pa.struct([("item", pa.string()), ("item_word", pa.int64()), ("word", pa.int64()),
                    ("words", pa.int64())])
_STATE = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("hits", pa.binary()),
                    ("items", pa.list_(pa.string())), ("matches", pa.list_(_MATCH))])
_STATE_SQL = ("struct<n_words:long,n_hit:long,hits:binary,items:array<string>,matches:"
              "array<struct<item:string,item_word:long,word:long,words:long>>>")


def maximal_matches(doc: np.ndarray, place: np.ndarray, test: np.ndarray, tests: Suffixes):
    """Whole window hits joined to longest verbatim matches: hits of one item that step
    through document and item together are one match.

    Returns arrays (doc, item number, first word in the item, first place, words)."""
    start, item = tests.start[test], tests.item[test]
    order = np.lexsort((place, place - start, item, doc))
    doc, place, start, item = doc[order], place[order], start[order], item[order]
    if not len(doc):
        return (np.empty(0, np.int64),) * 5
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) \
        | (place[1:] - place[:-1] != 1) | (start[1:] - start[:-1] != 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    begins = np.full(len(tests.items), np.iinfo(np.int64).max)
    np.minimum.at(begins, tests.item, tests.start)
    words = place[last] - place[first] + tests.length[test[order[last]]]
    return doc[first], item[first], start[first] - begins[item[first]], place[first], words


def _match(batches: Iterator[pa.RecordBatch], tests: Suffixes, last: bool, keep_text: bool,
           column: str):
    """Adds to each document the hit words (a bit each), items and longest matches of one
    batch of tests."""
    codes = K.byte_codes(_SEED, True)
    for block in K.text_blocks(batches, "text", ARRAY_BYTES):
        found = K.find_words(block, K.ALNUM)
        words = K.hash_words(block.data, found, codes)
        _, test, place = search(words, found.offsets, tests)
        n = len(block)
        doc = K.doc_of(found.offsets)
        mask = np.zeros(len(words) + 1, np.int32)
        np.add.at(mask, place, 1)
        np.add.at(mask, place + tests.length[test], -1)
        hit = np.cumsum(mask[:-1]) > 0
        matches: dict[int, list[dict]] = {}
        for d, i, item_word, word, size in zip(*(x.tolist() for x in maximal_matches(
                doc[place], place, test, tests)), strict=True):
            matches.setdefault(d, []).append(
                {"item": tests.items[i], "item_word": item_word,
                 "word": word - int(found.offsets[d]), "words": size})
        states = []
        for d, seen in enumerate(block.batch.column(column).to_pylist()):
            own = hit[found.offsets[d]:found.offsets[d + 1]]
            seen = seen or {}
            if seen.get("hits"):
                own = own | np.unpackbits(np.frombuffer(seen["hits"], np.uint8),
                                          count=len(own)).astype(bool)
            got = (seen.get("matches") or []) + matches.get(d, [])
            states.append({
                "n_words": len(own), "n_hit": int(own.sum()),
                "hits": np.packbits(own).tobytes() if own.any() and not last else None,
                "items": sorted({m["item"] for m in got}),
                "matches": sorted(got, key=lambda m: (m["word"], m["item"], m["item_word"],
                                                      m["words"]))})
        new = {column: pa.array(states, _STATE)}
        if last and not keep_text:
            new["text"] = pa.nulls(n, pa.string())
        before = block.batch
        yield pa.RecordBatch.from_arrays(
            [new.get(x, before.column(x)) for x in before.schema.names],
            names=before.schema.names)


def judged(docs: DataFrame, benchmark: DataFrame, window: int, batch_bytes: int,
           keep_text: bool) -> tuple[DataFrame, str]:
    """``docs`` with a column, which it names, that every batch of the benchmark has added
    to (see ``_STATE``)."""
    tests = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                             F.col("text").cast("string").alias("text")) \
        .filter(F.col("text").isNotNull())
    total = tests.agg(F.sum(F.octet_length("text"))).first()[0]
    parts = max(1, math.ceil((total or 0) / batch_bytes))
    column = f"_found_{uuid.uuid4().hex}"
    state = docs.select("*", F.lit(None).cast(_STATE_SQL).alias(column))
    sc = docs.sparkSession.sparkContext
    for part in range(parts):
        rows = tests.filter(F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == part) \
            .distinct().collect()  # bounded: about batch_bytes of text
        sent = sc.broadcast(tuple(benchmark_suffixes([r.item for r in rows],
                                                     [r.text for r in rows], window)))
        last = part == parts - 1

        def match(batches, sent=sent, last=last):
            return _match(batches, Suffixes(*sent.value), last, keep_text, column)

        state = state.mapInArrow(match, state.schema)
        if not last:
            state = staged(state, "benchmark-batch")
    return state, column


def _contaminated(column: str, ratio: int):
    hit, words = F.col(column)["n_hit"], F.col(column)["n_words"]
    return (hit > 0) & (hit * ratio >= words)


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                       ratio: int = RATIO, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, items (matching item ids, sorted as strings),
    matches (the longest verbatim matches of at least a window: item, first word in the
    item, first word in the document, words; by place), longest (words of the longest) and
    contaminated.

    A null text has no words and is never contaminated; an item with null text or without
    words is never matched, one without id counts but is named "". Rows that repeat a
    doc_id are judged one by one, repeated items count once. An empty benchmark matches
    nothing; an empty documents table gives no rows. Other columns are not read."""
    state, column = judged(id_and_text(docs), benchmark, window, batch_bytes, False)
    found = F.col(column)
    return state.select(
        "doc_id", *[found[c].alias(c) for c in ("n_words", "n_hit", "items", "matches")],
        F.coalesce(F.array_max(F.transform(found["matches"], lambda m: m["words"])), F.lit(0))
        .cast("long").alias("longest"), _contaminated(column, ratio).alias("contaminated"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                         ratio: int = RATIO, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """The rows of ``docs``, all columns, that are not contaminated."""
    state, column = judged(docs, benchmark, window, batch_bytes, True)
    return state.filter(~_contaminated(column, ratio)).drop(column)


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(table(spark, sf_dir, "documents"),
                               table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit",
                        F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                        "contaminated")


SQL = r"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(lower_ascii, W) AS w
  FROM (SELECT doc_id, LOWERED AS lower_ascii FROM documents)),
item_words AS (
  SELECT item_id, regexp_extract_all(lower_ascii, W) AS w
  FROM (SELECT item_id, LOWERED AS lower_ascii FROM benchmark)),
windows AS (
  SELECT item_id, list_slice(w, i, i + least(len(w), 13) - 1) AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 11, 2)::BIGINT)) AS i
        FROM item_words WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT len(g) AS n FROM windows),
places AS (
  SELECT doc_id, n, i, list_slice(w, i, i + n - 1) AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM doc_words, lengths WHERE len(w) >= n)),
found AS (
  SELECT DISTINCT p.doc_id, p.i, p.n, v.item_id FROM places p JOIN windows v ON p.g = v.g),
hits AS (
  SELECT doc_id, count(DISTINCT k)::BIGINT AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM found) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*)::BIGINT AS n_items,
         string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(d.w), 0)::BIGINT AS n_words, coalesce(h.n_hit, 0) AS n_hit,
       coalesce(n.n_items, 0) AS n_items, sha256(coalesce(n.ids, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(d.w) AS contaminated
FROM doc_words d LEFT JOIN hits h USING (doc_id) LEFT JOIN named n USING (doc_id)
"""
SQL = SQL.replace("LOWERED", "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
                  "'abcdefghijklmnopqrstuvwxyz')") \
    .replace("W)", r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
