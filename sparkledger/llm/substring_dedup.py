"""Removal of repeated word windows behind a count-min prefilter.

Pass 1: every partition sketches its windows; the partial sketches are merged range by
range. A window is counted through its anchor: the word run of smallest hash among those
inside it. Equal windows have equal anchors at equal offsets, so an anchor's count is
never below the count of a window that it stands for. The sketch has a fixed size.
Pass 2: only windows estimated to be repeated are grouped, exactly, by a 96-bit hash of
their words; each group's first place is kept. Windows of a wrongly high estimate are
their own first place, so nothing is lost or removed by the sketch.
Pass 3: every document removes its estimated windows but for the first places sent to it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernels as K
from .common import id_and_text, partitions, staged, table
from .sketches import FLUSH, repeated, sketch

WINDOW = 20
#: Words of an anchor; one is chosen among the window - anchor + 1 inside a window.
ANCHOR = 12
_SEED = 811
#: A null doc_id comes after all others.
#: Bytes of a word and the space behind it, in the estimate of a sketch's size.
WORD_BYTES = 6
_NO_ID = (1 << 63) - 1


def anchors(grams: np.ndarray, span: int) -> np.ndarray:
    """Place of the (leftmost) smallest of each ``span`` consecutive grams."""
    n = len(grams) - span + 1
    if n <= 0:
        return np.empty(0, np.int64)
    best, place, width = grams.copy(), np.arange(len(grams)), 1
    while width < span:  # minimum of the next `width` grams, doubled or filled up
        step = min(width, span - width)
        m = len(best) - step
        later = best[step:] < best[:m]
        place = np.where(later, place[step:], place[:m])
        best = np.where(later, best[step:], best[:m])
        width += step
    return place[:n]


def _windows(block: K.Block, window: int, anchor: int):
    """Words, window starts, and for each window the anchor's place and hash."""
    words = K.find_words(block)
    hashes = K.hash_words(block.data, words, K.byte_codes(_SEED, False))
    starts = K.full_starts(words.offsets, window)
    grams = K.ngrams(hashes, anchor, 7)
    # a gram across documents may be smallest only in windows that are not asked for
    place = anchors(grams, window - anchor + 1)[starts] if len(starts) else starts
    return words, hashes, starts, place, grams


def _chosen(batches: Iterator[pa.RecordBatch], window: int, anchor: int):
    """Hashes of the anchors, each place once."""
    for block in K.text_blocks(batches, "text"):
        *_, place, grams = _windows(block, window, anchor)
        yield grams[np.unique(place)]


def _repeated(grams: np.ndarray, place: np.ndarray, bits: bytes) -> np.ndarray:
    """Mask of the windows whose anchor's estimate is above 1."""
    chosen, index = np.unique(place, return_inverse=True)
    return repeated(grams[chosen], bits)[index]


def _grouped(batches: Iterator[pa.RecordBatch], bits: bytes, window: int, anchor: int):
    """(h1, h2, doc, place): the first place that this task has of each estimated window."""
    held: list[list[np.ndarray]] = [[], [], [], []]

    def flush():
        h1, h2, doc, at = (np.concatenate(x) for x in held)
        order = np.lexsort((at, doc, h2, h1))
        h1, h2, doc, at = h1[order], h2[order], doc[order], at[order]
        first = np.concatenate([[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])
        for x in held:
            x.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(h1[first].view(np.int64)), pa.array(h2[first]), pa.array(doc[first]),
             pa.array(at[first])], names=["h1", "h2", "doc", "place"])

    size = 0
    for block in K.text_blocks(batches, "text"):
        words, hashes, starts, place, grams = _windows(block, window, anchor)
        starts = starts[_repeated(grams, place, bits)]
        if not len(starts):
            continue
        doc = K.doc_of(words.offsets)[starts]
        ids = np.asarray(block.batch.column("doc_id"))
        held[0].append(K.ngrams(hashes, window, 21)[starts])
        held[1].append((K.ngrams(hashes, window, 22)[starts] >> K.U64(32))
                       .astype(np.uint32).view(np.int32))
        held[2].append(ids[doc])
        held[3].append((starts - words.offsets[doc]).astype(np.int32))
        size += len(starts)
        if size >= FLUSH:
            yield flush()
            size = 0
    if size:
        yield flush()


def _firsts(batches: Iterator[pa.RecordBatch]):
    """The first row of each run of equal (h1, h2), from sorted rows."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        h1, h2 = (np.asarray(batch.column(c)) for c in ("h1", "h2"))
        new = np.ones(len(h1), bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        new[0] = last != (h1[0], h2[0])
        last = (h1[-1], h2[-1])
        yield batch.select(["doc", "place"]).filter(pa.array(new))


def kept_words(block: K.Block, words: K.Words, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the kept words, each followed by a space, and each document's offsets."""
    size = (words.end - words.start + 1)[kept]
    out = np.append(block.data, np.uint8(0))[K.ranges(words.start[kept], size)]
    ends = np.cumsum(size)
    out[ends - 1] = 0x20
    per_doc = np.concatenate([[0], np.cumsum(kept)])[words.offsets]
    return out, np.concatenate([[0], ends])[per_doc]


def _removed(batches: Iterator[pa.RecordBatch], bits: bytes, window: int, anchor: int,
             with_text: bool):
    for block in K.text_blocks(batches, "text"):
        words, _, starts, place, grams = _windows(block, window, anchor)
        starts = starts[_repeated(grams, place, bits)]
        firsts = block.batch.column("firsts").to_pylist()
        counts = np.array([len(x) if x else 0 for x in firsts])
        if counts.any():
            own = np.concatenate([np.asarray(x, np.int64) for x in firsts if x])
            own += np.repeat(words.offsets[:-1], counts)
            starts = starts[~np.isin(starts, own)]
        gone = K.covered(len(words.start), starts, window)
        out, offsets = kept_words(block, words, ~gone)
        n = len(block)
        texts = [out[offsets[d]:max(offsets[d], offsets[d + 1] - 1)].tobytes() for d in range(n)]
        total = np.concatenate([[0], np.cumsum(gone)])[words.offsets]
        yield pa.RecordBatch.from_arrays(
            [block.batch.column("id"), pa.array(words.counts.astype(np.int64)),
             pa.array(np.diff(total).astype(np.int64)),
             pa.array([hashlib.sha256(t).hexdigest() for t in texts]),
             pa.array(texts, pa.binary()).cast(pa.string()) if with_text
             else pa.nulls(n, pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])


def remove_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR,
                   with_text: bool = False) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256 and, if wanted, kept: the kept
    words joined by one space.

    A word goes if it is in a window of ``window`` words whose words also start earlier
    (smaller doc_id, or earlier in the same document); a null doc_id is later than all
    others. Null and empty texts, and those of fewer words, lose nothing. Rows that repeat a
    doc_id count as one document: a place that is the first in one of them stays in all. An
    empty table gives no rows. Other columns are not read."""
    spark = docs.sparkSession
    own = id_and_text(docs).select(F.coalesce("doc_id", F.lit(_NO_ID)).alias("doc_id"),
                                   F.col("doc_id").alias("id"), "text")
    total = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # one word in about half of those that a window can have its anchor at is an anchor
    expected = 2 * total // (WORD_BYTES * (window - anchor + 1))
    sent = spark.sparkContext.broadcast(
        sketch(own.select("text"), lambda b: _chosen(b, window, anchor), expected))
    grouped = own.select("doc_id", "text").mapInArrow(
        lambda b: _grouped(b, sent.value, window, anchor), "h1 long, h2 int, doc long, place int")
    firsts = grouped.repartition(partitions(spark), "h1") \
        .sortWithinPartitions("h1", "h2", "doc", "place") \
        .mapInArrow(_firsts, "doc long, place int")
    lists = staged(firsts.groupBy("doc").agg(F.collect_list("place").alias("firsts")),
                   "first-places")
    joined = own.join(lists, own["doc_id"] == lists["doc"], "left").select("id", "text", "firsts")
    return joined.mapInArrow(lambda b: _removed(b, sent.value, window, anchor, with_text),
                             "doc_id long, n_words long, n_removed long, kept_sha256 string, "
                             "kept string")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", "kept_sha256")


SQL = r"""
WITH words AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + 19), ' ')) AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM words WHERE len(w) >= 20)),
later AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS k FROM windows)
  WHERE k > 1),
gone AS (
  SELECT DISTINCT doc_id, k FROM (SELECT doc_id, unnest(range(i, i + 20)) AS k FROM later)),
each AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM words),
kept AS (
  SELECT e.doc_id, string_agg(e.word, ' ' ORDER BY e.k) AS t, count(*) AS n
  FROM each e ANTI JOIN gone g ON e.doc_id = g.doc_id AND e.k = g.k GROUP BY e.doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, (len(d.w) - coalesce(k.n, 0))::BIGINT AS n_removed,
       sha256(coalesce(k.t, '')) AS kept_sha256
FROM words d LEFT JOIN kept k USING (doc_id)
"""
