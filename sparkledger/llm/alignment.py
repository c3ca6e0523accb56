"""Aligning the tokens of two tokenizers over the same bytes.

The byte offsets at which tokens of A and of B end are two sorted lists; an offset in both
cuts the tokens into groups. Merging the lists is partitioned by merge path: binary searches
along diagonals of the merge grid split it into independent pieces of equal work, whatever
the lengths of documents. A piece emits the offsets that both lists share; one that falls on
the border of two pieces, and the groups that pieces leave open, are stitched afterwards.

Links are all pairs of an A and a B token of one group. They stay counted by distinct id
pair of a document; document counts of id pairs are summed over the whole corpus, and each
part of the corpus (a bounded number of text bytes) asks once for each pair that it holds.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernels as K
from .common import id_and_text, staged, table

A_FILE = "byte_bpe_50k.json"
B_FILE = "piece_bpe_32k.model"
#: Token ends merged by one piece.
PIECE_ENDS = 1 << 14
#: Text bytes of a part; a longer document is a part of its own. An empty text counts, too.
PART_BYTES = 1 << 23
ROW_BYTES = 64
#: Pairs of a group that are multiplied out at once; larger groups count distinct ids first.
GROUP_PAIRS = 1 << 10
#: Distinct pairs of a larger group that are made at once.
HELD_PAIRS = 1 << 21
#: Pieces of text whose ids are kept (of each generation), and how many are encoded at once.
KEPT_PIECES = 1 << 17
BATCH_PIECES = 2000
#: Fixed value: how byte-level tokenizers cut text before their merges.
BYTE_LEVEL_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
                      r"|\s+(?!\S)|\s+")


class Cuts(NamedTuple):
    """Group g ends with A token a[g] and B token b[g]."""

    a: np.ndarray
    b: np.ndarray


def diagonals(a: np.ndarray, b: np.ndarray, piece: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the merge of sorted ``a`` and ``b`` stands after 0, piece, 2 * piece, .. and all
    elements: (elements of a, elements of b), equal ones of a first."""
    total = len(a) + len(b)
    d = np.unique(np.append(np.arange(0, total, piece), total))
    low, high = np.maximum(d - len(b), 0), np.minimum(d, len(a))
    while (open_ := low < high).any():
        middle = (low + high) >> 1
        at_a = np.minimum(middle, max(len(a) - 1, 0))
        at_b = np.clip(d - middle - 1, 0, max(len(b) - 1, 0))
        more = open_ & (a[at_a] <= b[at_b])
        low = np.where(more, middle + 1, low)
        high = np.where(open_ & ~more, middle, high)
    return low, d - low


def _shared(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the values in both sorted lists, by one merge."""
    values = np.concatenate([a, b])
    order = np.argsort(values, kind="stable")
    merged = values[order]
    twice = np.flatnonzero(merged[1:] == merged[:-1])
    return order[twice], order[twice + 1] - len(a)


def shared_ends(a: np.ndarray, b: np.ndarray, piece: int = PIECE_ENDS) -> Cuts:
    """The places in ``a`` and ``b`` (strictly rising) of the values that both hold."""
    i, j = diagonals(a, b, piece)
    found_a, found_b = [], []
    for k in range(len(i) - 1):
        at_a, at_b = _shared(a[i[k]:i[k + 1]], b[j[k]:j[k + 1]])
        # a value whose A end is the last of the piece before, stitched here
        if 0 < i[k] and j[k] < j[k + 1] and a[i[k] - 1] == b[j[k]]:
            found_a.append(i[k:k + 1] - 1)
            found_b.append(j[k:k + 1])
        found_a.append(at_a + i[k])
        found_b.append(at_b + j[k])
    none = np.empty(0, np.int64)
    return Cuts(np.concatenate([none, *found_a]), np.concatenate([none, *found_b]))


class Aligned(NamedTuple):
    """Tokens of a block. Document d has A tokens a_offsets[d]:a_offsets[d+1] and groups
    groups[d]:groups[d+1]; group g has A tokens a_first[g] .. a_last[g], so with B."""

    a: np.ndarray
    b: np.ndarray
    a_offsets: np.ndarray
    b_offsets: np.ndarray
    a_first: np.ndarray
    a_last: np.ndarray
    b_first: np.ndarray
    b_last: np.ndarray
    groups: np.ndarray


def align(a_ids: list, b_ids: list, a_sizes: np.ndarray, b_sizes: np.ndarray) -> Aligned:
    """Groups of documents' tokens; ``a_sizes[id]`` is a token's number of bytes. Both lists
    of a document must cover the same number of bytes."""
    none = np.empty(0, np.int64)
    a = np.concatenate([none, *(np.asarray(x, np.int64) for x in a_ids)])
    b = np.concatenate([none, *(np.asarray(x, np.int64) for x in b_ids)])
    a_offsets = np.cumsum([0, *map(len, a_ids)])
    b_offsets = np.cumsum([0, *map(len, b_ids)])
    # documents end to end: the end of each is shared, so that no group leaves its document
    cuts = shared_ends(np.cumsum(a_sizes[a]), np.cumsum(b_sizes[b]))
    before = np.zeros(min(1, len(cuts.a)), np.int64)
    return Aligned(a, b, a_offsets, b_offsets,
                   np.concatenate([before, cuts.a[:-1] + 1]), cuts.a,
                   np.concatenate([before, cuts.b[:-1] + 1]), cuts.b,
                   np.searchsorted(cuts.a, a_offsets))


def group_texts(aligned: Aligned, a_names: np.ndarray, b_names: np.ndarray) -> Iterator[str]:
    """Of each document: its groups as a1,a2|b1;a3|b2,b3 with decimal ids.

    ``a_names[2 * id + 1]`` is the text of an A token that ends its group's part."""
    n_a, n_b = len(aligned.a), len(aligned.b)
    ends_a, ends_b = np.zeros(n_a, np.int64), np.zeros(n_b, np.int64)
    ends_a[aligned.a_last] = 1
    ends_b[aligned.b_last] = 1
    group_a, group_b = np.cumsum(ends_a) - ends_a, np.cumsum(ends_b) - ends_b
    out = np.empty(n_a + n_b, object)
    out[np.arange(n_a) + aligned.b_first[group_a]] = a_names[2 * aligned.a + ends_a]
    out[np.arange(n_b) + aligned.a_last[group_b] + 1] = b_names[2 * aligned.b + ends_b]
    at = aligned.a_offsets + aligned.b_offsets
    for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        yield "".join(out[lo:hi].tolist())[:-1]


def _names(size: int, between: str, last: str) -> np.ndarray:
    out = np.empty(2 * size, object)
    out[0::2] = [f"{i}{between}" for i in range(size)]
    out[1::2] = [f"{i}{last}" for i in range(size)]
    return out


def _counted(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else order
    return keys[first], (np.add.reduceat(counts, first) if len(keys) else counts)


def block_pairs(aligned: Aligned, a_size: int, b_size: int
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct id pairs (a * b_size + b) that each document links, how many links each has,
    and where a document's begin."""
    a0, b0 = aligned.a_first, aligned.b_first
    n_a, n_b = aligned.a_last - a0 + 1, aligned.b_last - b0 + 1
    span = a_size * b_size
    base = K.doc_of(aligned.groups) * span
    size = n_a * n_b
    small = size <= GROUP_PAIRS
    n = size[small]
    of, k = np.repeat(np.flatnonzero(small), n), K.ranges(np.zeros(len(n), np.int64), n)
    keys = base[of] + aligned.a[a0[of] + k // n_b[of]] * b_size + aligned.b[b0[of] + k % n_b[of]]
    keys, counts = _counted(keys, np.ones(len(keys), np.int64))
    for g in np.flatnonzero(~small):
        a, times_a = np.unique(aligned.a[a0[g]:a0[g] + n_a[g]], return_counts=True)
        b, times_b = np.unique(aligned.b[b0[g]:b0[g] + n_b[g]], return_counts=True)
        rows = max(1, HELD_PAIRS // len(b))
        for at in range(0, len(a), rows):
            more = (base[g] + a[at:at + rows, None] * b_size + b).ravel()
            keys, counts = _counted(np.concatenate([keys, more]), np.concatenate(
                [counts, (times_a[at:at + rows, None] * times_b).ravel()]))
    documents = len(aligned.groups) - 1
    return keys % span, counts, np.searchsorted(keys, np.arange(documents + 1) * span)


def rises(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Differences of neighbours; the first of each run offsets[d]:offsets[d+1] as it is."""
    out = np.diff(values, prepend=0)
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    out[first] = values[first]
    return out


def risen(steps: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """What ``rises`` was made from."""
    sums = np.concatenate([[0], np.cumsum(steps)])
    return sums[1:] - np.repeat(sums[offsets[:-1]], np.diff(offsets))


def run_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(values)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def pack(numbers: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """Each run of numbers of 0 and more, seven bits a byte, the lowest first."""
    left = numbers.astype(np.uint64)
    sizes = np.ones(len(left), np.int64)
    for i in range(1, 10):
        more = left >> np.uint64(7 * i) > 0
        if not more.any():
            break
        sizes += more
    place = K.ranges(np.zeros(len(sizes), np.int64), sizes)
    of = np.repeat(np.arange(len(sizes)), sizes)
    low = (left[of] >> (place * 7).astype(np.uint64)) & np.uint64(127)
    data = (low | ((place < sizes[of] - 1).astype(np.uint64) << np.uint64(7))) \
        .astype(np.uint8).tobytes()
    at = np.concatenate([[0], np.cumsum(sizes)])[offsets].tolist()
    return [data[x:y] for x, y in zip(at[:-1], at[1:], strict=True)]


def unpack(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all runs and the offsets of each run's."""
    raw = np.frombuffer(b"".join(parts), np.uint8)
    ends = raw < 128
    at = np.cumsum([0, *map(len, parts)])
    offsets = np.concatenate([[0], np.cumsum(ends)])[at]
    if not len(raw):
        return np.empty(0, np.int64), offsets
    first = np.flatnonzero(np.append(True, ends[:-1]))
    place = np.arange(len(raw)) - np.repeat(first, np.diff(np.append(first, len(raw))))
    return np.add.reduceat((raw & 127).astype(np.int64) << (7 * place), first), offsets


class Pieces(dict):
    """Ids of A by piece of text (its byte-level pattern's matches, each encoded apart from
    the rest of its text), as the bytes of 32-bit numbers, in two generations. Texts are cut here only if every character is
    one around which the tokenizer itself cuts in the same way; others it encodes whole."""

    def __init__(self, tokenizer, sizes: np.ndarray):
        super().__init__()
        self._tokenizer, self._sizes = tokenizer, sizes
        self._pattern = regex.compile(BYTE_LEVEL_PATTERN)
        self._older: dict[str, bytes] = {}
        self._alike: dict[str, bool] = {}

    def cut(self, text: str) -> list[str] | None:
        for c in set(text):
            alike = self._alike.get(c)
            if alike is None:
                around = f"a{c}1{c} {c}  "
                theirs = [around[x:y] for _, (x, y) in
                          self._tokenizer.pre_tokenizer.pre_tokenize_str(around)]
                alike = self._alike[c] = theirs == self._pattern.findall(around)
            if not alike:
                return None
        return self._pattern.findall(text)

    def learn(self, cuts: list[list[str]]) -> None:
        """Make the ids of all these pieces known until the next call."""
        if len(self) > KEPT_PIECES:
            self._older = dict(self)
            self.clear()
        new = []
        for piece in set(chain.from_iterable(cuts)).difference(self):
            ids = self._older.get(piece)
            if ids is None:
                new.append(piece)
            else:
                self[piece] = ids
        for at in range(0, len(new), BATCH_PIECES):
            batch = new[at:at + BATCH_PIECES]
            ids = self._tokenizer.encode_batch_fast([batch], is_pretokenized=True,
                                                    add_special_tokens=False)[0].ids
            ids = np.array(ids, np.int32)
            ends = np.cumsum([len(p.encode()) for p in batch])
            cut = [0, *(4 * np.searchsorted(np.cumsum(self._sizes[ids]), ends, "right")).tolist()]
            data = ids.tobytes()
            self.update(zip(batch, [data[x:y] for x, y in zip(cut[:-1], cut[1:], strict=True)],
                            strict=True))

    def ids(self, pieces: list[str]) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.__getitem__, pieces)), np.int32) \
            .astype(np.int64)


class Vocabularies:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, a_content: bytes, b_content: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        self._a = Tokenizer.from_str(a_content.decode())
        self._a.encode_special_tokens = True
        self._b = sentencepiece.SentencePieceProcessor(model_proto=b_content)
        a_size = 1 + max(self._a.get_vocab().values())
        self.a_bytes = [b""] * a_size
        shown = shown_bytes()
        special = {t["id"] for t in json.loads(a_content)["added_tokens"]}
        for token, i in self._a.get_vocab().items():
            if i not in special:
                self.a_bytes[i] = bytes(shown[c] for c in token)
        self.b_bytes = [self._b_token(i) for i in range(self._b.get_piece_size())]
        self.a_sizes = np.array([len(t) for t in self.a_bytes], np.int64)
        self.b_sizes = np.array([len(t) for t in self.b_bytes], np.int64)
        self.a_names = _names(a_size, ",", "|")
        self.b_names = _names(len(self.b_bytes), ",", ";")
        self._pieces = Pieces(self._a, self.a_sizes)

    def _b_token(self, i: int) -> bytes:
        piece = self._b.id_to_piece(i)
        if self._b.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return b"" if self._b.is_control(i) else piece.replace("\u2581", " ").encode()

    def _encode_a(self, texts: list[str]) -> list[np.ndarray]:
        cuts = [self._pieces.cut(t) for t in texts]
        self._pieces.learn([c for c in cuts if c is not None])
        rest = iter(self._a.encode_batch_fast(
            [t for t, c in zip(texts, cuts, strict=True) if c is None], add_special_tokens=False))
        return [np.array(next(rest).ids, np.int64) if c is None else self._pieces.ids(c)
                for c in cuts]

    def encode(self, texts: list[str]) -> tuple[list, list]:
        """Token ids of both; none for a text that either does not give back in full."""
        a_ids: list = [()] * len(texts)
        b_ids: list = [()] * len(texts)
        some = [i for i, t in enumerate(texts) if t]
        found_a = self._encode_a([" " + texts[i] for i in some])
        found_b = self._b.encode([texts[i] for i in some], num_threads=1)
        a_bytes, b_bytes = self.a_bytes.__getitem__, self.b_bytes.__getitem__
        for i, a, b in zip(some, found_a, found_b, strict=True):
            whole = (" " + texts[i]).encode()
            if b"".join(map(a_bytes, a.tolist())) == whole \
                    and b"".join(map(b_bytes, b)) == whole:
                a_ids[i], b_ids[i] = a, b
        return a_ids, b_ids


def shown_bytes() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it is
    printable in Latin-1, else the next one from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


_LINKS = ("part long, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
          "groups string, pairs binary, links binary")


def _linked(batches, vocabularies: Vocabularies):
    task = TaskContext.get().partitionId()
    part, size = 0, 0
    for block in K.text_blocks(batches, "text"):
        texts = [block.text(d).decode("utf-8", "replace") for d in range(len(block))]
        found = align(*vocabularies.encode(texts), vocabularies.a_sizes, vocabularies.b_sizes)
        parts = []
        sizes = (np.diff(block.offsets) + ROW_BYTES).tolist()
        for d in range(len(block)):
            if size and size + sizes[d] > PART_BYTES:
                part, size = part + 1, 0
            size += sizes[d]
            parts.append(task << 32 | part)
        keys, counts, at = block_pairs(found, len(vocabularies.a_bytes),
                                       len(vocabularies.b_bytes))
        yield pa.RecordBatch.from_arrays(
            [pa.array(parts, pa.int64()), block.batch.column("doc_id"),
             pa.array(np.diff(found.a_offsets)), pa.array(np.diff(found.b_offsets)),
             pa.array(np.diff(found.groups)), pa.array(run_sums(counts, at)),
             pa.array(list(group_texts(found, vocabularies.a_names, vocabularies.b_names)),
                      pa.string()),
             K.binary_list(pack(rises(keys, at), at)), K.binary_list(pack(counts, at))],
            names=["part", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs",
                   "links"])


def _part_pairs(batches):
    """(part, pair, documents): each pair once for a part, or for the stretch of a part that
    this partition holds. A part's pairs are bounded by its text bytes."""
    part, keys, counts = None, np.empty(0, np.int64), np.empty(0, np.int64)

    def out():
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(keys), part, np.int64)), pa.array(keys), pa.array(counts)],
            names=["part", "pair", "documents"])

    for batch in batches:
        parts, packed = batch.column("part").to_numpy(), batch.column("pairs")
        bounds = [0, *(np.flatnonzero(parts[1:] != parts[:-1]) + 1).tolist(), len(parts)]
        for x, y in zip(bounds[:-1], bounds[1:], strict=True):
            if x == y:
                continue
            if part is not None and parts[x] != part:
                yield out()
                keys = counts = np.empty(0, np.int64)
            part = int(parts[x])
            more = risen(*unpack(packed[x:y].to_pylist()))
            keys, counts = _counted(np.concatenate([keys, more]), np.concatenate(
                [counts, np.ones(len(more), np.int64)]))
    if part is not None:
        yield out()


def _answered(docs: pa.Table, known: pa.Table) -> pa.Table:
    """One part's documents with the corpus counts of its pairs."""
    pairs = known.column("pair").to_numpy()
    order = np.argsort(pairs)
    pairs = np.append(pairs[order], -1)
    counts = np.append(known.column("n").to_numpy()[order], 0)
    best = np.append(known.column("best").to_numpy()[order], 0)
    keys, offsets = unpack(docs.column("pairs").to_pylist())
    links, _ = unpack(docs.column("links").to_pylist())
    at = np.searchsorted(pairs[:-1], risen(keys, offsets))
    return docs.drop_columns(["part", "pairs", "links"]) \
        .append_column("n_best", pa.array(run_sums(links * best[at], offsets))) \
        .append_column("count_sum", pa.array(run_sums(links * counts[at], offsets)))


def link_tokens(docs: DataFrame, a_path: str, b_path: str, keep_groups: bool = True) -> DataFrame:
    """Tokens and groups of every whole text, staged: part, doc_id, n_a, n_b, n_groups,
    n_links, the groups as text (or their SHA-256 if not ``keep_groups``; empty without
    tokens) and the packed distinct id pairs with their numbers of links.

    Null and empty texts, and texts that a tokenizer does not give back byte by byte, have
    no tokens. Bytes that are not UTF-8 count as U+FFFD. Rows that repeat a doc_id are
    documents of their own; a null doc_id stays null; an empty table gives no rows; other
    columns are not read."""
    spark = docs.sparkSession
    contents = []
    for path in (a_path, b_path):
        with open(path, "rb") as f:
            contents.append(f.read())
    sent = spark.sparkContext.broadcast(contents)  # two vocabularies, whatever the documents

    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives the task one core
        vocabularies = Vocabularies(*sent.value)
        for batch in _linked(batches, vocabularies):
            if not keep_groups:
                texts = [hashlib.sha256(t.encode()).hexdigest() if t else ""
                         for t in batch.column("groups").to_pylist()]
                batch = batch.set_column(6, "groups", pa.array(texts, pa.string()))
            yield batch

    return staged(id_and_text(docs).mapInArrow(run, _LINKS), "token-links")


def pair_counts(linked: DataFrame, b_size: int) -> tuple[DataFrame, DataFrame]:
    """(part, pair) asked for by ``linked``, and (pair, a, b, n, best) over all documents:
    how many hold the pair linked, and 1 if no pair of that A id is in more."""
    asked = staged(linked.select("part", "pairs").mapInArrow(
        _part_pairs, "part long, pair long, documents long"), "asked-pairs")
    counted = staged(asked.groupBy("pair").agg(F.sum("documents").alias("n")), "pair-counts")
    counted = counted.withColumn("a", F.expr(f"pair div {b_size}")) \
        .withColumn("b", F.col("pair") % b_size)
    # one row for each id of vocabulary A: at most its size
    top = F.broadcast(counted.groupBy("a").agg(F.max("n").alias("most")))
    return asked.select("part", "pair"), counted.join(top, "a").select(
        "pair", "a", "b", "n", (F.col("n") == F.col("most")).cast("long").alias("best"))


def align_tokens(docs: DataFrame, a_path: str, b_path: str,
                 keep_groups: bool = True) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, groups (see ``link_tokens``),
    n_best (links whose pair is in as many documents as any pair of its A id) and
    count_sum (documents that hold the pair, summed over links)."""
    import sentencepiece

    b_size = sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()
    linked = link_tokens(docs, a_path, b_path, keep_groups)
    asked, counts = pair_counts(linked, b_size)
    known = asked.join(counts.select("pair", "n", "best"), "pair")
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, " \
        "n_best long, count_sum long"
    # a part has a bounded number of text bytes, and no more pairs than its documents
    return linked.groupBy("part").cogroup(known.groupBy("part")).applyInArrow(_answered, schema)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    paths = [public_tokenizers.path(name) for name in (A_FILE, B_FILE)]
    return align_tokens(table(spark, sf_dir, "documents"), *paths, keep_groups=False) \
        .withColumnRenamed("groups", "groups_sha256")
