"""Byte-level BPE encoding and decoding.

The merges are compiled into a finite-state transducer that is determinised as it reads.
Its non-deterministic form guesses the next token: a hypothesis is the last token taken, a
place in the trie of tokens, and tokens not yet emitted. Two tokens may follow one another
if merging their joined bytes gives just the two back; a token sequence all of whose
neighbours may follow one another is the encoding of its bytes, and the only one. A
deterministic state is the set of live hypotheses; what all of them agree on is emitted, so
a token leaves as soon as the bytes read after it (a bounded number) rule out all else.
States and steps are kept, up to a limit, and made anew when needed again.

Decoding streams: token bytes go through an incremental UTF-8 state machine that holds back
the bytes of an unfinished character.
"""

from __future__ import annotations

import base64
import gc
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernels as K
from .common import id_and_text, table

VOCABULARY = "byte_bpe_50k.tiktoken"
#: States kept before the transducer starts afresh, and checked pairs of tokens.
MOST_STATES = 1 << 18
MOST_PAIRS = 1 << 20
#: Pieces whose tokens are kept (of each generation), and the longest kept.
MOST_PIECES = 1 << 18
KEPT_LENGTH = 48
#: Characters of a text that are split into pieces at once.
CHUNK = 1 << 16
#: Tokens decoded at once.
DECODED = 1 << 12


def read_ranks(content: bytes) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file: a base64 token and its rank on every line."""
    pairs = (line.split() for line in content.splitlines() if line)
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


#: Key of a state, which is a dict, besides the bytes it has read: its hypotheses.
HYPOTHESES = -1


class Transducer:
    """Bytes of one piece in, tokens out.

    A state maps a byte to (next state, tokens emitted on the way); what is missing is made
    when it is read."""

    def __init__(self, ranks: dict[bytes, int], most_states: int = MOST_STATES):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.most_states = most_states
        self._most = 1 + max(self.bytes_of, default=0)
        #: The trie: of each node, byte -> (node, its token or -1, whether it leads on).
        self._trie: list[dict[int, tuple[int, int, bool]]] = [{}]
        for token in sorted(ranks, key=len):  # a token's beginnings come before it
            node = 0
            for at, byte in enumerate(token):
                inner = self._trie[node]
                place, rank, leads = inner.get(byte, (0, -1, False))
                if not place:
                    place = len(self._trie)
                    self._trie.append({})
                last = at == len(token) - 1
                inner[byte] = (place, ranks[token] if last else rank, leads or not last)
                node = place
        self._follows: dict[int, bool] = {}
        self._states: dict[tuple, dict] = {}
        self._start = self._state(((0, -1, ()),))

    def _state(self, hypotheses: tuple) -> dict:
        if len(self._states) >= self.most_states:
            # states lead to one another; emptied, they go without the garbage collector
            start = self._start[HYPOTHESES]
            for state in self._states.values():
                state.clear()
            self._start[HYPOTHESES] = start
            self._states = {start: self._start}
        state = self._states[hypotheses] = {HYPOTHESES: hypotheses}
        return state

    def merged(self, data: bytes) -> list[int]:
        """The merges applied one by one, lowest rank first, leftmost among equals."""
        parts = [data[i:i + 1] for i in range(len(data))]
        rank_of, none = self.ranks.get, self._most
        ranks = [rank_of(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
        while ranks and (lowest := min(ranks)) < none:
            at = ranks.index(lowest)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            if at:
                ranks[at - 1] = rank_of(parts[at - 1] + parts[at], none)
            if at < len(ranks):
                ranks[at] = rank_of(parts[at] + parts[at + 1], none)
        return [self.ranks[p] for p in parts]

    def _may_follow(self, last: int, token: int) -> bool:
        """Whether ``token`` may come after ``last`` (-1: at the start of a piece)."""
        if len(self._follows) >= MOST_PAIRS:
            self._follows.clear()
        pair = [token] if last < 0 else [last, token]
        known = self.merged(b"".join([self.bytes_of[t] for t in pair])) == pair
        self._follows[(last + 1) * self._most + token] = known
        return known

    def _step(self, state: dict, byte: int) -> tuple[dict, tuple[int, ...]]:
        """Hypotheses stay in the order in which their unfinished tokens begin, so what they
        hold gets longer. What has been read has one encoding: exactly one ends a token."""
        trie, follows, most = self._trie, self._follows, self._most
        live, ended = [], None
        for node, last, held in state[HYPOTHESES]:
            found = trie[node].get(byte)
            if found is None:
                continue
            place, token, leads = found
            if leads:
                live.append((place, last, held))
            if token >= 0 and ended is None:
                known = follows.get((last + 1) * most + token)
                if known or (known is None and self._may_follow(last, token)):
                    ended = (0, token, (*held, token))
        if ended is None:
            raise ValueError(f"the vocabulary has no token for byte {byte}")
        agreed = ended[2]
        for _, _, held in live:
            if not held:
                agreed = ()
                break
            if held[:len(agreed)] != agreed:
                n = 0
                while n < len(held) and held[n] == agreed[n]:
                    n += 1
                agreed = agreed[:n]
        live.append(ended)
        if agreed:
            n = len(agreed)
            live = [(node, last, held[n:]) for node, last, held in live]
        after = tuple(live)
        following = self._states.get(after)
        if following is None:
            following = self._state(after)
        step = state[byte] = following, agreed
        return step

    def _end(self, state: dict, byte: int) -> tuple[int, ...]:
        """What is still to be emitted when ``byte`` is the last of its piece: a piece that
        is a token is that token; else one hypothesis ends a token here."""
        trie, follows, most = self._trie, self._follows, self._most
        for node, last, held in state[HYPOTHESES]:
            found = trie[node].get(byte)
            if found is None or found[1] < 0:
                continue
            token = found[1]
            if last < 0:
                return (token,)
            known = follows.get((last + 1) * most + token)
            if known or (known is None and self._may_follow(last, token)):
                return (*held, token)
        raise ValueError(f"the vocabulary has no token for byte {byte}")

    def encode(self, piece: bytes) -> tuple[int, ...]:
        state, out = self._start, ()
        for byte in piece[:-1]:
            step = state.get(byte)
            if step is None:
                step = self._step(state, byte)
            state, emitted = step
            if emitted:
                out += emitted
        return out + self._end(state, piece[-1]) if piece else out


class Encoder(dict):
    """Tokens of texts; those of short pieces are kept (a dict from piece to the bytes of its
    tokens as 32-bit numbers), in two generations: what a full one holds is kept until the
    next is full."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        super().__init__()
        self._older: dict[str, bytes] = {}
        self._transducer = Transducer(ranks)
        self.bytes_of = self._transducer.bytes_of
        self._pattern = regex.compile(pattern)
        self._break = regex.compile(r"(?<=\S)\s")

    def __missing__(self, piece: str) -> bytes:
        ids = self._older.get(piece)
        if ids is None:
            found = self._transducer.encode(piece.encode())
            ids = struct.pack(f"={len(found)}i", *found)
        if len(piece) <= KEPT_LENGTH:
            if len(self) >= MOST_PIECES:
                self._older = dict(self)
                self.clear()
            self[piece] = ids
        return ids

    def _pieces(self, text: str) -> Iterator[list[str]]:
        """Matches of the pattern, a chunk at a time; no match holds a white space after
        another character, so a chunk may end there."""
        at = 0
        while at < len(text):
            cut = self._break.search(text, at + CHUNK) if len(text) - at > CHUNK else None
            end = cut.start() if cut else len(text)
            yield self._pattern.findall(text[at:end])
            at = end

    def encode(self, text: str) -> np.ndarray:
        parts = [b"".join(map(self.__getitem__, pieces)) for pieces in self._pieces(text)]
        return np.frombuffer(b"".join(parts), np.int32)


#: Well-formed UTF-8. Lead bytes, the range of the second byte, and how many
#: bytes follow the lead.
_LEADS = [((0xC2, 0xDF), (0x80, 0xBF), 1), ((0xE0, 0xE0), (0xA0, 0xBF), 2),
          ((0xE1, 0xEC), (0x80, 0xBF), 2), ((0xED, 0xED), (0x80, 0x9F), 2),
          ((0xEE, 0xEF), (0x80, 0xBF), 2), ((0xF0, 0xF0), (0x90, 0xBF), 3),
          ((0xF1, 0xF3), (0x80, 0xBF), 3), ((0xF4, 0xF4), (0x80, 0x8F), 3)]


class Utf8Stream:
    """Bytes in, complete characters out; ill-formed bytes become U+FFFD.

    The states are how an unfinished character may go on: (lowest and highest next byte,
    number of bytes to come)."""

    _START = {lead: (*second, more) for (low, high), second, more in _LEADS
              for lead in range(low, high + 1)}

    def __init__(self) -> None:
        self._open = b""

    @classmethod
    def _unfinished(cls, data: bytes) -> int:
        """How many bytes at the end of ``data`` begin a character without ending it."""
        for n in range(1, min(3, len(data)) + 1):
            state = cls._START.get(data[-n])
            if state is None:
                if data[-n] & 0xC0 != 0x80:
                    return 0
                continue
            for byte in data[len(data) - n + 1:]:
                low, high, more = state
                if more == 1 or not low <= byte <= high:
                    return 0
                state = 0x80, 0xBF, more - 1
            return n
        return 0

    def feed(self, data: bytes) -> str:
        data = self._open + data
        whole = len(data) - self._unfinished(data)
        self._open = data[whole:]
        return data[:whole].decode("utf-8", "replace")

    def close(self) -> str:
        rest, self._open = self._open, b""
        return rest.decode("utf-8", "replace")


def decoded(ids: Iterable[int], bytes_of: dict[int, bytes]) -> str:
    """The text of token ids, decoded as a stream."""
    ids, stream = list(ids), Utf8Stream()
    parts = [stream.feed(b"".join([bytes_of[i] for i in ids[a:a + DECODED]]))
             for a in range(0, len(ids), DECODED)]
    return "".join([*parts, stream.close()])


def _shipped(spark: SparkSession, path: str):
    """The rank file's content on every executor: as large as the vocabulary, whatever the
    documents. It goes as a dict, whose copy a Python worker keeps from one task of a stage to
    the next."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast({"content": f.read()})


def _encoder(kept: dict, pattern: str) -> Encoder:
    """The worker's encoder of a shipped rank file, with the states and pieces of its tasks
    before."""
    if pattern not in kept:
        kept[pattern] = Encoder(read_ranks(kept["content"]), pattern)
    return kept[pattern]


def _encoded(batches: Iterator[pa.RecordBatch], encoder: Encoder):
    gc.disable()  # it would walk all states again and again and find nothing
    try:
        for block in K.text_blocks(batches, "text"):
            found = [encoder.encode(block.text(d).decode("utf-8", "replace"))
                     for d in range(len(block))]
            offsets = np.cumsum([0, *map(len, found)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found)))
            yield pa.RecordBatch.from_arrays([block.batch.column("doc_id"), ids],
                                             names=["doc_id", "ids"])
    finally:
        gc.enable()


def _decoded(batches: Iterator[pa.RecordBatch], bytes_of: dict[int, bytes]):
    for batch in batches:
        ids = batch.column("ids")
        texts = [decoded(row.values.to_numpy(zero_copy_only=False).tolist(), bytes_of)
                 if row.is_valid else "" for row in ids]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), ids, pa.array(texts, pa.string())],
            names=["doc_id", "ids", "text"])


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids array<int>): every whole text by the rank file at ``path`` (on the
    driver), each match of ``pattern`` on its own, without special tokens.

    A null or empty text has no tokens. Bytes that are not UTF-8 count as U+FFFD. Rows
    that repeat a doc_id are encoded one by one, a null doc_id stays null, an empty table
    gives no rows; other columns are not read."""
    sent = _shipped(docs.sparkSession, path)
    return id_and_text(docs).mapInArrow(
        lambda b: _encoded(b, _encoder(sent.value, pattern)), "doc_id long, ids array<int>")


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) -> (doc_id, ids, text). Null ids have the empty text; an id outside
    the vocabulary is an error."""
    sent = _shipped(tokens.sparkSession, path)

    def run(batches):
        bytes_of = {rank: token for token, rank in read_ranks(sent.value["content"]).items()}
        yield from _decoded(batches, bytes_of)

    return tokens.select(F.col("doc_id").cast("long").alias("doc_id"),
                         F.col("ids").cast("array<int>").alias("ids")) \
        .mapInArrow(run, "doc_id long, ids array<int>, text string")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``decode`` of ``encode``, in one Python worker of a task: (doc_id, ids, text)."""
    sent = _shipped(docs.sparkSession, path)

    def run(batches):
        encoder = _encoder(sent.value, pattern)
        yield from _decoded(_encoded(batches, encoder), encoder.bytes_of)

    return id_and_text(docs).mapInArrow(run, "doc_id long, ids array<int>, text string")


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path(VOCABULARY)
    tokens = round_trip(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    return tokens.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256)
        .alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))
