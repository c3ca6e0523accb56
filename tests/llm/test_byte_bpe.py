"""Encoding against the tiktoken library, decoding against the codec of the language."""

import codecs
import hashlib
import random

import public_tokenizers
import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from sparkledger.llm import byte_bpe

PATH = public_tokenizers.path(byte_bpe.VOCABULARY)
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def ranks():
    with open(PATH, "rb") as f:
        return byte_bpe.read_ranks(f.read())


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder(ranks):
    return byte_bpe.Encoder(ranks, PATTERN)


def _texts():
    rng = random.Random(5)
    alphabets = ["abc", "etaoin shrdlu'", "aA1 -_\n\t", "日本語中文", "éüßñ€ж", "🙂👩‍👩‍👧 ", " "]
    made = ["".join(rng.choice(a) for _ in range(rng.randrange(1, 200)))
            for a in alphabets for _ in range(40)]
    return made + ["a" * 5000, "-" * 3000, " " * 2000 + "x", "ab" * 2000, "<|endoftext|> x",
                   "it's we'll I'M", "x \n\n  y", "0" * 999, "\u0000\u0001", "﻿x"]


def test_encoding_is_the_library_s(encoder, library):
    for text in _texts():
        assert encoder.encode(text).tolist() == library.encode_ordinary(text), text[:40]


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_encoding_of_any_text(encoder, library, text):
    assert encoder.encode(text).tolist() == library.encode_ordinary(text)


def test_long_texts_are_split_into_chunks_without_a_trace(encoder, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CHUNK", 7)
    for text in [*_texts(), "  lead and  trail  \n \n x" * 50]:
        assert encoder.encode(text).tolist() == library.encode_ordinary(text)


def test_forgetting_states_changes_nothing(ranks, library):
    small = byte_bpe.Transducer(ranks, most_states=4)
    for text in _texts()[::5]:
        for piece in text.split():
            assert list(small.encode(piece.encode())) == list(
                library._core_bpe.encode_single_piece(piece.encode()))
            assert len(small._states) <= 4


def test_merge_order_matters_in_a_small_vocabulary():
    """Ranks under which guesses differ late, against plain merging."""
    ranks = {bytes([b]): b for b in range(256)}
    for token in (b"ab", b"bc", b"cd", b"abc", b"bcd", b"aa", b"aab", b"cdcd", b"abcda"):
        ranks[token] = len(ranks)
    machine = byte_bpe.Transducer(ranks)
    rng = random.Random(1)
    for _ in range(3000):
        data = bytes(rng.choice(b"abcd") for _ in range(rng.randrange(1, 14)))
        want = [ranks[data]] if data in ranks else machine.merged(data)
        assert list(machine.encode(data)) == want


def test_a_token_that_merges_never_reach_stands_for_its_own_piece():
    ranks = {bytes([b]): b for b in range(256)} | {b"bc": 256, b"xabc": 257}
    machine = byte_bpe.Transducer(ranks)
    assert machine.encode(b"xabc") == (257,)
    assert machine.encode(b"xabcx") == (120, 97, 256, 120)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.binary(max_size=6) | st.sampled_from(
    [b"\xe2\x82", b"\xac", b"\xf0\x9f", b"\x99\x82", b"\xed\xa0", b"\xc0", b"\xf4\x90"])))
def test_streaming_decode(parts):
    stream, got = byte_bpe.Utf8Stream(), ""
    for part in parts:
        got += stream.feed(part)
        assert len(stream._open) <= 3
    assert got + stream.close() == b"".join(parts).decode("utf-8", "replace")


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=30))
def test_streaming_decode_holds_back_unfinished_characters_only(text):
    stream, plain = byte_bpe.Utf8Stream(), codecs.getincrementaldecoder("utf-8")()
    for byte in text.encode():
        assert stream.feed(bytes([byte])) == plain.decode(bytes([byte]))


def test_table(spark, make_docs, library):
    rows = [(1, "Hello wörld, it's 2024\n\n ok"), (2, None), (3, ""), (4, "same"), (4, "same"),
            (None, "日本 🙂"), (5, "long " * 40000), (6, "x" * 70000)]
    tokens = byte_bpe.encode(make_docs(rows), PATH, PATTERN)
    got = byte_bpe.decode(tokens, PATH).collect()
    want = [(i, library.encode_ordinary(t or ""), t or "") for i, t in rows]
    assert sorted((str(r.doc_id), r.ids, r.text) for r in got) == \
        sorted((str(i), ids, t) for i, ids, t in want)
    assert byte_bpe.encode(make_docs([]), PATH, PATTERN).count() == 0


def test_query(spark, library, sf_dir):
    docs = {r.doc_id: r.text for r in
            spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    got = byte_bpe.op11_byte_bpe(spark, sf_dir).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = library.encode_ordinary(docs[r.doc_id] or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((docs[r.doc_id] or "").encode()).hexdigest()


def test_kept_pieces_are_packed(encoder, library):
    """Four bytes a token: joined as they are, not chained through numbers."""
    text = "packed pieces, packed pieces"
    assert encoder.encode(text).tolist() == library.encode_ordinary(text)
    assert encoder.encode("").tolist() == []
    kept = encoder[" pieces"]
    assert isinstance(kept, bytes)
    assert np.frombuffer(kept, np.int32).tolist() == library.encode_ordinary(" pieces")


def test_a_worker_keeps_its_encoder(ranks, library):
    """Tasks of one stage that run in one Python worker share states and pieces."""
    with open(PATH, "rb") as f:
        kept = {"content": f.read()}
    first = byte_bpe._encoder(kept, PATTERN)
    text = "kept from task to task"
    assert first.encode(text).tolist() == library.encode_ordinary(text)
    assert byte_bpe._encoder(kept, PATTERN) is first and " kept" not in first._older
    assert byte_bpe._encoder(kept, r"\S+|\s+") is not first


def test_round_trip_is_decode_of_encode(spark, make_docs):
    rows = [(1, "Hello wörld \n\n ok"), (2, None), (3, ""), (3, "x" * 70000), (None, "日本 🙂")]
    both = byte_bpe.round_trip(make_docs(rows), PATH, PATTERN)
    apart = byte_bpe.decode(byte_bpe.encode(make_docs(rows), PATH, PATTERN), PATH)
    assert sorted(map(str, both.collect())) == sorted(map(str, apart.collect()))
    assert both._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert byte_bpe.round_trip(make_docs([]), PATH, PATTERN).count() == 0


def test_forgotten_states_lead_nowhere(ranks):
    """They go at once, though the garbage collector rests while texts are encoded."""
    machine = byte_bpe.Transducer(ranks, most_states=3)
    machine.encode(b"ab")
    old = [s for s in machine._states.values() if s is not machine._start]
    machine.encode(b"zyxwvu")
    assert old and not any(s is t for s in old for t in machine._states.values())
    assert not any(byte_bpe.HYPOTHESES in s for s in old)
