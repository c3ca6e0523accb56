"""Alignment against plain loops over the libraries' tokens."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sparkledger.llm import alignment

A_PATH, B_PATH = (public_tokenizers.path(n) for n in (alignment.A_FILE, alignment.B_FILE))


@pytest.fixture(scope="module")
def tokens_of():
    """(id, end offset) lists of both tokenizers, or two empty ones."""
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    byte_of = alignment.shown_bytes()

    def ends(pairs):
        out, at = [], 0
        for i, size in pairs:
            at += size
            out.append((i, at))
        return out

    def tokens(text):
        if not text:
            return [], []
        whole = (" " + text).encode()
        first = a.encode(" " + text, add_special_tokens=False)
        one = [(i, bytes(byte_of[c] for c in t)) for i, t in
               zip(first.ids, first.tokens, strict=True)]
        two = [(i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode())
               for i in b.encode(text) for p in [b.id_to_piece(i)]]
        if any(b"".join(t for _, t in x) != whole for x in (one, two)):
            return [], []
        return ends((i, len(t)) for i, t in one), ends((i, len(t)) for i, t in two)

    return tokens


def brute_force(tokens_of, rows):
    """Columns of every row, in order."""
    grouped = []
    for _, text in rows:
        a, b = tokens_of(text)
        cuts = sorted({e for _, e in a} & {e for _, e in b})
        groups, low = [], 0
        for cut in cuts:
            groups.append(([i for i, e in a if low < e <= cut],
                           [i for i, e in b if low < e <= cut]))
            low = cut
        grouped.append((a, b, groups))
    held = Counter()
    for *_, groups in grouped:
        held.update({(i, j) for one, two in groups for i in one for j in two})
    best = {}
    for (i, _), n in held.items():
        best[i] = max(best.get(i, 0), n)
    out = []
    for (doc_id, _), (a, b, groups) in zip(rows, grouped, strict=True):
        links = [(i, j) for one, two in groups for i in one for j in two]
        text = ";".join(",".join(map(str, one)) + "|" + ",".join(map(str, two))
                        for one, two in groups)
        out.append((doc_id, len(a), len(b), len(groups), len(links),
                    hashlib.sha256(text.encode()).hexdigest() if text else "",
                    sum(held[x] == best[x[0]] for x in links), sum(held[x] for x in links)))
    return out


def result(df):
    return sorted(((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.groups, r.n_best,
                    r.count_sum) for r in df.collect()), key=str)


sorted_numbers = st.sets(st.integers(1, 60), max_size=40).map(
    lambda s: np.array(sorted(s), np.int64))


@settings(max_examples=300, deadline=None)
@given(sorted_numbers, sorted_numbers, st.integers(1, 9))
def test_pieces_share_what_the_whole_merge_shares(a, b, piece):
    found = alignment.shared_ends(a, b, piece)
    both = np.intersect1d(a, b)
    assert (a[found.a] == both).all() and (b[found.b] == both).all()
    assert len(found.a) == len(found.b) == len(both)


@settings(max_examples=200, deadline=None)
@given(sorted_numbers, sorted_numbers, st.integers(1, 9))
def test_pieces_are_of_equal_work(a, b, piece):
    i, j = alignment.diagonals(a, b, piece)
    work = np.diff(i + j)
    assert i[-1] == len(a) and j[-1] == len(b)
    assert (work[:-1] == piece).all() and (work <= piece).all()
    for x, y in zip(i, j, strict=True):  # all before the border precede all behind it
        assert not (x and y < len(b)) or a[x - 1] <= b[y]
        assert not (y and x < len(a)) or b[y - 1] < a[x]


@given(st.lists(st.sets(st.integers(0, 2**60), max_size=5)))
def test_packing_round_trip(runs):
    values = np.array([v for r in runs for v in sorted(r)], np.int64)
    offsets = np.cumsum([0, *map(len, runs)])
    packed = alignment.pack(alignment.rises(values, offsets), offsets)
    steps, at = alignment.unpack(packed)
    assert (at == offsets).all() and (alignment.risen(steps, at) == values).all()
    assert alignment.run_sums(values % 1000, at).tolist() == [sum(v % 1000 for v in r) for r in runs]


def test_pieces_are_encoded_as_in_their_text(monkeypatch):
    """Kept pieces against whole texts, with characters that libraries cut apart differently."""
    monkeypatch.setattr(alignment, "KEPT_PIECES", 20)
    monkeypatch.setattr(alignment, "BATCH_PIECES", 3)
    with open(A_PATH, "rb") as f, open(B_PATH, "rb") as g:
        both = alignment.Vocabularies(f.read(), g.read())
    tokenizer = Tokenizer.from_file(A_PATH)
    tokenizer.encode_special_tokens = True
    texts = [" " + t for _, t in _rows() if t] + [" new letter \u088f in", " a\x1cb\x85 \u3000 c",
                                                  "  <|endoftext|>\r\n", " \U000187f8x"]
    for text in texts:
        assert both._encode_a([text])[0].tolist() == \
            tokenizer.encode(text, add_special_tokens=False).ids
    assert both._pieces.cut("x \u088f") is None and both._pieces.cut("x \u00e9") == ["x", " \u00e9"]


def _rows():
    rng = random.Random(3)
    words = ["the", "token", "alignment", "naïve", "日本語", "x" * 30, "🙂", "don't", "\n", "  ",
             "12345", "<|endoftext|>", "</s>", "<s>", "of", "and", "Straße", "\tq", "​"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 60))))
            for i in range(60)]
    return rows + [(100, None), (101, ""), (102, " "), (103, "same text"), (103, "same text"),
                   (104, "z" * 3000), (105, "ﬁ ½ Ａ"), (106, "the token " * 5000),
                   (107, "ÀÉ" * 700)]


def test_table(spark, make_docs, tokens_of, monkeypatch):
    monkeypatch.setattr(alignment, "GROUP_PAIRS", 3)
    monkeypatch.setattr(alignment, "PART_BYTES", 2000)
    monkeypatch.setattr(alignment, "HELD_PAIRS", 50)
    monkeypatch.setattr(alignment, "PIECE_ENDS", 13)
    rows = _rows()
    got = alignment.align_tokens(make_docs(rows), A_PATH, B_PATH, keep_groups=False)
    want = brute_force(tokens_of, rows)
    assert result(got) == sorted(want, key=str)
    assert sum(r[1] > 0 for r in want) > 40 and sum(r[1] == 0 for r in want) >= 2


def test_groups_as_text(spark, make_docs, tokens_of):
    got = alignment.align_tokens(make_docs([(None, "don't stop")]), A_PATH, B_PATH).first()
    a, b = tokens_of("don't stop")
    parts = [g.split("|") for g in got.groups.split(";")]
    assert ",".join(x for x, _ in parts) == ",".join(str(i) for i, _ in a)
    assert ",".join(y for _, y in parts) == ",".join(str(i) for i, _ in b)
    assert got.doc_id is None and got.n_groups == len(parts)


def test_empty_table(spark, make_docs):
    assert alignment.align_tokens(make_docs([]), A_PATH, B_PATH).count() == 0


def test_query(spark, tokens_of, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet")
            .select("doc_id", "text").collect()]
    got = alignment.op13_token_alignment(spark, sf_dir).withColumnRenamed("groups_sha256",
                                                                         "groups")
    assert result(got) == sorted(brute_force(tokens_of, rows), key=str)


def test_kept_pieces_are_packed():
    """Four bytes a token: joined as they are, not chained through numbers."""
    with open(A_PATH, "rb") as f, open(B_PATH, "rb") as g:
        both = alignment.Vocabularies(f.read(), g.read())
    cuts = [both._pieces.cut(" packed pieces, naïve"), []]
    both._pieces.learn(cuts)
    assert all(isinstance(both._pieces[p], bytes) for p in cuts[0])
    want = Tokenizer.from_file(A_PATH).encode(" packed pieces, naïve", add_special_tokens=False)
    assert both._pieces.ids(cuts[0]).tolist() == want.ids
    assert both._pieces.ids([]).tolist() == []
