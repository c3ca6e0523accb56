"""Word finding and hashing against plain Python."""

import random
import re

import numpy as np
import pyarrow as pa

from sparkledger.llm import kernels as K

ALPHABET = "ab Z9\t\n\r\x0b\x0c,é漢\x00-"


def _block(texts):
    return K.text_block(pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())}), "text")


def test_words_match_the_stated_patterns():
    rng = random.Random(5)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(40))) for _ in range(300)]
    texts += [None, "", " ", "x"]
    for mask, pattern in ((K.SPACED, rb"[^\x20\x09-\x0D]+"),
                          (K.ALNUM, rb"[0-9A-Za-z\x80-\xff]+")):
        block = _block(texts)
        words = K.find_words(block, mask)
        for d, text in enumerate(texts):
            own = [block.data[a:b].tobytes() for a, b in
                   zip(words.start[words.offsets[d]:words.offsets[d + 1]],
                       words.end[words.offsets[d]:words.offsets[d + 1]], strict=True)]
            assert own == re.findall(pattern, (text or "").encode())


def test_hashes_depend_on_content_alone(monkeypatch):
    monkeypatch.setattr(K, "PIECE", 16)  # several pieces
    texts = ["alpha beta alpha", "Alpha", None, "gamma" * 20 + " beta", "beta"]
    block = _block(texts)
    words = K.find_words(block)
    h = K.hash_words(block.data, words, K.byte_codes(3, True)).tolist()
    spelled = [w for t in texts for w in (t or "").lower().split()]
    assert len(h) == len(spelled)
    assert len(set(zip(h, spelled, strict=True))) == len(set(h)) == len(set(spelled))
    grams = K.ngrams(np.array(h, K.U64), 2).tolist()
    assert len(grams) == len(h) - 1 and grams[0] != grams[1]


def test_long_ngrams_roll(monkeypatch):
    h = K.stream(9, 200)
    whole = K.ngrams(h, 13)
    monkeypatch.setattr(K, "PIECE", 7)
    assert (K.ngrams(h, 13) == whole).all()
    twice = np.concatenate([h, h])
    assert (K.ngrams(twice, 13)[200:] == whole).all()


def test_blocks_hold_every_document_once():
    texts = ["a" * n for n in (5, 0, 40, 3, 3, 100, 1)]
    batch = pa.RecordBatch.from_pydict({"text": texts, "n": list(range(7))})
    blocks = list(K.text_blocks([batch.slice(0, 3), batch.slice(3)], "text", 10))
    assert [b.text(d).decode() for b in blocks for d in range(len(b))] == texts
    assert sum((b.batch.column("n").to_pylist() for b in blocks), []) == list(range(7))
    assert all(len(b.data) <= 10 or len(b) == 1 for b in blocks)


def test_empty_batch_and_ranges():
    assert list(K.text_blocks([pa.RecordBatch.from_pydict({"text": pa.array([], pa.string())})],
                              "text")) == []
    assert K.ranges(np.array([3, 9, 1]), np.array([2, 0, 3])).tolist() == [3, 4, 1, 2, 3]
    assert K.covered(6, np.array([1, 2]), 2).tolist() == [False, True, True, True, False, False]
