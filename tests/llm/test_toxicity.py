"""Held-out accuracy and located sentences."""

import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa

from sparkledger.llm import kernels as K
from sparkledger.llm import toxicity as T

BAD = ("vile", "nasty", "horrid")


def _corpus(n=600):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(n):
        sentences = [" ".join(f"w{rng.randrange(300)}" for _ in range(rng.randrange(3, 12)))
                     for _ in range(rng.randrange(1, 15))]
        toxic = rng.random() < 0.3
        if toxic:
            k = rng.randrange(len(sentences))
            sentences[k] += " " + rng.choice(BAD) + rng.choice(("", "ness", "ly"))
        rows.append((i, ". ".join(sentences) + "."))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def _labels(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy_and_sentences(spark, make_docs):
    rows, labels = _corpus()
    docs = make_docs(rows)
    model = T.fit(docs, _labels(spark, labels))
    got = {r.doc_id: r for r in T.score_toxicity(docs, model).collect()}
    held = [(i, y) for i, _, y in labels if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum(got[i].predicted == y for i, y in held) >= 0.97 * len(held)
    text = dict(rows)
    for i, _, y in labels:
        assert 0 <= got[i].score <= 1
        if y and got[i].predicted:
            assert any(b in text[i][s.start:s.end] for s in got[i].sentences for b in BAD)
    kept = T.without_toxic(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i in got if not got[i].predicted}


def test_held_out_labels_are_never_read(spark, make_docs):
    rows, labels = _corpus(200)
    flipped = [(i, q, 1 - y if zlib.crc32(str(i).encode()) % 4 == 2 else y)
               for i, q, y in labels]
    a = T.fit(make_docs(rows), _labels(spark, labels))
    b = T.fit(make_docs(rows), _labels(spark, flipped))
    assert a[:2] == b[:2] and (a.weights == b.weights).all()


def _plainly(text, model):
    """Noisy-or by loops over sentences and words."""
    keep = 1 / (1 + math.exp(model.leak))
    for sentence in re.split(r"[.!?\n]", text or ""):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", sentence)
        if not words:
            continue
        block = K.text_block(pa.RecordBatch.from_pydict({"text": [" ".join(words)]}), "text")
        found = [model.weights[f] for f in T.sentence_bags(block).features]
        if any(found):
            keep *= 1 / (1 + math.exp(model.bias + math.fsum(map(float, found))))
    return 1 - keep


def test_noisy_or_with_a_trained_model(spark, make_docs):
    rows, labels = _corpus(300)
    model = T.fit(make_docs(rows), _labels(spark, labels))
    assert (model.weights != 0).sum() > 3
    extra = [(1001, ""), (1002, None), (1003, "...\n"), (None, "vile. nasty! w1"), (1, "w2"), (1, "w2")]
    got = T.score_toxicity(make_docs(rows + extra), model).collect()
    want = sorted(((str(i), _plainly(t, model)) for i, t in rows + extra))
    have = sorted((str(r.doc_id), r.score) for r in got)
    assert [i for i, _ in have] == [i for i, _ in want]
    assert np.allclose([p for _, p in have], [p for _, p in want], rtol=1e-6, atol=1e-9)


def test_length_alone_is_never_toxic(spark, make_docs):
    rows, labels = _corpus()
    model = T.fit(make_docs(rows), _labels(spark, labels))
    clean = ". ".join(f"w{i % 300} w{i % 7}" for i in range(100_000))
    listing = "1 2. " * 10_000
    got = T.score_toxicity(make_docs([(1, clean), (2, listing), (3, clean + ". so vile.")]), model)
    scores = {r.doc_id: r.score for r in got.collect()}
    assert scores[1] < T.THRESHOLD and scores[2] < T.THRESHOLD <= scores[3]


def test_long_labelled_rows_are_learned_from(spark, make_docs):
    """Toxic rows of 100 KB: the only ones there are."""
    rows, labels = _corpus(300)
    pad = "w1 w2 w3. " * 10_000
    long = [(i, pad + t if y else t) for (i, t), (_, _, y) in zip(rows, labels, strict=True)]
    model = T.fit(make_docs(long), _labels(spark, labels))
    got = {r.doc_id: r.predicted for r in T.score_toxicity(make_docs(long), model).collect()}
    held = [(i, y) for i, _, y in labels if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum(got[i] == y for i, y in held) >= 0.9 * len(held)


def test_a_document_with_both_labels_is_toxic(spark, make_docs):
    rows, labels = _corpus(200)
    both = labels + [(i, q, 0) for i, q, y in labels if y]
    a = T.fit(make_docs(rows), _labels(spark, labels))
    b = T.fit(make_docs(rows), _labels(spark, both))
    assert a[:2] == b[:2] and (a.weights == b.weights).all()


def test_no_labels_and_empty_table(spark, make_docs):
    none = _labels(spark, [])
    model = T.fit(make_docs([(1, "a")]), none)
    assert model[:2] == (T.LEAK, T.BIAS) and not model.weights.any()
    one_class = _labels(spark, [(1, 0, 0), (None, 1, 1), (2, 1, None)])
    assert not T.fit(make_docs([(1, "a"), (2, "b")]), one_class).weights.any()
    assert T.score_toxicity(make_docs([]), model).count() == 0
