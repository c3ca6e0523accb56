"""Base scores against plain counting; the filter against the true counts."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from sparkledger.llm import lm_score


def _brute(rows):
    low = {i: "".join(c.lower() if c.isascii() else c for c in t or "") for i, t in rows}
    tokens = {i: [*re.findall(r"[^\x20\x09-\x0D]+", t), None] for i, t in low.items()}
    out = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    c = Counter(w for i, t in tokens.items() if not out[i] for w in t)
    n, v = sum(c.values()), len(c)
    return {i: (out[i], len(t), sum(c[w] > 0 for w in t), n,
                pytest.approx(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), rel=1e-9))
            for i, t in tokens.items()}


def _rows(prose):
    return [(i, prose(i, 5 + i, 60 + 40 * (i % 7))) for i in range(60)] + [
        (100, None), (101, ""), (102, "É new\tWORD w1 W1"), (None, "w1 w2")]


@pytest.mark.parametrize("hot", [1, 30, lm_score.HOT_WORDS])
def test_base_scores(spark, make_docs, prose, monkeypatch, hot):
    monkeypatch.setattr(lm_score, "HOT_WORDS", hot)
    rows = _rows(prose)
    got = lm_score.score_documents(make_docs(rows)).collect()
    assert {r.doc_id: (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score)
            for r in got} == _brute(rows)
    assert all(r.score <= 0 for r in got)


def test_pairs_beat_words_on_held_out_text(spark, make_docs):
    chain = {i: f"a{i}" for i in range(40)}
    rows = [(i, " ".join(chain[(i + k) % 40] for k in range(30))) for i in range(100)]
    got = [r for r in lm_score.score_documents(make_docs(rows)).collect() if r.held_out]
    assert got and all(r.score > r.base_score for r in got)


def test_filter_levels(spark):
    rng = np.random.default_rng(0)
    text = " ".join(f"w{int(x)}" for x in rng.zipf(1.4, 20000) % 5000)
    docs = spark.createDataFrame([(text,)], "text string")
    model, words = lm_score.fit(docs)
    rows = words.collect()
    hashes = np.array([r.hash for r in rows]).view(np.uint64)
    true = lm_score.levels_of(np.array([r.n for r in rows]))
    read = model.levels(hashes)
    assert (read >= true).all() and (read == true).mean() > 0.95
    absent = lm_score.K.stream(5, 20000)
    assert (model.levels(absent) == 0).mean() > 0.95
    assert model.tokens == 20001 == sum(r.n for r in rows)


def test_nothing_to_learn_from(spark, make_docs):
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2][:3]
    got = lm_score.score_documents(make_docs([(i, "a b") for i in held])).collect()
    assert [(r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got] \
        == [(True, 3, 0, 0, 0.0)] * 3
    assert lm_score.score_documents(make_docs([])).count() == 0


def test_repeated_rows_are_scored_one_by_one(spark, make_docs):
    rows = [(1, "a b c"), (1, "a b c"), (1, "z")]
    got = lm_score.score_documents(make_docs(rows)).collect()
    assert sorted(r.n_tokens for r in got) == [2, 4, 4]


@pytest.mark.parametrize("run", [1, 5000, lm_score.RUN])
def test_a_filter_too_large_to_broadcast_reads_the_same(spark, make_docs, monkeypatch, run):
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(f"w{int(x)}" for x in rng.integers(0, 30000, 900)))
            for i in range(100)] + [(200, None), (201, ""), (None, "w1 w2"), (1, "w1 w2")]
    docs = make_docs(rows)

    def scores():
        return sorted((r.doc_id or -1, r.n_tokens, r.n_known, r.base_score, r.score)
                      for r in lm_score.score_documents(docs).collect())

    whole = scores()
    monkeypatch.setattr(lm_score, "MAX_FILTER_BITS", 1 << 18)
    monkeypatch.setattr(lm_score, "RUN", run, raising=False)
    cut = scores()
    assert [x[:3] for x in cut] == [x[:3] for x in whole]
    assert np.allclose([x[3:] for x in cut], [x[3:] for x in whole], rtol=1e-9)


def test_bits_per_token_are_the_same_at_every_size():
    for tokens in (10**6, 10**8, 4 * 10**9, 10**12):
        segment_bits, size = lm_score._layout(tokens)
        assert size <= lm_score.MAX_SEGMENT
        assert (size << segment_bits) / tokens == pytest.approx(lm_score.BITS_PER_TOKEN, rel=0.03)


def test_small_filters_are_not_broadcast(spark, make_docs):
    """One path at every size, and a run is sent once, not through its segments."""
    got = lm_score.score_documents(make_docs([(1, "a b c"), (2, "a b")]))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") >= 4
    assert got.count() == 2


def test_steps_and_planes():
    rng = np.random.default_rng(3)
    shorts = np.unique(rng.integers(0, 2**32, 500, dtype=np.uint64)).astype(np.uint32)
    assert (lm_score._of_steps(lm_score._steps(shorts)) == shorts).all()
    assert len(lm_score._of_steps(lm_score._steps(shorts[:0]))) == 0
    counts = rng.integers(0, 2**50, 100)
    assert (lm_score._of_planes(lm_score._planes(counts), np.int64) == counts).all()


def test_marks_tell_runs_apart():
    a, b = lm_score.K.stream(1, 50), lm_score.K.stream(2, 50)
    assert lm_score._mark(a) == lm_score._mark(a[::-1]) != lm_score._mark(b)


def test_sorted_hashes_are_distinct():
    hashes = lm_score.K.stream(4, 300)[np.random.default_rng(4).integers(0, 300, 2000)]
    assert (lm_score._sorted(hashes) == np.unique(hashes)).all()
    assert len(lm_score._sorted(hashes[:0])) == 0
