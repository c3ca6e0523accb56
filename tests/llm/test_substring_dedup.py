"""Repeated word windows against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

from sparkledger.llm import kernels as K
from sparkledger.llm import sketches, substring_dedup


def _brute(rows, n):
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", t or "") for i, t in rows}
    seen, out = set(), {}
    for i in sorted(words):
        w, gone = words[i], set()
        for p in range(len(w) - n + 1):
            g = tuple(w[p:p + n])
            if g in seen:
                gone.update(range(p, p + n))
            seen.add(g)
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out[i] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept)
    return out


def _rows(prose):
    rng = random.Random(6)
    passages = [prose(900 + i, 30) for i in range(4)]
    rows = []
    for i in range(60):
        parts = [prose(i, rng.randrange(50))]
        for _ in range(rng.randrange(3)):
            parts += [rng.choice(passages), prose(1000 * i + rng.randrange(9), rng.randrange(9))]
        rows.append((i * 7 % 61, "  ".join(parts)))
    return [*rows, (100, None), (101, ""), (102, "x " * 75), (103, "a b \x0b\x1c c")]


def test_matches_brute_force(spark, make_docs, prose):
    rows = _rows(prose)
    want = _brute(rows, 20)
    got = substring_dedup.remove_repeats(make_docs(rows), with_text=True).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256, r.kept) for r in got} == want
    assert any(w[1] for w in want.values())


def test_full_sketch_loses_nothing(spark, make_docs, prose, monkeypatch):
    # every estimate is high: the exact pass alone decides
    monkeypatch.setattr(substring_dedup, "repeated", lambda h, bits: np.ones(len(h), bool))
    rows = _rows(prose)
    got = substring_dedup.remove_repeats(make_docs(rows)).collect()
    assert {r.doc_id: r.n_removed for r in got} == {i: w[1] for i, w in _brute(rows, 20).items()}


def test_anchor_is_the_leftmost_minimum():
    rng = np.random.default_rng(3)
    grams = rng.integers(0, 6, 200).astype(np.uint64)  # many ties
    for span in (1, 2, 9, 13):
        assert substring_dedup.anchors(grams, span).tolist() == [
            p + int(np.argmin(grams[p:p + span])) for p in range(len(grams) - span + 1)]


@pytest.mark.parametrize("expected, share", [(6667, 0.4), (1, 1.1), (10**7, 0.34)])
def test_sketch_never_underestimates(spark, expected, share):
    h = K.stream(1, 5000)
    twice = [h, h[::3]]
    data = spark.createDataFrame([(i,) for i in range(2)], "n int").repartition(2)
    seen = sketches.sketch(data, lambda batches: (
        twice[n] for b in batches for n in b.column("n").to_pylist()), expected)
    assert len(seen) == sketches.DEPTH << (sketches.cell_bits(expected) - 3)
    high = sketches.repeated(h, seen)
    assert high[::3].all() and high.mean() < share


def test_sketch_size_follows_the_input_up_to_a_bound():
    bits = [sketches.cell_bits(n) for n in (0, 100, 10**5, 10**6, 10**12)]
    assert bits[0] == bits[1] == sketches.RANGE_BITS
    assert bits[2] < bits[3] < bits[4] == sketches.MOST_CELL_BITS


def test_missing_ids_and_empty_table(spark, make_docs, prose):
    t = prose(1, 40)
    got = substring_dedup.remove_repeats(make_docs([(None, t), (3, t), (4, t)])).collect()
    assert {r.doc_id: r.n_removed for r in got} == {3: 0, 4: 40, None: 40}
    assert substring_dedup.remove_repeats(make_docs([])).count() == 0
