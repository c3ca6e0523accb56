"""Contamination against brute force, in one and in several benchmark batches."""

import random
import re

import pytest

from sparkledger.llm import decontaminate as D


def _words(t):
    low = "".join(c.lower() if c.isascii() else c for c in t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def _brute(rows, items):
    windows = {}
    for i, t in items:
        w = _words(t)
        n = min(len(w), 13)
        for p in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[p:p + n]), set()).add(str(i))
    out = {}
    for i, t in rows:
        w, hit, names = _words(t), set(), set()
        for n in {len(g) for g in windows}:
            for p in range(len(w) - n + 1):
                if (g := tuple(w[p:p + n])) in windows:
                    hit.update(range(p, p + n))
                    names |= windows[g]
        out[i] = (len(w), len(hit), sorted(names), bool(hit) and 20 * len(hit) >= len(w))
    return out


def _case(prose):
    rng = random.Random(7)
    items = [(i, prose(500 + i, rng.choice((12, 13, 14, 40)), 3000)) for i in range(15)]
    items += [(20, "Short One"), (21, "é"), (22, None), (23, " .,"), (24, "a a a"),
              (25, items[0][1])]
    rows = []
    for i in range(40):
        _, t = rng.choice(items[:15])
        w = t.split()
        a = rng.randrange(len(w))
        rows.append((i, ", ".join([prose(i, rng.randrange(300)), *w[a:a + rng.randrange(30)],
                                   prose(i + 99, rng.randrange(9))])))
    rows += [(50, None), (51, ""), (52, "x short-ONE y"), (53, "É é"), (54, "a A a a b"),
             (55, items[3][1].upper()), (56, items[4][1]), (57, "short")]
    return rows, items


@pytest.mark.parametrize("batch", [1 << 24, 400])
def test_matches_brute_force(spark, make_docs, prose, batch):
    rows, items = _case(prose)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = D.find_contamination(make_docs(rows), bench, batch_bytes=batch).collect()
    want = _brute(rows, items)
    assert {r.doc_id: (r.n_words, r.n_hit, list(r.items), r.contaminated) for r in got} == want
    kept = D.without_contaminated(make_docs(rows), bench, batch_bytes=batch)
    assert kept.columns == make_docs(rows).columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(
        i for i, w in want.items() if not w[3])


def test_longest_match(spark, make_docs):
    bench = spark.createDataFrame([(1, "a b c d")], "item_id long, text string")
    tests = D.benchmark_suffixes(["1"], ["a b c d"])
    block = D.K.text_block(D.pa.RecordBatch.from_pydict({"text": ["x a b c y", "a b c d"]}),
                           "text")
    found = D.K.find_words(block, D.K.ALNUM)
    words = D.K.hash_words(block.data, found, D.K.byte_codes(D._SEED, True))
    longest, which, place = D.search(words[:5], found.offsets[:2], tests)
    assert longest.tolist() == [3] and not len(which)
    longest, which, place = D.search(words, found.offsets, tests)
    assert longest.tolist() == [4] and place.tolist() == [5]
    (row,) = D.find_contamination(make_docs([(1, "a b c d e")]), bench).collect()
    assert row.longest == 4


def test_missing_values_and_empty_tables(spark, make_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    bench = spark.createDataFrame([(None, "q r s")], "item_id long, text string")
    docs = make_docs([(None, "q r s"), (1, "q r s"), (1, "q r s")])
    assert [r.n_hit for r in D.find_contamination(docs, none).collect()] == [0, 0, 0]
    assert [list(r.items) for r in D.find_contamination(docs, bench).collect()] == [[""]] * 3
    assert D.find_contamination(make_docs([]), bench).count() == 0


@pytest.mark.parametrize("batch", [1 << 24, 200])
def test_longest_matches_and_places(spark, make_docs, prose, batch):
    """Against growing every common word by word."""
    items = [(i, prose(900 + i, 40)) for i in range(6)]
    rows = []
    for i in range(12):
        w = items[i % 6][1].split()
        rows.append((i, " ".join([prose(i, 5), *w[i:i + 13 + 2 * i], prose(i + 50, 4), *w[:14]])))
    want = {}
    for d, text in rows:
        w, found = _words(text), set()
        for i, t in items:
            v = _words(t)
            for a in range(len(w)):
                for b in range(len(v)):
                    if a and b and w[a - 1] == v[b - 1]:
                        continue
                    n = 0
                    while a + n < len(w) and b + n < len(v) and w[a + n] == v[b + n]:
                        n += 1
                    if n >= 13:
                        found.add((str(i), b, a, n))
        want[d] = found
    got = D.find_contamination(make_docs(rows), spark.createDataFrame(
        items, "item_id long, text string"), batch_bytes=batch).collect()
    assert {r.doc_id: {tuple(m) for m in r.matches} for r in got} == want
    assert {r.doc_id: r.longest for r in got} == {
        d: max((m[3] for m in f), default=0) for d, f in want.items()}


def test_clashing_columns(spark, make_docs):
    bench = spark.createDataFrame([(1, "q r s")], "item_id long, text string")
    docs = make_docs([(1, "q r s"), (2, "t")]).selectExpr("*", "7 AS _hits", "8 AS _n_words",
                                                         "9 AS n_hit", "1 AS found")
    kept = D.without_contaminated(docs, bench)
    assert kept.columns == docs.columns and [r._hits for r in kept.collect()] == [7]
