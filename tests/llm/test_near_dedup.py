"""Near-duplicates against brute force."""

import random

import numpy as np

from sparkledger.llm import near_dedup as N


def _shingles(text):
    w = [x for x in "".join(c.lower() if c.isascii() else c for c in text or "").split()]
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def _brute(rows):
    sets = {i: _shingles(t) for i, t, *_ in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 75 * len(sets[a] | sets[b]):
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    return {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}


def _rows(prose):
    rng = random.Random(2)
    rows, n = [], 0
    for g in range(12):
        words = prose(g, 60 + 20 * g).split()
        for _ in range(8):
            copy = list(words)
            for _ in range(rng.randrange(5)):
                copy[rng.randrange(len(copy))] = f"edit{rng.randrange(999)}"
            rows.append((n, " ".join(copy)))
            n += 3
    rows += [(1, None), (2, ""), (4, " \t\n"), (5, "one two"), (7, "One  TWO"), (8, "two one"),
             (10, "w1 w2 w3 w4 w5"), (11, "w1 w2 w3 w4"), (1000, rows[0][1].upper())]
    return rows


def test_matches_brute_force(spark, make_docs, prose):
    rows = _rows(prose)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept)
           for r in N.near_duplicates(make_docs(rows)).collect()}
    assert got == _brute(rows)


def test_chain_is_one_component(spark, make_docs, prose):
    # each text is close to the next one only
    words = prose(77, 100).split()
    rows = []
    for i in range(10):
        rows.append((i, " ".join(words)))
        words = words[:10 * i] + [f"n{i}x{k}" for k in range(2)] + words[10 * i + 2:]
    got = {r.doc_id: r.component_id for r in N.near_duplicates(make_docs(rows)).collect()}
    assert got == {i: v[1] for i, v in _brute(rows).items()}


def test_superminhash_estimates_similarity(prose):
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**63, 3000).astype(np.uint64)
    for share in (0.2, 0.5, 0.8):
        n = 400
        common = int(2 * n * share / (1 + share))
        a, b = pool[:n], np.concatenate([pool[:common], pool[1000:1000 + n - common]])
        s = N.superminhash(np.concatenate([a, b]), np.array([0, n, 2 * n]), 256)
        assert abs((s[0] == s[1]).mean() - common / (2 * n - common)) < 0.1
    one = N.superminhash(pool[:1], np.array([0, 1]), 112)
    assert sorted((one[0] >> np.uint64(57)).tolist()) == list(range(112))  # a permutation


def test_links_of_texts_under_one_id(spark, make_docs, prose):
    """Each text of a repeated doc_id keeps its own links."""
    x, y = prose(31, 80), prose(32, 80)
    rows = [(1, x), (1, y), (2, x + " w1"), (3, y + " w2"), (4, prose(33, 80))]
    got = sorted((r.doc_id, r.component_id, r.kept) for r in
                 N.near_duplicates(make_docs(rows)).collect())
    assert got == [(1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False), (4, 4, True)]


def test_missing_ids_repeated_rows_and_empty_table(spark, make_docs, prose):
    t = prose(3, 50)
    got = N.near_duplicates(make_docs([(None, t), (5, t), (5, t), (9, t)])).collect()
    assert sorted(((r.doc_id, r.component_id, r.kept) for r in got), key=str) == sorted(
        [(None, None, True), (5, 5, True), (5, 5, True), (9, 5, False)], key=str)
    assert N.near_duplicates(make_docs([])).count() == 0
    kept = N.keep_one(make_docs([(None, t), (5, t), (9, t), (3, "")]))
    assert sorted(kept.toPandas().doc_id.fillna(-1)) == [-1, 3, 5]


def test_texts_are_not_dealt_out_to_find_the_wanted_ones(spark, make_docs, prose, monkeypatch):
    """Full sets come from where the texts are read, however many classes are wanted."""
    plans, stage = [], N.staged
    monkeypatch.setattr(N, "staged", lambda df, name: (plans.append(
        (name, df._jdf.queryExecution().executedPlan().toString())), stage(df, name))[1])
    monkeypatch.setattr(N, "BLOCK", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = _rows(prose)
        got = {r.doc_id: (r.n_shingles, r.component_id, r.kept)
               for r in N.near_duplicates(make_docs(rows)).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == _brute(rows)
    sets = [plan for name, plan in plans if name == "sets"]
    assert sets and not any("Exchange" in plan for plan in sets)


def test_filter_lets_all_wanted_through(spark):
    ids = spark.range(5000).selectExpr("xxhash64(id) AS hash")
    bits = N.bit_filter(ids)
    hashes = np.array([r.hash for r in ids.collect()]).view(np.uint64)
    assert N.maybe_held(hashes, bits).all()
    assert N.maybe_held(N.K.stream(9, 5000), bits).mean() < 0.05
    assert not N.maybe_held(hashes, N.bit_filter(ids.limit(0))).any()
