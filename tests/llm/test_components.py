import random

from sparkledger.llm import components as module
from sparkledger.llm.components import components, joined


def test_matches_union_find(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(100, 130)] + [(200, i) for i in range(201, 260)]
    links += [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    links += [(1, 1), (None, 2), (3, None), (101, 100)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    got = {r.node: r.component for r in
           components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_rounds_deal_edges_out_once(spark, monkeypatch):
    # a star round shuffles for the smallest neighbours only, and never gives more rows
    plans = []
    stage = module.staged

    def watched(df, name):
        plans.append((name, df._jdf.queryExecution().optimizedPlan().toString()))
        return stage(df, name)

    monkeypatch.setattr(module, "staged", watched)
    links = [(i, i + 1) for i in range(20)] * 2
    got = {(r.node, r.component) for r in
           components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {(i, 0) for i in range(21)}
    assert not [p for name, p in plans if name == "links" and "Aggregate" in p]


def test_joined_sends_only_new_links_through(spark, monkeypatch):
    found = spark.createDataFrame([(1, 1), (5, 1), (9, 1), (2, 2), (4, 2), (7, 7), (8, 7)],
                                  "node long, component long")
    sent = []
    whole = module.components
    monkeypatch.setattr(module, "components",
                        lambda links: sent.append(links.count()) or whole(links))
    links = spark.createDataFrame([(2, 1), (1, 2), (3, 2), (20, 21)], "a long, b long")
    got = sorted(map(tuple, joined(found, links).collect()))
    assert got == [(1, 1), (2, 1), (3, 1), (4, 1), (5, 1), (7, 7), (8, 7), (9, 1), (20, 20),
                   (21, 20)]
    assert sent == [4]
    none = spark.createDataFrame([], "a long, b long")
    assert sorted(map(tuple, joined(found, none).collect())) == sorted(map(tuple, found.collect()))
