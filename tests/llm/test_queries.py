"""Registered queries against their SQL on the driver tables, and the whole pipeline."""

import hashlib
import os
import re

import duckdb
import pytest
import test_decontaminate
import test_mixing
import test_near_dedup
import test_toxicity

import corpus_pipeline
from sparkledger.llm import pii, registry, toxicity
from sparkledger.llm.common import staged, table
from tools.check_oracle import digest

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    yield con
    con.close()


def test_one_query_for_each_operator():
    assert [int(n[2:].split("_")[0]) for n in registry.queries()] == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near_dedup", "decontamination", "pii", "mixing"]


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    df = registry.queries()[name](spark, SF_DIR)
    want = duck.sql(registry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    rows, expected = [tuple(r) for r in df.collect()], want.fetchall()
    assert len(rows) == len(expected)
    assert digest(df.columns, rows)[0] == digest(want.columns, expected)[0]


def _plain_stages(spark):
    """doc_id -> (text, words taken) of the whole pipeline, by loops."""
    rows = {r.doc_id: r for r in table(spark, SF_DIR, "documents").collect()}
    model = toxicity.fit(table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels"))
    kept = [(i, r.text) for i, r in rows.items()
            if test_toxicity._plainly(r.text, model) < toxicity.THRESHOLD]
    groups = test_near_dedup._brute(kept)
    kept = [(i, t) for i, t in kept if groups[i][2]]
    items = [(r.item_id, r.text) for r in table(spark, SF_DIR, "benchmark").collect()]
    found = test_decontaminate._brute(kept, items)
    out, sizes = {}, {}
    for i, text in kept:
        if found[i][3]:
            continue
        spans = sorted((x for found_ in pii.find_spans(text or "") for x in found_),
                       key=lambda x: (x[0], x[2]))
        text = pii.mask(text, [{"start": a, "end": b, "kind": pii.KINDS[k]} for a, b, k in spans]) \
            if spans else text
        out[i] = text
        source = rows[i].source
        sizes[source] = sizes.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    targets = test_mixing._targets(sizes)
    taken = {}
    for source, size in sizes.items():
        epochs = int(targets[source] // size) if size else 0
        left = int(targets[source] - epochs * size)
        for i in sorted((i for i in out if rows[i].source == source),
                        key=lambda i: hashlib.md5(f"mix:{i}".encode()).hexdigest()):
            own = len(re.findall(r"[^\x20\x09-\x0D]+", out[i] or ""))
            taken[i] = epochs * own + min(own, left)
            left -= min(own, left)
    return {i: (out[i], taken[i]) for i in out}


def test_pipeline_stages(spark):
    docs = table(spark, SF_DIR, "documents")
    columns, before = docs.columns, docs.count()
    counts = []
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, SF_DIR), f"test-{name}")
        counts.append(docs.count())
        if name != "mixing":
            assert docs.columns == columns
    assert before > counts[0] >= counts[1] >= counts[2] == counts[3] == counts[4] > 0
    assert docs.columns[:len(columns)] == columns
    assert {r.doc_id: (r.text, r.taken) for r in docs.collect()} == _plain_stages(spark)
    sources = {}
    for r in docs.collect():
        have = sources.setdefault(r.source, [r.target, 0])
        have[1] += r.taken
        assert r.taken <= 3 * r.size
    assert all(abs(taken - target) < 1 for target, taken in sources.values())
