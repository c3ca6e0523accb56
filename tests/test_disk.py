"""Bytes that rows cost on the way: in shuffles, in staged steps, and how long these stay."""

import glob
import hashlib
import os
import time
from datetime import date, datetime

import pytest
from feeds import landing
from pyspark.sql import functions as F

from sparkledger.functions.hashing import packed_hash, unpacked_hash
from sparkledger.operators import enrich
from sparkledger.operators.enrich import as_lookup, attach_assurance
from sparkledger.operators.keys import keep_latest
from sparkledger.plans import filelane, pipeline, silver
from sparkledger.sources.sinks import shuffles_freed, small_scans, stage

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _hex(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_packed_hashes_come_back_and_keep_their_order(spark):
    hexes = [_hex(str(i)) for i in range(40)]
    others = ["", "h1", "h2", "é", hexes[0].upper(), hexes[0][:-1], hexes[0] + "0", "g" * 64]
    rows = spark.createDataFrame([(t,) for t in [*hexes, *others, None]], "t string")
    packed = rows.select("t", packed_hash("t").alias("p"))
    got = packed.select("t", "p", unpacked_hash("p").alias("back")).collect()
    assert all(r.t == r.back for r in got)
    assert {len(r.p) for r in got if r.t in hexes} == {33}
    for kind in (hexes, others):
        mine = packed.filter(F.col("t").isin(kind)).orderBy("p").collect()
        assert [r.t for r in mine] == sorted(kind, key=lambda t: t.encode())


def test_latest_rows_are_chosen_with_packed_hashes_and_one_copy_of_the_id(spark):
    old, new = datetime(2031, 1, 1), datetime(2031, 1, 2)
    low, high = sorted([_hex("a"), _hex("b")])
    rows = spark.createDataFrame(
        [("k", "d", low, new), ("k", "d", high, new), ("k", "d", "zz" * 32, old),
         (None, "d", low, old), (None, "d", low, new), (None, "d", high, old), ("k", "e", low, old)],
        "transaction_id string, source_department string, record_hash string, ingested_at timestamp")
    kept = keep_latest(rows)
    assert kept.columns == rows.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(
        [("k", "d", high, new), (None, "d", low, new), (None, "d", high, old), ("k", "e", low, old)],
        key=str)
    below = _plan(kept).split("Exchange hashpartitioning")[1]
    assert "unhex" in below and "coalesce" not in _plan(kept).split("Exchange hashpartitioning(")[1] \
        .split(")")[0]


def _shuffle_files(spark):
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    names = env.blockManager().diskBlockManager().getAllBlocks().mkString(" ").split()
    return {n for n in names if "shuffle_" in n and "." not in n.split("shuffle_")[0]}


def test_staging_frees_its_shuffle_files(spark, tmp_path):
    before, was = _shuffle_files(spark), spark.conf.get(CLEANUP, None)
    rows = spark.range(20000).select((F.col("id") % 700).alias("k"), F.uuid().alias("u"))
    held = spark.range(20000).select((F.col("id") % 700).alias("k")).repartition(3, "k")
    assert held.rdd.count() == 20000  # shuffle files that stay: the frame is still here
    assert _shuffle_files(spark) - before
    before = _shuffle_files(spark)
    staged = stage(rows.groupBy("k").agg(F.max("u").alias("u")), "s", scratch=str(tmp_path))
    until = time.time() + 20
    while _shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not _shuffle_files(spark) - before
    assert staged.count() == 700 and spark.conf.get(CLEANUP, None) == was


def test_settings_come_back(spark):
    key = "spark.sql.files.maxPartitionBytes"
    was = spark.conf.get(key, None)
    with pytest.raises(ValueError):
        with small_scans(spark), shuffles_freed(spark):
            assert int(spark.conf.get(key)) == 32 << 20
            raise ValueError
    assert spark.conf.get(key, None) == was
    spark.conf.set(key, "1m")
    try:
        with small_scans(spark):  # never larger than the session's own
            assert int(spark.conf.get(key)) == 1 << 20
        assert spark.conf.get(key) == "1m"
    finally:
        spark.conf.unset(key)


SILVER = ("transaction_id string, source_department string, department_group string, "
          "payment_month string, payment_date date, supplier_name string, "
          "amount_gbp decimal(18,2), vat_amount_gbp decimal(18,2), expense_category string, "
          "needs_review boolean, raw_extras map<string,string>, schema_version string, "
          "source_file string, ingested_at timestamp")


def _assurance(spark):
    from decimal import Decimal
    stamp = datetime(2031, 1, 1)
    rows = spark.createDataFrame(
        [(t, "parks", None, "2031-01", date(2031, 1, 5), name, Decimal("1.50"), None, None, False,
          {}, "v", "f.csv", stamp) for t, name in (("a", "Elm"), ("b", "Oak"), ("c", "Fir"))], SILVER)
    approvals = spark.createDataFrame([("a", "Approved")], "transaction_id string, "
                                                           "processing_status string")
    suppliers = spark.createDataFrame([("Elm", "Low"), ("Oak", "High")],
                                      "supplier_name string, risk_rating string")
    return rows, approvals, suppliers


def test_hashes_of_assured_rows_are_made_after_the_joins(spark, tmp_path):
    rows, approvals, suppliers = _assurance(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = silver.assured_silver(rows, approvals, suppliers, str(tmp_path))
        plan = _plan(got)
        hashed = silver.add_record_hash(rows)
        want = attach_assurance(hashed.select("record_hash", *rows.columns), approvals, suppliers)
        assert got.columns == want.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # rows meet the suppliers without being dealt out by name, and no exchange has a hash below
    assert "hashpartitioning(supplier_name" not in plan and "BroadcastHashJoin" in plan
    assert all("sha2" not in below for below in plan.split("Exchange hashpartitioning")[1:])


def test_rows_that_are_sorted_when_read_are_staged_in_small_files(spark, tmp_path):
    staged = stage(spark.range(25).coalesce(1), "s", None, str(tmp_path), 10)
    assert len(staged.inputFiles()) == 3 and staged.count() == 25
    assert len(stage(spark.range(25).coalesce(1), "s", None, str(tmp_path)).inputFiles()) == 1


def test_a_lookup_is_sent_out_only_while_it_is_small(spark):
    _, _, suppliers = _assurance(spark)
    assert "broadcast" in as_lookup(suppliers)._jdf.queryExecution().logical().toString().lower()
    for df in (as_lookup(suppliers, most=50), as_lookup(suppliers.withColumn("m", F.create_map()))):
        assert "hint" not in df._jdf.queryExecution().logical().toString().lower()
    assert enrich.LOOKUP_BYTES <= 256 << 20


ROW = ("transaction_id string, source_department string, payment_month string, "
       "record_hash string, ingested_at int, amount_gbp int")


def _rows(spark, *rows):
    return spark.createDataFrame([(t, d, m, f"{t}{a}", n, a) for t, d, m, n, a in rows], ROW)


@pytest.mark.parametrize("merge", ["latest", "hash_gated"])
def test_merges_are_staged_a_few_departments_at_a_time(spark, tmp_path, monkeypatch, merge):
    seen = []
    real = pipeline._stage_at
    monkeypatch.setattr(pipeline, "_stage_at",
                        lambda parts, *a: (seen.append(len(parts)), real(parts, *a))[1])
    path, names = str(tmp_path / "t"), [f"d{i}" for i in range(11)]
    first = [(f"k{d}", d, "m1", 1, i) for i, d in enumerate(names)]
    second = [(f"k{d}", d, "m2", 2, 50 + i) for i, d in enumerate(names[:3])] + [("n", "d9", "m3", 2, 9)]
    for batch in (first, second):
        pipeline.upsert_partitions(spark, path, _rows(spark, *batch), merge=merge)
    assert seen == [pipeline.MERGE_SLICES, 4]
    got = spark.read.schema(ROW).parquet(path).collect()
    assert sorted((r.transaction_id, r.source_department, r.payment_month, r.amount_gbp)
                  for r in got) == sorted(
        [(t, d, m, a) for t, d, m, _, a in first[3:] + second])
    # a key without the department may be anywhere: one part
    pipeline.upsert_partitions(spark, path, _rows(spark, ("kd5", "d6", "m1", 3, 99)),
                               keys=["transaction_id"], merge=merge)
    assert seen[2:] == [1]
    assert [(r.source_department, r.amount_gbp) for r in spark.read.schema(ROW).parquet(path)
            .filter("transaction_id = 'kd5'").collect()] == [("d6", 99)]


def test_slices_cover_every_department_once_null_too(spark):
    values = [None, "", "a", "b", "c", "d", "e", "f", "g", "h"]
    parts = [{"source_department": v, "payment_month": m} for v in values for m in ("1", None)]
    slices = pipeline._slices(parts, ["source_department"])
    rows = spark.createDataFrame([(v,) for v in values], "source_department string")
    found = [r[0] for s in slices for r in rows.filter(s).collect()]
    assert len(slices) == pipeline.MERGE_SLICES
    assert sorted(map(str, found)) == sorted(map(str, values))


def test_a_hash_gated_merge_stages_changed_partitions_only(spark, tmp_path, monkeypatch):
    path, merged = str(tmp_path / "t"), str(tmp_path / "merged")
    pipeline.upsert_partitions(spark, path, _rows(spark, ("a", "x", "m1", 1, 1), ("b", "x", "m2", 1, 2),
                                                  ("c", "x", "m3", 1, 3), ("e", "y", "m1", 1, 4)))
    again = _rows(spark, ("a", "x", "m1", 2, 1), ("b", "x", "m4", 2, 7), ("e", "y", "m1", 2, 4))
    change = pipeline.plan_upsert(spark, path, again, merged, merge="hash_gated")
    names = sorted(p.split("merged/")[1] for p in glob.glob(f"{merged}/*/*"))
    assert names == ["source_department=x/payment_month=m4"]
    assert sorted(p["payment_month"] for p in change.touched) == ["m2", "m4"]
    assert [p["payment_month"] for p in change.emptied] == ["m2"]

    def staged(*a):
        raise AssertionError("rows were staged")

    monkeypatch.setattr(pipeline, "_stage_at", staged)
    same = _rows(spark, ("a", "x", "m1", 3, 1), ("e", "y", "m1", 3, 4))
    assert pipeline.plan_upsert(spark, path, same, merged, merge="hash_gated").touched == []


def test_a_run_keeps_only_the_step_it_reads(spark, tmp_path, monkeypatch):
    from sparkledger.session import ensure_checkpoint_dir
    base = ensure_checkpoint_dir(spark).replace("file:", "")
    before, seen = set(glob.glob(f"{base}/run-*")), []

    def left():
        new = set(glob.glob(f"{base}/run-*")) - before
        return {n.split("-")[0] for d in new for n in os.listdir(d)} & {
            "rows", "tagged", "silver", "incoming"}

    plan, assured, apply = pipeline.plan_upsert, pipeline.assured_silver, pipeline._apply
    monkeypatch.setattr(pipeline, "assured_silver", lambda *a: (seen.append(left()), assured(*a))[1])
    monkeypatch.setattr(pipeline, "plan_upsert", lambda *a, **k: (seen.append(left()), plan(*a, **k))[1])
    monkeypatch.setattr(pipeline, "_apply", lambda *a: (seen.append(left()), apply(*a))[1])
    raw, ref, out = landing(tmp_path)
    pipeline.run_batch(spark, raw, ref, out, batch_ts=datetime(2026, 6, 1, 9))
    assert seen == [{"silver"}, {"incoming"}, set()]
    rows = pipeline.read_layer(spark, out, "silver").collect()
    assert {len(r.record_hash) for r in rows} == {64}


def test_reference_files_are_compressed_and_none_is_long(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([(f"t{i}", f"c, \"{i}\"", None) for i in range(25)],
                                 "transaction_id string, cost_centre string, approver string").coalesce(1)
    for name in ("approvals_ledger", "supplier_reference"):
        monkeypatch.setattr(filelane, name, lambda *_: rows)
    monkeypatch.setattr(filelane, "REFERENCE_FILE_ROWS", 10)
    filelane.write_reference_files(spark, "none", str(tmp_path))
    parts = glob.glob(f"{tmp_path}/approvals_ledger.csv/part-*")
    assert len(parts) == 3 and all(p.endswith(".csv.gz") for p in parts)
    back = pipeline.read_csv_strings(spark, f"{tmp_path}/approvals_ledger.csv").drop("source_file")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))


def _tagged(spark):
    rows = spark.createDataFrame(
        [(t, "oak", "05/04/1998", amount, "IT", None, {"Grant Ref": "g"}, "asia",
          "asia_spend_1998_04.csv", "v", datetime(year, 4, 5))
         for t, amount, year in (("a", "1.00", 1998), ("a", "2.00", 1999), ("b", "3.00", 1998),
                                 ("c", "junk", 1999))],
        "transaction_id string, supplier_name string, payment_date string, amount string, "
        "expense_category string, vat_amount string, raw_extras map<string,string>, "
        "source_department string, source_file string, schema_version string, "
        "ingested_at timestamp_ntz")
    return silver.tag_rejections(silver.typed(rows, {"asia": "region"}))


@pytest.mark.parametrize("query", ["upsert_latest", "upsert_hash_gated", "upsert_writer"])
def test_upsert_batches_are_staged_without_hashes_and_removed(spark, monkeypatch, query):
    from sparkledger.plans import catalog
    from sparkledger.session import ensure_checkpoint_dir
    monkeypatch.setattr(catalog.S, "ledger_tagged", lambda *_: _tagged(spark))
    base, staged, real = ensure_checkpoint_dir(spark).replace("file:", ""), [], catalog.stage
    monkeypatch.setattr(catalog, "stage", lambda df, *a, **k: (staged.append(df.columns),
                                                               real(df, *a, **k))[1])
    before = set(os.listdir(base)) if os.path.isdir(base) else set()
    rows = catalog.queries()[query](spark, "none").collect()
    assert sorted((r.transaction_id, str(r.amount_gbp)) for r in rows) == [("a", "2.00"),
                                                                          ("b", "3.00")]
    assert [r.record_hash for r in rows if r.transaction_id == "a"] == [
        _hex("a|asia|1998-04-05|2.00")]
    assert staged and not [c for columns in staged for c in columns if c == "record_hash"]
    if query == "upsert_writer":
        assert {n.rsplit("-", 1)[0] for n in set(os.listdir(base)) - before} == {"upsert-table"}
