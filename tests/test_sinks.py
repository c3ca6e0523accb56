"""Bytes that a lake's writes cost: staged partitions are moved, not written again."""

import glob
import os

import pyarrow.parquet as pq
import pytest

from sparkledger.plans import pipeline
from sparkledger.sources.sinks import move_partitions, replace_table, stage, write_partitions

SCHEMA = ("transaction_id string, source_department string, payment_month string, "
          "record_hash string, ingested_at int, amount_gbp int")


def _rows(spark, *rows):
    return spark.createDataFrame([(t, d, m, f"{t}{a}", n, a) for t, d, m, n, a in rows], SCHEMA)


def _read(spark, path):
    return sorted((r.transaction_id, r.source_department, r.payment_month, r.amount_gbp)
                  for r in spark.read.schema(SCHEMA).parquet(path).collect())


def test_a_latest_merge_is_put_in_place_without_writing_its_rows_again(spark, tmp_path, monkeypatch):
    def again(*args, **kw):
        raise AssertionError("rows were written again")

    monkeypatch.setattr(pipeline, "write_partitions", again)
    path = str(tmp_path / "silver")
    pipeline.upsert_partitions(spark, path, _rows(
        spark, ("a", "parks=1", "2031-04", 1, 10), ("b", "roads", None, 1, 20),
        ("c", "roads", "2031-05", 1, 30)))
    pipeline.upsert_partitions(spark, path, _rows(spark, ("a", "parks=1", "2031-06", 2, 11),
                                                  ("b", "roads", None, 2, 21)))
    assert _read(spark, path) == [("a", "parks=1", "2031-06", 11), ("b", "roads", None, 21),
                                  ("c", "roads", "2031-05", 30)]
    # the month that was left empty is gone, and nothing of the staged merge stays behind
    assert len(glob.glob(f"{path}/*/*")) == 3


def test_a_hash_gated_merge_writes_no_notes_into_the_table(spark, tmp_path):
    path = str(tmp_path / "silver")
    first = _rows(spark, ("a", "parks", "2031-04", 1, 10))
    pipeline.upsert_partitions(spark, path, first, merge="hash_gated")
    pipeline.upsert_partitions(spark, path, _rows(spark, ("a", "parks", "2031-04", 2, 11)),
                               merge="hash_gated")
    assert sorted(spark.read.parquet(path).columns) == sorted(first.columns)


@pytest.mark.parametrize("torn", [False, True])
def test_moving_can_be_done_again(spark, tmp_path, torn):
    table, staged = str(tmp_path / "t"), str(tmp_path / "staged")
    write_partitions(_rows(spark, ("a", "x", "m1", 1, 1), ("b", "x", "m2", 1, 2)), table,
                     ["source_department", "payment_month"])
    write_partitions(_rows(spark, ("a", "x", "m1", 2, 5)), staged,
                     ["source_department", "payment_month"])
    if torn:  # died after the old folder had gone
        os.rename(f"{table}/source_department=x/payment_month=m1", str(tmp_path / "gone"))
    for _ in range(2):
        move_partitions(spark, staged, table, 2)
        assert [(t, a) for t, _, _, a in _read(spark, table)] == [("a", 5), ("b", 2)]


def test_written_files_are_compressed_well(spark, tmp_path):
    df = _rows(spark, ("a", "x", "m1", 1, 1))
    write_partitions(df, str(tmp_path / "w"), ["source_department"])
    replace_table(df, str(tmp_path / "r"))
    stage(df, "s", scratch=str(tmp_path / "staged"))
    files = glob.glob(f"{tmp_path}/**/*.parquet", recursive=True)
    kinds = [pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files
             if pq.ParquetFile(f).metadata.num_row_groups]
    assert kinds == ["ZSTD"] * 3
