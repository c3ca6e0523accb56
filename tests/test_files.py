import hashlib
import os

import pytest
from pyspark.sql import functions as F

from feeds import FIRST_RUN, landing
from sparkledger.sources import files as files_module
from sparkledger.sources.files import (distinct_contents, header_columns, list_feed_files,
                                       plan_groups, read_csv_strings, source_key, split_routable)
from sparkledger.sources.manifest import append_manifest, load_manifest, unprocessed

PARKS = "Nr,Firm,Sum\n7,Oak & Sons,12.50\n8,Elm,3\n"


def _put(folder, files):
    os.makedirs(folder, exist_ok=True)
    for name, data in files.items():
        with open(os.path.join(folder, name), "wb") as f:
            f.write(data if isinstance(data, bytes) else data.encode("utf-8"))
    return str(folder)


@pytest.mark.parametrize("path, key", [
    ("hdfs://n/lake/parks_spend_1999_12.csv", "parks"), ("/a/river_trust_spend_q1_spend_2.csv", "river_trust"),
    ("plain.csv", "plain.csv"), ("/x/_spend_2020.csv", "")])
def test_source_key_is_the_text_before_the_marker(spark, path, key):
    df = spark.createDataFrame([(path,)], "p string")
    assert df.select(source_key(F.col("p"))).first()[0] == key


def test_every_kind_of_file_is_listed_and_read_by_its_own_header(spark, tmp_path):
    wide = ",".join(f"column number {i}" for i in range(9000))
    raw = _put(tmp_path / "raw folder", {
        "parks_spend_2026 04.csv": b"\xef\xbb\xbf" + PARKS.encode(),  # BOM, space
        "parks_spend_\u00a3+5%20.csv": PARKS,                           # sign, plus, percent
        "cr_spend_1.csv": "Nr,Firm,FIRM\r1,a,b\r2,c,d\r",              # CR ends, case variants
        "gap_spend_1.csv": "\n   \r\nNr,Firm\r\n5,x\r\n",              # blank first lines
        "wide_spend_1.csv": f"{wide}\n" + ",".join("v" * 9000) + "\n",
        "head_spend_1.csv": "Nr,Firm\n", "void_spend_1.csv": ""})
    files = {r.file_name: r for r in list_feed_files(spark, raw).collect()}
    assert files["void_spend_1.csv"].header == "" and files["void_spend_1.csv"].length == 0
    assert len(files) == 7
    assert files["gap_spend_1.csv"].header == "Nr,Firm"
    assert files["wide_spend_1.csv"].header == wide
    assert files["parks_spend_2026 04.csv"].header == "Nr,Firm,Sum"
    got = {}
    for g in plan_groups(list_feed_files(spark, raw)):
        if not g.header:
            continue
        df = read_csv_strings(spark, list(g.paths), columns=header_columns(g.header))
        for r in df.collect():
            assert r["_corrupt_record"] is None
            got.setdefault(r.source_file.rsplit("/", 1)[-1], []).append(tuple(r)[:3])
    assert got["parks_spend_2026 04.csv"] == got["parks_spend_\u00a3+5%20.csv"] == [
        ("7", "Oak & Sons", "12.50"), ("8", "Elm", "3")]
    assert got["cr_spend_1.csv"] == [("1", "a", "b"), ("2", "c", "d")]
    assert len(got["gap_spend_1.csv"]) == 1 and got["wide_spend_1.csv"] == [("v", "v", "v")]


def test_fingerprint_depends_on_content_alone(spark, tmp_path):
    lines = [f"{i},firm {i % 50},{i}.25" for i in range(30000)]
    big = "Nr,Firm,Sum\n" + "\n".join(lines) + "\n"
    raw = _put(tmp_path / "raw", {
        "a_spend_1.csv": big, "b_spend_other name.csv": big,
        "c_spend_1.csv": big.replace("17.25", "17.26"), "d_spend_1.csv": big[:-2] + "6\n",
        "e_spend_1.csv": big.replace("Firm", "Firn"),
        "f_spend_1.csv": "Nr,Firm,Sum\n" + "\n".join(lines[::-1]) + "\n",
        "g_spend_1.csv": "Nr,Firm,Sum\n" + "\n".join([lines[1], lines[0], *lines[2:]]) + "\n"})
    split = list_feed_files(spark, raw)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")  # many blocks a file
    try:
        cut = {r.file_name: r.file_hash for r in list_feed_files(spark, raw).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    whole = {r.file_name: r.file_hash for r in split.collect()}
    assert cut == whole
    assert whole["a_spend_1.csv"] == whole["b_spend_other name.csv"]
    assert len(set(whole.values())) == 6  # another order of lines is another content


def test_fingerprint_is_the_stated_polynomial(spark, tmp_path):
    """Block by block in the engine, line by line here."""
    lines = ["Nr,Firm", *(f"{i},x{i * i}" for i in range(3000))]
    raw = _put(tmp_path / "raw", {"a_spend_1.csv": "\n".join(lines)})
    hashed = spark.createDataFrame(list(enumerate(lines)), "i int, v string").select(
        "i", *[F.xxhash64(F.lit(lane), "v").alias(f"h{lane}") for lane in (0, 1)]).collect()
    sums = []
    for lane, (modulus, base) in enumerate(files_module._LANES):
        sums.append(sum(r[f"h{lane}"] % modulus * pow(base, r.i, modulus) for r in hashed)
                    % modulus)
    text = "|".join(map(str, [len("\n".join(lines)), len(lines), *sums, lines[0]]))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        got = list_feed_files(spark, raw).first().file_hash
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == hashlib.sha256(text.encode()).hexdigest()


def test_known_files_are_not_read_again(spark, tmp_path):
    """A name of the same size and time stands for what was read; any other is read."""
    raw = _put(tmp_path / "raw", {"parks_spend_1.csv": PARKS, "parks_spend_2.csv": PARKS + "9,Ash,1\n",
                                  "void_spend_1.csv": ""})
    cache = str(tmp_path / "cache")

    def listing():
        return {r.file_name: (r.file_hash, r.header) for r in
                list_feed_files(spark, raw, cache=cache).collect()}

    first = listing()
    kept = sorted(os.listdir(cache))
    one = os.path.join(raw, "parks_spend_1.csv")
    stamp = os.stat(one)
    _put(raw, {"parks_spend_1.csv": PARKS.replace("Oak", "Elk")})
    os.utime(one, ns=(stamp.st_atime_ns, stamp.st_mtime_ns))
    assert listing() == first  # no byte of it was looked at
    assert sorted(os.listdir(cache)) == kept
    os.utime(one, ns=(stamp.st_atime_ns, stamp.st_mtime_ns + 5_000_000_000))
    later = listing()
    assert later["parks_spend_1.csv"] != first["parks_spend_1.csv"]
    assert {k: v for k, v in later.items() if k != "parks_spend_1.csv"} == \
        {k: v for k, v in first.items() if k != "parks_spend_1.csv"}
    assert list_feed_files(spark, raw).select("file_name", "file_hash").collect() != []


def test_listing_needs_no_python_on_the_workers(spark, tmp_path):
    raw = _put(tmp_path / "raw", {"parks_spend_1.csv": PARKS})
    plan = list_feed_files(spark, raw)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan


def test_layouts_are_read_apart_and_unmapped_sources_are_parked(spark, tmp_path):
    raw, _, _ = landing(tmp_path)
    routable, parked = split_routable(list_feed_files(spark, raw), ["cabinet_office", "mod", "dhsc"])
    assert [r.file_name for r in parked.collect()] == ["unknown_spend_2026_04.csv"]
    sizes = {}
    for g in plan_groups(routable):
        sizes.setdefault(g.source, []).append(len(g.paths))
    assert sizes == {"cabinet_office": [1, 1], "dhsc": [1], "mod": [2]}


def test_copies_and_recorded_contents_are_left_out(spark, tmp_path):
    raw = _put(tmp_path / "raw", {"parks_spend_1.csv": PARKS, "parks_spend_2.csv": PARKS,
                                  "parks_spend_3.csv": PARKS + "9,Ash,1\n"})
    files = list_feed_files(spark, raw)
    assert sorted(r.file_name for r in distinct_contents(files).collect()) == [
        "parks_spend_1.csv", "parks_spend_3.csv"]
    path = str(tmp_path / "audit")
    assert load_manifest(spark, path).isEmpty()
    done = files.filter(F.col("file_name") == "parks_spend_2.csv").select(
        F.col("file_name").alias("source_file"), "file_hash", F.lit(2).cast("bigint").alias("rows_valid"),
        F.lit(0).cast("bigint").alias("rows_rejected"), F.current_timestamp().alias("processed_at"))
    append_manifest(done, path)
    left = unprocessed(files, load_manifest(spark, path)).collect()
    assert [r.file_name for r in left] == ["parks_spend_3.csv"]


def test_header_names_are_unique_whatever_their_case():
    assert header_columns('Nr,"Sum, net",Firm') == ["Nr", "Sum, net", "Firm"]
    assert header_columns("k,,K") == ["k0", "_c1", "K2"]
    assert header_columns("") == []
