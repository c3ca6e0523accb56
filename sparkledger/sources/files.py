"""Feed files: listing, content fingerprints, routing, header grouping and CSV scans.

Listing reads names, sizes and times only. What it finds is anti-joined with the
fingerprints kept from earlier runs, so content is read once in a file's life, by one text
pass whose aggregates combine inside the JVM. Files are then grouped by (source, header) so
each group is read by ONE multi-file CSV scan (never one plan per file, and never applying
one file's header to a file with a different layout).
"""

from __future__ import annotations

import csv
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkledger.operators.conform import conform, union_all_by_name
from sparkledger.operators.keys import keep_one
from sparkledger.sources.storage import path_exists

SPEND_MARKER = "_spend_"


def plain_path(path: Column) -> Column:
    """``_metadata.file_path`` with its URL escapes undone: the file's own name. An empty
    authority (``file:///``) is written as none."""
    plain = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(plain, "^([A-Za-z][A-Za-z0-9+.-]*):///", "$1:/")


def source_key(path: Column) -> Column:
    """File basename text before the first ``_spend_``; the whole basename without it."""
    return F.element_at(F.split(base_name(path), SPEND_MARKER, 2), 1)


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def stem(path: Column) -> Column:
    """Basename without its last extension (``mod_spend_2026_05.csv`` -> ``mod_spend_2026_05``)."""
    return F.regexp_replace(base_name(path), r"\.[^.]*$", "")


#: A line's number is taken apart into digits of this many bits; a power of a base is the
#: product of one table entry a digit.
_DIGIT_BITS = 10
_DIGITS = 4
#: (modulus, base): two polynomials over line hashes. Both moduli are primes below 2**31, so
#: that products stay below 2**62.
_LANES = ((2147483647, 1103515245), (2147483629, 362436069))


def _times(a: Column, b: Column, modulus: int) -> Column:
    return F.pmod(a * b, F.lit(modulus).cast("long"))


def _power(base: int, exponent: Column, modulus: int) -> Column:
    """base ** exponent, modulo ``modulus``, for exponents below 2**40."""
    mask = (1 << _DIGIT_BITS) - 1
    out = None
    for digit in range(_DIGITS):
        step = pow(base, 1 << (_DIGIT_BITS * digit), modulus)
        entries, entry = [], 1
        for _ in range(mask + 1):
            entries.append(entry)
            entry = entry * step % modulus
        at = F.shiftright(exponent, _DIGIT_BITS * digit).bitwiseAND(F.lit(mask).cast("long"))
        # one literal, folded to an array of numbers when the plan is optimised
        table = F.split(F.lit(",".join(map(str, entries))), ",").cast("array<bigint>")
        found = F.get(table, at.cast("int"))
        out = found if out is None else _times(out, found, modulus)
    return out


def file_lines(text: DataFrame) -> DataFrame:
    """The lines of a text scan (batch or stream) with what listing needs of their file.

    The text reader splits lines as the CSV reader does (LF, CRLF or CR) and drops a BOM."""
    meta = F.col("_metadata")
    return text.select("value", meta["file_path"].alias("path"),
                       meta["file_block_start"].alias("block"),
                       meta["file_size"].alias("length"),
                       meta["file_modification_time"].alias("modified"))


def describe_files(lines: DataFrame) -> DataFrame:
    """``file_lines`` -> path, file_name, source_key, length, modified, file_hash, header.

    ``file_hash`` is a fingerprint of the content alone: size, number of lines, header, and
    two polynomials of the line hashes in the order of the lines. A block's polynomial is
    a sum, so it aggregates map-side; multiplied by the power of the lines before the block,
    blocks add up to the file's, however the file was split. A renamed copy has the same
    fingerprint; a file whose lines are in another order has not. ``header`` is the whole
    first line that is not blank, as the CSV reader takes it."""
    value = F.col("value")
    # consecutive within a task, in line order; the first line of a block is taken off below
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    numbered = lines.withColumn("_row", row)
    term = {}
    for lane, (modulus, base) in enumerate(_LANES):
        hashed = F.pmod(F.xxhash64(F.lit(lane), value), F.lit(modulus).cast("long"))
        term[f"sum{lane}"] = _times(hashed, _power(base, F.col("_row"), modulus), modulus)
    filled = F.when(F.trim(value) != "", F.col("_row"))
    blocks = numbered.groupBy("path", "block").agg(
        F.max("length").alias("length"), F.max("modified").alias("modified"),
        F.count(F.lit(1)).alias("lines"), F.min("_row").alias("_first"),
        *[F.sum(t).alias(k) for k, t in term.items()],
        F.min_by("value", filled).alias("header"))
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("lines").over(earlier), F.lit(0).cast("long"))
    placed = blocks.withColumn("_before", before)
    parts = {}
    for lane, (modulus, base) in enumerate(_LANES):
        own = F.pmod(F.col(f"sum{lane}"), F.lit(modulus).cast("long"))
        back = _power(pow(base, -1, modulus), F.col("_first"), modulus)
        shift = _power(base, F.col("_before"), modulus)
        parts[f"sum{lane}"] = _times(_times(own, back, modulus), shift, modulus)
    files = placed.select("path", "block", "length", "modified", "lines", "header",
                          *[c.alias(k) for k, c in parts.items()]).groupBy("path").agg(
        F.max("length").alias("length"), F.max("modified").alias("modified"),
        F.sum("lines").alias("lines"),
        *[F.pmod(F.sum(f"sum{lane}"), F.lit(modulus).cast("long")).alias(f"sum{lane}")
          for lane, (modulus, _) in enumerate(_LANES)],
        F.min_by("header", F.when(F.col("header").isNotNull(), F.col("block")))
        .alias("header"))
    return _described(files)


def _described(files: DataFrame) -> DataFrame:
    header = F.coalesce("header", F.lit(""))
    path = plain_path(F.col("path"))
    sums = [f"sum{lane}" for lane in range(len(_LANES))]
    return files.select(
        path.alias("path"), base_name(path).alias("file_name"),
        source_key(path).alias("source_key"), "length", "modified",
        F.sha2(F.concat_ws("|", *[F.col(c).cast("string") for c in ("length", "lines", *sums)],
                           header), 256).alias("file_hash"),
        header.alias("header"))


def listed_files(spark: SparkSession, raw_dir: str, pattern: str = "*.csv") -> DataFrame:
    """path, length and modification time of the feed files; no content is read.

    Scans leave out files of no bytes: those come from the scan's own listing, with length 0
    and no time of their own."""
    scan = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(raw_dir)
    filled = scan.select(plain_path(F.col("_metadata.file_path")).alias("path"), "length",
                         F.col("modificationTime").alias("modified"))
    names = scan.inputFiles()
    if not names:
        return filled
    every = spark.createDataFrame([(n,) for n in names], "path string") \
        .select(plain_path(F.col("path")).alias("path"))
    return every.join(filled, "path", "left").select(
        "path", F.coalesce("length", F.lit(0)).cast("long").alias("length"),
        F.coalesce("modified", F.timestamp_seconds(F.lit(0))).alias("modified"))


#: What is kept of a file once it has been read.
FINGERPRINT_SCHEMA = ("path string, length bigint, modified timestamp, file_hash string, "
                      "header string")


def list_feed_files(spark: SparkSession, raw_dir: str, pattern: str = "*.csv",
                    cache: str | None = None) -> DataFrame:
    """One row per feed file under ``raw_dir`` (see :func:`describe_files`), empty ones too.

    With ``cache``, a table of fingerprints by path, length and modification time, only files
    that are not in it are read, and they are added to it. What a file is stays its content:
    the cache only says that a name still stands for bytes that have been read."""
    listed = listed_files(spark, raw_dir, pattern)
    known = None
    if cache is not None and path_exists(spark, cache):
        known = spark.read.schema(FINGERPRINT_SCHEMA).parquet(cache).dropDuplicates(_FILE_KEY)
    unseen = listed if known is None else listed.join(known, _FILE_KEY, "left_anti")
    # names only; a read plan needs them on the driver
    paths = [r["path"] for r in unseen.filter("length > 0").select("path").collect()]
    if paths:
        text = spark.read.text([p.translate(_GLOB) for p in paths])
        found = describe_files(file_lines(text)).select("path", "file_hash", "header")
    else:
        found = spark.createDataFrame([], "path string, file_hash string, header string")
    empty = F.sha2(F.concat_ws("|", F.col("length").cast("string"), F.lit("no lines")), 256)
    read = unseen.join(found, "path", "left").select(
        *_FILE_KEY, F.coalesce("file_hash", empty).alias("file_hash"),
        F.coalesce("header", F.lit("")).alias("header"))
    if cache is not None and not unseen.isEmpty():
        read.coalesce(1).write.mode("append").parquet(cache)
        known = spark.read.schema(FINGERPRINT_SCHEMA).parquet(cache).dropDuplicates(_FILE_KEY)
    if known is not None:
        read = listed.join(known, _FILE_KEY)
    return read.select("path", base_name(F.col("path")).alias("file_name"),
                       source_key(F.col("path")).alias("source_key"), "length", "modified",
                       "file_hash", "header")


_FILE_KEY = ["path", "length", "modified"]


def distinct_contents(files: DataFrame) -> DataFrame:
    """Byte-identical files within one listing are processed once (first path wins)."""
    return keep_one(files, ["file_hash"], ["path"])


def split_routable(files: DataFrame, mapped_sources: list[str]) -> tuple[DataFrame, DataFrame]:
    """(routable, parked): parked files have no mapping; they are not read and not
    recorded, so a later run with a mapping picks them up."""
    mapped = F.col("source_key").isin(sorted(mapped_sources))
    return files.filter(mapped), files.filter(~mapped)


@dataclass(frozen=True)
class FileGroup:
    source: str
    header: str
    paths: tuple[str, ...]


def plan_groups(files: DataFrame) -> list[FileGroup]:
    """The (source, header) -> paths read plan.

    File paths reach the driver as plain rows (as in any file listing); they are not
    aggregated into one array per layout inside a single task. Row data never moves.
    """
    groups: dict[tuple[str, str], list[str]] = {}
    for r in files.select("source_key", "header", "path").collect():
        groups.setdefault((r["source_key"], r["header"]), []).append(r["path"])
    return [FileGroup(source, header, tuple(sorted(paths)))
            for (source, header), paths in sorted(groups.items())]


CORRUPT_RECORD = "_corrupt_record"


def header_columns(header: str) -> list[str]:
    """Column names from a CSV header line (quoted names allowed), as the CSV reader makes
    them: empty names become ``_c<i>``, and names that differ at most by case get their
    position appended."""
    names = next(csv.reader([header]), []) if header else []
    lower = [n.lower() for n in names]
    seen, out = set(lower), []
    for i, name in enumerate(names):
        if not name:
            name = f"_c{i}"
        elif lower.count(lower[i]) > 1 or lower[i] == CORRUPT_RECORD:
            name = f"{name}{i}"
            while name.lower() in seen:
                name = f"{name}_"
        seen.add(name.lower())
        out.append(name)
    return out


_GLOB = str.maketrans({c: "\\" + c for c in "\\*?[]{}"})


def read_csv_strings(spark: SparkSession, paths: list[str] | str, multiline: bool = False,
                     columns: list[str] | None = None) -> DataFrame:
    """Header CSV, UTF-8, every column a string; file lineage from ``_metadata``.

    Malformed rows are kept (PERMISSIVE) so quality rules, not the reader, decide. With
    ``columns`` (the layout's header) the schema is explicit, paths are plain names without
    globs, and a row with too many or too few fields keeps its raw text in
    ``_corrupt_record`` instead of being silently truncated or padded.
    """
    reader = (spark.read.option("header", True).option("encoding", "UTF-8")
              .option("inferSchema", False).option("mode", "PERMISSIVE")
              .option("multiLine", multiline))
    paths = [paths] if isinstance(paths, str) else list(paths)
    if columns is not None:
        schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in [*columns, CORRUPT_RECORD])
        reader = reader.schema(schema).option("columnNameOfCorruptRecord", CORRUPT_RECORD)
        paths = [p.translate(_GLOB) for p in paths]
    return reader.csv(paths).withColumn("source_file", plain_path(F.col("_metadata.file_path")))


def schema_of_mapping(mapping: dict[str, str]) -> str:
    """The mapped headers as a schema of strings."""
    return ", ".join(f"`{h.replace('`', '``')}` string" for h in mapping)


def read_feeds(spark: SparkSession, groups: list[FileGroup], mappings: dict[str, dict[str, str]],
               schema_version: str) -> DataFrame:
    """Read every group with its feed mapping and union the conformed frames by name.

    The number of scans equals the number of distinct (source, header) layouts.
    """
    frames = []
    for g in groups:
        if not g.header:  # no line, so no row
            source = schema_of_mapping(mappings[g.source])
            raw = spark.createDataFrame([], f"{source}, `{CORRUPT_RECORD}` string, "
                                            "source_file string")
            frames.append(conform(raw, mappings[g.source], source_department=g.source,
                                  schema_version=schema_version)
                          .withColumn("source_name", stem(F.col("source_file"))))
            continue
        raw = read_csv_strings(spark, list(g.paths), columns=header_columns(g.header))
        conformed = conform(raw, mappings[g.source], source_department=g.source,
                            schema_version=schema_version)
        frames.append(conformed.withColumn("source_name", stem(F.col("source_file"))))
    return union_all_by_name(frames)
