"""Table sinks: partition-replacing Parquet writes, staging, create-if-absent."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from sparkledger.functions.hashing import HASH_COLUMNS, pack_hashes, unpack_hashes
from sparkledger.session import scratch_path
from sparkledger.sources.journal import new_run_id
from sparkledger.sources.storage import (delete_path, file_system, hadoop_path, names_in,
                                         path_exists, read_text, write_text)


#: Codec of every Parquet file written: hashes and ids as text take some two thirds of the
#: bytes that they take with the default.
CODEC = "zstd"


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    """A session setting for the queries run inside; what was set before comes back."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def shuffles_freed(spark: SparkSession):
    """Queries run inside delete their shuffle files when they end. Else files stay until the
    driver's garbage collector finds their plan, which may be after many more queries."""
    return _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


#: Bytes of well compressed files that a task reads at once if it sorts what it reads.
SORTED_SCAN_BYTES = 32 << 20


#: Rows of a staged file of rows that a lazy query sorts when it reads them.
SORTED_FILE_ROWS = 150_000


def small_scans(spark: SparkSession):
    """Scans of queries run inside are cut into smaller tasks, so that a sort of their rows
    (some twenty times the bytes of the files) has room in memory and spills none."""
    now = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return _setting(spark, "spark.sql.files.maxPartitionBytes", str(min(now, SORTED_SCAN_BYTES)))


def parquet_writer(df: DataFrame):
    return df.write.option("compression", CODEC)


def balanced(df: DataFrame, partition_cols: list[str] | None) -> DataFrame:
    """Group rows by output partition before a partitioned write.

    A ``rebalance`` hint (not a plain repartition): AQE packs small output partitions
    into few tasks and splits a hot one across several, so a partition holding a third
    of the rows is written in parallel and small partitions do not get one file from
    every upstream task. Hashes are packed on the way.
    """
    if not partition_cols:
        return df
    hashes = tuple(c for c in HASH_COLUMNS if dict(df.dtypes).get(c) == "string"
                   and c not in partition_cols)
    return unpack_hashes(pack_hashes(df, hashes).hint("rebalance", *partition_cols), hashes)


def write_partitions(df: DataFrame, path: str, partition_cols: list[str],
                     rebalance: bool = True) -> None:
    """Replace only the partitions present in ``df`` (dynamic overwrite, set per write).

    ``rebalance=False`` when rows already arrive clustered by partition (e.g. one
    partition per source file, read one file per task).
    """
    out = balanced(df, partition_cols) if rebalance else df
    # each task sorts its rows by partition
    with shuffles_freed(df.sparkSession), small_scans(df.sparkSession):
        (parquet_writer(out).mode("overwrite")
           .option("partitionOverwriteMode", "dynamic")
           .partitionBy(*partition_cols).parquet(path))


def move_partitions(spark: SparkSession, staged_path: str, path: str, depth: int) -> None:
    """Put the partition folders (``depth`` levels down) of a staged table in the place of a
    table's own, by renaming them: no row is written again.

    Can be repeated: a folder that is no longer staged has been moved, and one that still is
    replaces whatever is left in its place."""
    fs = file_system(spark, path)

    def move(folder: str, target: str, left: int) -> None:
        if left == 0:
            fs.mkdirs(hadoop_path(spark, target).getParent())
            delete_path(spark, target)
            if not fs.rename(hadoop_path(spark, folder), hadoop_path(spark, target)):
                raise OSError(f"could not move {folder} to {target}")
            return
        for name in names_in(spark, folder):
            if "=" in name:
                move(f"{folder}/{name}", f"{target}/{name}", left - 1)

    move(staged_path.rstrip("/"), path.rstrip("/"), depth)


def write_table(df: DataFrame, path: str, partition_cols: list[str] | None = None) -> None:
    """Full (static) overwrite, for layers fully derived from another table."""
    writer = parquet_writer(balanced(df, partition_cols)).mode("overwrite") \
        .option("partitionOverwriteMode", "static")
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    with shuffles_freed(df.sparkSession):
        writer.parquet(path)


def stage(df: DataFrame, name: str, partition_cols: list[str] | None = None,
          scratch: str | None = None, file_rows: int = 0) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder (or under ``scratch``) and read it back.
    Files hold at most ``file_rows`` rows, if given: small files make small scan tasks.

    Freezes non-deterministic columns, cuts lineage (a lost executor recomputes from
    the staged files, not from the sources), and lets a job replace the table it read.
    """
    spark = df.sparkSession
    path = (f"{scratch.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}" if scratch
            else scratch_path(spark, name))
    writer = parquet_writer(balanced(df, partition_cols)).mode("overwrite") \
        .option("maxRecordsPerFile", file_rows)
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    with shuffles_freed(spark):
        writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def read_parquet_or_none(spark: SparkSession, path: str,
                         schema: StructType | None = None) -> DataFrame | None:
    """The table, or None if its folder does not exist; any other failure to read it is
    raised. With ``schema`` nothing is inferred: partition values keep their text (``007``),
    and a folder without rows is an empty table."""
    if not path_exists(spark, path):
        return None
    if schema is None:
        return spark.read.parquet(path)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def ensure_table(spark: SparkSession, name: str, like: DataFrame,
                 partition_cols: list[str] | None = None) -> bool:
    """Create catalog table ``name`` with ``like``'s schema and no rows, if absent.

    Returns True when the table was created.
    """
    if spark.catalog.tableExists(name):
        return False
    writer = like.limit(0).write.mode("ignore")
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.saveAsTable(name)
    return True


CURRENT = "_current"


def _versions(spark: SparkSession, path: str) -> list[str]:
    return [n for n in names_in(spark, path) if n.startswith("v")]


def current_version(spark: SparkSession, path: str) -> str | None:
    """The folder that a table written by ``replace_table`` now consists of."""
    pointer = f"{path.rstrip('/')}/{CURRENT}"
    if not path_exists(spark, pointer):
        return None
    return f"{path.rstrip('/')}/{read_text(spark, pointer)}"


def replace_table(df: DataFrame, path: str) -> str:
    """Create or replace a whole table in one step; returns the new version's folder.

    Rows go to a folder of their own; then one small pointer file is switched to it. A
    write that dies leaves the old table as it was, and ``df`` may read the old version.
    The version before the new one stays for readers that have begun."""
    spark, path = df.sparkSession, path.rstrip("/")
    before = current_version(spark, path)
    name = f"v{new_run_id()}"
    with shuffles_freed(spark):
        parquet_writer(df).parquet(f"{path}/{name}")
    write_text(spark, f"{path}/{CURRENT}", name)
    for old in _versions(spark, path):
        if old != name and f"{path}/{old}" != before:
            delete_path(spark, f"{path}/{old}")
    return f"{path}/{name}"


def read_replaced(spark: SparkSession, path: str,
                  schema: StructType | None = None) -> DataFrame | None:
    """The current version of a table written by ``replace_table``, or None."""
    version = current_version(spark, path)
    if version is None:
        return None
    return (spark.read if schema is None else spark.read.schema(schema)).parquet(version)
