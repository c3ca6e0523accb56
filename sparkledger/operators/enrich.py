"""Enrichment joins: the department lookup and the assurance (ledger + supplier) join."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkledger.functions.casts import normalise_name
from sparkledger.functions.hashing import pack_hashes, unpack_hashes
from sparkledger.operators.keys import keep_one

def dimension_frame(spark: SparkSession, mapping: dict[str, str], key: str, value: str) -> DataFrame:
    """A config dictionary as a two-column frame (size bounded by the config)."""
    return spark.createDataFrame(sorted(mapping.items()), f"{key} string, {value} string")


def department_groups(df: DataFrame, groups: dict[str, str]) -> DataFrame:
    """Attach ``department_group`` from a config dict (broadcast join, bounded by config)."""
    spark = df.sparkSession
    dim = dimension_frame(spark, groups, "_dept_key", "department_group")
    return df.join(F.broadcast(dim), F.col("source_department") == F.col("_dept_key"), "left") \
             .drop("_dept_key")


def prepare_approvals(approvals: DataFrame) -> DataFrame:
    """One ledger row per transaction id, chosen reproducibly."""
    return keep_one(approvals, ["transaction_id"])


def prepare_suppliers(suppliers: DataFrame) -> DataFrame:
    """Supplier names normalised like silver, then one row per name (no join fan-out)."""
    return keep_one(suppliers.withColumn("supplier_name", normalise_name("supplier_name")),
                    ["supplier_name"])


#: Bytes of rows up to which a lookup table is sent whole to every executor.
LOOKUP_BYTES = 100 << 20


def as_lookup(df: DataFrame, most: int = LOOKUP_BYTES) -> DataFrame:
    """``df``, which must be staged, to be broadcast in joins if its rows are at most ``most``
    bytes in memory; else as it is. Spark's own limit goes by estimates and is far lower: a
    lookup of a few MB would have the rows that it serves shuffled."""
    row = 16 * (len(df.columns) + 2)
    text = sum((F.coalesce(F.octet_length(F.col(c)), F.lit(0)) for c, kind in df.dtypes
                if kind == "string"), F.lit(row).cast("long"))
    fixed = all(kind in ("string", "boolean", "int", "bigint", "date", "double")
                for _, kind in df.dtypes)
    held = df.agg(F.sum(text)).first()[0] or 0
    return F.broadcast(df) if fixed and held <= most else df


def attach_assurance(silver: DataFrame, approvals: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Left join the approvals ledger (by transaction id) and supplier risk (by name).

    ``missing_approval`` is true when no ledger status is present (no match, or a NULL
    status). Neither side is hinted: the planner, or AQE from measured bytes, broadcasts a
    side that is small and splits skewed keys otherwise.
    """
    joined = pack_hashes(silver).join(approvals, "transaction_id", "left")
    joined = unpack_hashes(joined.join(suppliers, "supplier_name", "left"))
    return joined.withColumn("missing_approval", F.col("processing_status").isNull())
