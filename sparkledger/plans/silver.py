"""Compose the operators into the medallion layers (all lazy DataFrames).

raw text rows -> route -> type -> hash -> department group -> tag rules ->
valid / rejected -> keep latest -> silver contract -> assurance join -> open -> gold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkledger.config import (LEDGER_DEPARTMENT_GROUPS, LEDGER_FEEDS, SILVER_COLUMNS,
                                restricted_columns)
from sparkledger.operators.cleanse import add_record_hash, type_columns
from sparkledger.operators.enrich import (as_lookup, attach_assurance, department_groups,
                                          prepare_approvals, prepare_suppliers)
from sparkledger.operators.keys import keep_latest
from sparkledger.operators.marts import gold_metrics
from sparkledger.operators.policy import open_layer
from sparkledger.operators.quality import tag_rejections
from sparkledger.sources.files import source_key
from sparkledger.sources.ledger import approvals_ledger, spend_ledger, supplier_reference
from sparkledger.sources.sinks import stage


def route(df: DataFrame, mapped_sources: list[str], file_col: str = "source_file") -> DataFrame:
    """Keep rows whose file routes to a mapped source (others are parked)."""
    return df.filter(source_key(F.col(file_col)).isin(sorted(mapped_sources)))


def typed(df: DataFrame, groups: dict[str, str], ingested_at=None) -> DataFrame:
    """Conformed text -> typed, hashed, department-grouped rows."""
    return department_groups(add_record_hash(type_columns(df, ingested_at)), groups)


def silver_contract(valid: DataFrame) -> DataFrame:
    return valid.select(*SILVER_COLUMNS)


def latest_valid(tagged: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The latest valid row per natural key.

    Valid rows sort first inside each key, so rank 1 is the latest valid row, and a key
    whose rank-1 row is invalid has no valid row at all. Keeping ``rank = 1 AND valid``
    above the window gives exactly "filter valid, then keep latest", but the validity
    test cannot be pushed below the window into the scan/join, where the optimizer
    would inline (and so evaluate twice) every parser the rules depend on.
    """
    valid = F.col("rejection_reason").isNull()
    return keep_latest(tagged, keys, first=[valid.desc()]).filter(valid).drop("rejection_reason")


def build_silver(tagged: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Valid rows, latest per natural key, projected to the silver contract."""
    return silver_contract(latest_valid(tagged, keys))


# ---- the same layers over the spend ledger derived from the driver tables -----------

def ledger_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed(route(spend_ledger(spark, sf_dir), list(LEDGER_FEEDS)), LEDGER_DEPARTMENT_GROUPS)


def every_ledger_row_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed rows of all departments, the unmapped one too (its group is NULL)."""
    return typed(spend_ledger(spark, sf_dir), LEDGER_DEPARTMENT_GROUPS)


def ledger_tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tag_rejections(ledger_typed(spark, sf_dir))


def ledger_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_silver(ledger_tagged(spark, sf_dir))


def assured_silver(silver: DataFrame, approvals: DataFrame, suppliers: DataFrame,
                   scratch: str | None = None) -> DataFrame:
    """``attach_assurance`` of silver rows that come without their record hash. It is made
    after the joins from the columns that it is a hash of, so no shuffle carries it. The
    suppliers are staged, and sent to the executors as long as they are small."""
    known = as_lookup(stage(suppliers, "suppliers", scratch=scratch))
    joined = attach_assurance(silver, approvals, known)
    first = ["supplier_name", "transaction_id"]  # the joins' keys
    added = [c for c in joined.columns if c not in SILVER_COLUMNS]
    return add_record_hash(joined).select(
        *first, *[c for c in SILVER_COLUMNS if c not in first], *added)


def ledger_assured(spark: SparkSession, sf_dir: str) -> DataFrame:
    # staged: the shuffles behind silver are freed before those of the joins are written
    silver = stage(ledger_silver(spark, sf_dir).drop("record_hash"), "silver")
    return assured_silver(silver, prepare_approvals(approvals_ledger(spark, sf_dir)),
                          prepare_suppliers(supplier_reference(spark, sf_dir)))


def ledger_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    return open_layer(ledger_assured(spark, sf_dir), restricted_columns())


def ledger_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_metrics(ledger_silver(spark, sf_dir))
