"""Rule-based quarantine: every failed rule is reported, bad rows never fail the job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkledger.config import REJECTED_COLUMNS, REJECTION_RULE_NAMES
from sparkledger.functions.casts import is_blank


CORRUPT_RECORD = "_corrupt_record"


def default_rules(columns: list[str] | None = None) -> list[tuple[str, Column]]:
    """(reason, failed-predicate) in reporting order. Credits are valid, not rejected.

    When rows carry the CSV reader's ``_corrupt_record`` (wrong field count), a
    ``malformed_row`` rule is added after the four field rules.
    """
    failed = [
        is_blank("transaction_id"),
        is_blank("supplier_name"),
        F.col("payment_date").isNull(),
        F.col("amount_gbp").isNull(),
    ]
    rules = list(zip(REJECTION_RULE_NAMES, failed))
    if columns is not None and CORRUPT_RECORD in columns:
        rules.append(("malformed_row", F.col(CORRUPT_RECORD).isNotNull()))
    return rules


def rejection_reason(rules: list[tuple[str, Column]] | None = None) -> Column:
    """All failed rule names joined by ``"; "`` in rule order; NULL when none failed."""
    rules = default_rules() if rules is None else rules
    joined = F.concat_ws("; ", *[F.when(failed, F.lit(name)) for name, failed in rules])
    return F.nullif(joined, F.lit(""))


def tag_rejections(df: DataFrame, rules: list[tuple[str, Column]] | None = None) -> DataFrame:
    rules = default_rules(df.columns) if rules is None else rules
    return df.withColumn("rejection_reason", rejection_reason(rules))


def valid_rows(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col("rejection_reason").isNull()).drop("rejection_reason")


def rejected_rows(tagged: DataFrame) -> DataFrame:
    """The quarantine record: lineage, id, the raw evidence and the reasons."""
    # A row number, which depends on the rows before, keeps the filter above the projection:
    # pushed below it, the reasons and every parser in them would be evaluated twice.
    numbered = tagged.withColumn("_row", F.monotonically_increasing_id())
    renamed = (numbered.filter(F.col("rejection_reason").isNotNull() & (F.col("_row") >= 0))
               .withColumnRenamed("amount_raw", "raw_amount")
               .withColumnRenamed("payment_date_raw", "raw_date"))
    extra = [c for c in ("source_name",) if c in tagged.columns]
    if CORRUPT_RECORD in tagged.columns:
        extra.append(F.col(CORRUPT_RECORD).alias("raw_record"))
    return renamed.select(*REJECTED_COLUMNS, *extra)


def split_valid_quarantine(df: DataFrame, rules: list[tuple[str, Column]] | None = None
                           ) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) from one tagging pass; both are lazy views of the same plan."""
    tagged = tag_rejections(df, rules)
    return valid_rows(tagged), rejected_rows(tagged)
