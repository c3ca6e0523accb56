"""Typed columns from conformed text (the silver typing step)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkledger.functions.casts import (compiled_apart, credit_flag, month_bucket, normalise_name,
                                          parse_amount, parse_date)
from sparkledger.functions.hashing import record_hash

#: Typed column -> (text column it is parsed from, parser).
PARSED = {
    "supplier_name": ("supplier_name", normalise_name),
    "payment_date": ("payment_date", parse_date),
    "amount_gbp": ("amount", parse_amount),
    "vat_amount_gbp": ("vat_amount", parse_amount),
}
#: Column -> (typed column it follows from, rule).
DERIVED = {
    "payment_month": ("payment_date", month_bucket),
    "needs_review": ("amount_gbp", credit_flag),
}
#: Text that is kept beside its parsed value, as evidence.
EVIDENCE = ("amount", "payment_date")


def type_columns(df: DataFrame, ingested_at: datetime | Column | None = None) -> DataFrame:
    """Parse money, dates and names; keep the raw text of parsed columns as evidence.

    ``ingested_at``: a batch timestamp (one constant per batch, so "latest" is defined by
    batch, not by when a task happened to run), a Column, or None to keep an existing
    ``ingested_at`` column.
    """
    if ingested_at is not None and not isinstance(ingested_at, Column):
        ingested_at = F.lit(ingested_at)
    replaced = {text for text, _ in PARSED.values()} | {"ingested_at"}
    others = [c for c in df.columns if c not in replaced]
    stamp = F.col("ingested_at") if ingested_at is None else ingested_at
    parsed = df.select(*others, compiled_apart(stamp).alias("ingested_at"),
                       *[F.col(c).alias(f"{c}_raw") for c in EVIDENCE],
                       *[parse(text).alias(c) for c, (text, parse) in PARSED.items()])
    return parsed.withColumns({c: rule(typed) for c, (typed, rule) in DERIVED.items()})


def add_record_hash(df: DataFrame) -> DataFrame:
    return df.withColumn("record_hash", record_hash())
