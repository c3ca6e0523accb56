"""Keyed keep-one / keep-latest (deterministic deduplication)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkledger.functions.hashing import pack_hashes, unpack_hashes

# Payload columns used as the final, total tie-break after ingested_at and record_hash.
TIE_BREAK_COLUMNS = ["payment_date", "amount_gbp", "supplier_name", "expense_category",
                     "vat_amount_gbp", "source_file"]


def keep_first(df: DataFrame, keys: list[str | Column], order: list[Column]) -> DataFrame:
    """One row per key: the first under ``order``.

    ``row_number() = 1`` right on top of the window lets Spark plan a partial top-1
    (``WindowGroupLimit``) before the shuffle, so a hot key sends at most one row per
    map task across the network.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_keep_rank", F.row_number().over(w))
            .filter(F.col("_keep_rank") == 1)
            .drop("_keep_rank"))


def latest_order(extra: list[str] | None = None, columns: list[str] | None = None) -> list[Column]:
    """Latest ``ingested_at`` first, then ``record_hash``, then payload columns (all DESC)."""
    names = ["ingested_at", "record_hash"] + (TIE_BREAK_COLUMNS if extra is None else extra)
    if columns is not None:
        names = [n for n in names if n in columns]
    order = [F.col(n).desc_nulls_last() for n in names]
    if columns is not None and "raw_extras" in columns:  # a map, compared as text
        order.append(F.to_json("raw_extras").desc_nulls_last())
    return order


def keep_latest(df: DataFrame, keys: list[str] | None = None,
                order: list[Column] | None = None, first: list[Column] | None = None) -> DataFrame:
    """Keep the latest row per natural key.

    Default key is ``(transaction_id, source_department)``; with a single key of
    ``transaction_id`` a missing id falls back to ``record_hash``. ``first`` sorts before the
    default order. In that order rows go through the shuffle with packed hashes.
    """
    keys = ["transaction_id", "source_department"] if keys is None else keys
    own_order = order is not None
    order = [*(first or []), *(order if own_order else latest_order(columns=df.columns))]
    fallback, kinds = "record_hash" in df.columns, dict(df.dtypes)
    texts = [kinds.get("record_hash"), *[kinds[k] for k in keys if k == "transaction_id"]]
    if own_order or set(texts) != {"string"}:
        key_cols = [F.coalesce(F.col(k), F.col("record_hash")) if k == "transaction_id" and fallback
                    else F.col(k) for k in keys]
        return keep_first(df, key_cols, order)
    columns = df.columns
    if "transaction_id" in keys:
        # in the id's own place: a key of its own would be shipped beside the id
        df = df.withColumns({"_unnamed": F.col("transaction_id").isNull(), "transaction_id":
                             F.coalesce(F.col("transaction_id"), F.col("record_hash"))})
    kept = unpack_hashes(keep_first(pack_hashes(df), keys, order))
    if "transaction_id" in keys:
        kept = kept.withColumn("transaction_id", F.when(~F.col("_unnamed"), F.col("transaction_id")))
    return kept.select(*columns)


def keep_one(df: DataFrame, keys: list[str], order_cols: list[str] | None = None) -> DataFrame:
    """Distinct on a key subset with a reproducible survivor (smallest remaining columns)."""
    order_cols = [c for c in df.columns if c not in keys] if order_cols is None else order_cols
    return keep_first(df, keys, [F.col(c).asc_nulls_last() for c in order_cols])
