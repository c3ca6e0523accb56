"""Content hashes as Column builders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _text(c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(col.cast("string"), F.lit(""))


def record_hash(id_col: str = "transaction_id", department_col: str = "source_department",
                date_col: str = "payment_date", amount_col: str = "amount_gbp") -> Column:
    """SHA-256 hex of ``id|department|date|amount`` with NULL parts as ``''``.

    Detects whether a row's key content changed; it is not an identity (a correction
    changes it).
    """
    return F.sha2(F.concat_ws("|", _text(id_col), F.col(department_col),
                              _text(date_col), _text(amount_col)), 256)


def content_hash(*cols: str | Column) -> Column:
    """SHA-256 hex over the text of every given column (NULL as ``''``).

    Used to gate upserts on any mutable column and as the last, total tie-break when
    keeping the latest row per key.
    """
    return F.sha2(F.concat_ws("|", *[_text(c) for c in cols]), 256)


#: Columns of hash text that rows carry through shuffles.
HASH_COLUMNS = ("record_hash",)


def packed_hash(c: str | Column) -> Column:
    """Hash text as bytes: SHA-256 hex takes half its length, any other text its own, and the
    first byte tells which. Values of one kind keep their order."""
    text = F.col(c) if isinstance(c, str) else c
    return (F.when(text.rlike("^[0-9a-f]{64}$"), F.concat(F.lit(b"\x00"), F.unhex(text)))
            .otherwise(F.concat(F.lit(b"\x01"), F.encode(text, "UTF-8"))))


def unpacked_hash(c: str | Column) -> Column:
    """The text of a :func:`packed_hash`."""
    packed = F.col(c) if isinstance(c, str) else c
    rest = F.substring(packed, 2, 2147483647)
    return (F.when(F.substring(packed, 1, 1) == F.lit(b"\x00"), F.lower(F.hex(rest)))
            .otherwise(F.decode(rest, "UTF-8")))


def pack_hashes(df: DataFrame, names: tuple[str, ...] = HASH_COLUMNS) -> DataFrame:
    """``df`` with its hash text as bytes, for a shuffle: hex does not compress there."""
    kinds = dict(df.dtypes)
    return df.withColumns({c: packed_hash(c) for c in names if kinds.get(c) == "string"})


def unpack_hashes(df: DataFrame, names: tuple[str, ...] = HASH_COLUMNS) -> DataFrame:
    kinds = dict(df.dtypes)
    return df.withColumns({c: unpacked_hash(c) for c in names if kinds.get(c) == "binary"})


# Mutable silver columns covered by ``content_hash`` (maps excluded: not comparable).
CONTENT_COLUMNS = [
    "transaction_id", "source_department", "payment_date", "amount_gbp", "supplier_name",
    "expense_category", "vat_amount_gbp",
]
