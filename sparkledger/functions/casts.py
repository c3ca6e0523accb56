"""Tolerant typed parsing as Column builders (all JVM-side, codegen friendly).

Each function returns a :class:`~pyspark.sql.Column`; nothing here runs Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkledger.config import DATE_FORMATS

MONEY_TYPE = "decimal(18,2)"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def compiled_apart(c: Column) -> Column:
    """``c`` itself, in a projection that Spark does not fuse with its neighbours.

    A higher-order function (here the filter behind ``array_compact``) has no fused code, so
    the projection that holds it is compiled as methods of its own. Fused with a join below
    and a sort above, many parsers make one method of over 8,000 bytes, which the JVM leaves
    to its interpreter."""
    return F.get(F.array_compact(F.array(c)), F.lit(0))


def parse_amount(c: str | Column) -> Column:
    """Money text to ``decimal(18,2)``; junk, empty or out-of-range text gives NULL.

    Keeps digits, ``.`` and ``-``; when every digit stands inside one pair of parentheses
    the amount is a credit (negative absolute value); a bracketed note beside the number
    changes nothing. A comma after a dot is a European-style
    number this parser does not accept, so it is NULL rather than silently rescaled.
    Cheap ``contains`` tests guard the regular expressions.
    """
    text = F.trim(_col(c))
    value = F.regexp_replace(text, r"[^0-9.\-]", "").try_cast(MONEY_TYPE)
    european = text.contains(",") & text.rlike(r"\..*,")
    credit = text.contains("(") & text.rlike(r"^[^0-9()]*\([^()]*[0-9][^()]*\)[^0-9()]*$")
    return (F.when(european, F.lit(None).cast(MONEY_TYPE))
            .when(credit, -F.abs(value))
            .otherwise(value))


# Text shapes each known format could possibly parse (deliberate supersets). A text
# without the shape cannot parse under that format, so the (exception-driven, slow)
# parse attempt is skipped; the first format that parses still wins.
DATE_SHAPES = {
    "dd/MM/yyyy": r"^[0-9]{2}/[0-9]{2}/[+-]?[0-9]{4,}$",
    "yyyy-MM-dd": r"^[+-]?[0-9]{4,}-[0-9]{2}-[0-9]{2}$",
    "dd-MMM-yyyy": r"^[0-9]{2}-[^-]+-[+-]?[0-9]{4,}$",
    "d/M/yyyy": r"^[0-9]+/[0-9]+/[+-]?[0-9]{4,}$",
}


def parse_date(c: str | Column, formats: list[str] | None = None) -> Column:
    """First format (in order) that parses wins; impossible dates such as 31/02 give NULL."""
    text = F.trim(_col(c))
    formats = DATE_FORMATS if formats is None else formats
    attempts = []
    for f in formats:
        parsed = F.try_to_timestamp(text, F.lit(f))
        shape = DATE_SHAPES.get(f)
        attempts.append(F.when(text.rlike(shape), parsed) if shape else parsed)
    return F.to_date(F.coalesce(*attempts))


def month_bucket(c: str | Column) -> Column:
    """``yyyy-MM`` text of a date column."""
    return F.date_format(_col(c), "yyyy-MM")


def normalise_name(c: str | Column) -> Column:
    """Trim and title-case (the rest of each word lower-cased)."""
    return F.initcap(F.trim(_col(c)))


def credit_flag(c: str | Column) -> Column:
    """True for a negative amount; NULL amounts are not credits."""
    return F.coalesce(_col(c) < 0, F.lit(False))


def is_blank(c: str | Column) -> Column:
    """NULL or whitespace-only text."""
    col = _col(c)
    return col.isNull() | (F.trim(col) == "")


def to_pence(c: str | Column) -> Column:
    """Money decimal to its exact integer number of pence (bigint)."""
    return (_col(c) * 100).cast("bigint")


def pence_to_money(c: str | Column) -> Column:
    """Integer pence back to ``decimal(18,2)`` exactly."""
    return (_col(c).cast("decimal(18,0)") / 100).cast(MONEY_TYPE)


def half_up_average(total_pence: str | Column, n: str | Column) -> Column:
    """Exact average of money given as integer pence, rounded half away from zero.

    ``sign(S) * ((2|S| + n) div 2n) / 100``: pure integer arithmetic, so the result does
    not depend on how an engine rounds an intermediate decimal or double.
    """
    s, n = _col(total_pence), _col(n)
    rounded = F.signum(s).cast("bigint") * F.call_function("div", F.abs(s) * 2 + n, n * 2)
    return F.when(n > 0, pence_to_money(rounded))
