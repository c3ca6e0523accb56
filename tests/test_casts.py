import hashlib
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from sparkledger.functions import casts
from sparkledger.functions.hashing import record_hash


def _apply(spark, text, build):
    return spark.createDataFrame([(text,)], "x string").select(build(F.col("x"))).first()[0]


@pytest.mark.parametrize("text, value", [
    ("$7", "7.00"), (" EUR 3,004,005.5 ", "3004005.50"), ("-0.01", "-0.01"), ("12.345", "12.35"),
    # every digit inside one pair of brackets: a credit
    ("(7.25)", "-7.25"), ("£ (8,100)", "-8100.00"), ("(-3)", "-3.00"), ("(9) CR", "-9.00"),
    # a note in brackets is no credit
    ("2,750.10 (inc VAT)", "2750.10"), ("£64 (refund)", "64.00"), ("(net) 5", "5.00"),
    ("5 (a) (b)", "5.00"),
    ("6.000,10", None), ("n/a", None), ("()", None), ("--", None), ("1" * 30, None), (None, None)])
def test_amounts(spark, text, value):
    assert _apply(spark, text, casts.parse_amount) == (None if value is None else D(value))


@pytest.mark.parametrize("text, day", [
    ("29/02/2024", "2024-02-29"), ("29/02/2023", None), ("1999-12-31", "1999-12-31"),
    ("07-Nov-2011", "2011-11-07"), ("7/11/2011", "2011-11-07"), ("\t2001-09-09 ", None),
    ("  2001-09-09 ", "2001-09-09"), ("2001/09/09", None), ("", None), (None, None)])
def test_dates(spark, text, day):
    got = _apply(spark, text, casts.parse_date)
    assert (got and got.isoformat()) == day


def test_months_credits_and_names(spark):
    df = spark.createDataFrame([("1987-06-05", D("-0.01"), " the RIVER  trust"), (None, None, None)],
                               "d string, a decimal(18,2), n string")
    rows = df.select(casts.month_bucket(F.to_date("d")), casts.credit_flag("a"),
                     casts.normalise_name("n")).collect()
    assert [tuple(r) for r in rows] == [("1987-06", True, "The River  Trust"), (None, False, None)]


@pytest.mark.parametrize("total, n, mean", [
    (10, 4, "0.03"), (-10, 4, "-0.03"), (9, 4, "0.02"), (123456789012, 7, "176366841.45"), (5, 0, None)])
def test_averages_are_exact_and_rounded_half_away_from_zero(spark, total, n, mean):
    df = spark.createDataFrame([(total, n)], "s bigint, n bigint")
    assert df.select(casts.half_up_average("s", "n")).first()[0] == (mean and D(mean))


def test_record_hash_takes_missing_parts_as_empty_text(spark):
    df = spark.createDataFrame([(None, "parks", None, "4.20")],
                               "transaction_id string, source_department string, "
                               "payment_date string, amount_gbp string")
    assert df.select(record_hash()).first()[0] == hashlib.sha256(b"|parks||4.20").hexdigest()
