"""A spend ledger derived from the TPC-H-style driver tables.

The driver tables hold no spend feeds, so this view turns every ``lineitem`` row into one
raw, text-typed spend row shaped like a conformed feed (the same text styles real feeds
carry: currency symbols, thousands separators, bracketed credits, four date layouts,
padded and mis-cased supplier names, blank ids, junk amounts and impossible dates).
Its work grows with ``lineitem``; the same rules are written in SQL in
:mod:`sparkledger.plans.oracle`.

Join plan: ``lineitem`` meets ``orders`` on the order key (always a shuffle join);
customers get their department through ``nation``/``region`` (25 and 5 rows, broadcast
by the planner's file-size check); ``supplier`` and ``part`` are likewise broadcast only
while their files are small and shuffle-joined beyond that (AQE splits skewed join keys).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkledger.config import LEDGER_DRIFT_COLUMNS, LEDGER_FEEDS, LEDGER_SCHEMA_VERSION
from sparkledger.functions.casts import pence_to_money

def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def department_name(region_name: Column) -> Column:
    return F.regexp_replace(F.lower(region_name), " ", "_")


def customer_departments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(c_custkey, c_name, c_nationkey, source_department)."""
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    # nation (25 rows) and region (5 rows) have fixed cardinality; their tiny files pass
    # Spark's own size check, so the planner broadcasts them without a hint or a count.
    nation_dept = (nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
                   .select("n_nationkey", department_name(F.col("r_name")).alias("source_department")))
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    return (customer.join(nation_dept, F.col("c_nationkey") == F.col("n_nationkey"))
            .drop("n_nationkey"))


def _money_text(money: Column) -> Column:
    return F.format_number(money, 2)


def supplier_text(key: Column, name: Column) -> Column:
    """Supplier name as feeds spell it: padded upper case, lower case, or with a suffix."""
    return (F.when(key % 3 == 0, F.concat(F.lit("  "), F.upper(name), F.lit(" ")))
            .when(key % 3 == 1, F.lower(name))
            .otherwise(F.concat(name, F.lit(" trading ltd"))))


def vat_departments(feeds: dict[str, dict[str, str]] | None = None) -> list[str]:
    feeds = LEDGER_FEEDS if feeds is None else feeds
    return sorted(d for d, m in feeds.items() if "vat_amount" in m.values())


def spend_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw spend rows: canonical text columns + lineage, one per ``lineitem`` row.

    Columns: transaction_id, supplier_name, payment_date, amount, expense_category,
    vat_amount (text); raw_extras (map); source_department, source_file, schema_version,
    ingested_at.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate",
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("pence"),
        F.round(F.col("l_tax") * 100).cast("bigint").alias("tax_pct"))
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    depts = customer_departments(spark, sf_dir).select("c_custkey", "source_department")
    order_dept = orders.join(depts, F.col("o_custkey") == F.col("c_custkey")) \
                       .select("o_orderkey", "source_department")
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_type")

    # Fact-to-fact: always a shuffle join on the order key. Static size estimates of a
    # join output are products of inputs, which would otherwise make the fact table the
    # broadcast side and stream everything through one task.
    rows = (li.hint("merge").join(order_dept, F.col("l_orderkey") == F.col("o_orderkey"))
              .join(part, F.col("l_partkey") == F.col("p_partkey"))
              .join(supplier, F.col("l_suppkey") == F.col("s_suppkey")))

    ok, pk, sk = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    ship = F.col("l_shipdate")
    dept = F.col("source_department")
    money = pence_to_money("pence")
    vat = pence_to_money(F.call_function("div", F.col("pence") * F.col("tax_pct"), F.lit(100)))

    transaction_id = (F.when(pk % 101 == 0, F.lit(""))
                      .otherwise(F.concat(ok.cast("string"), F.lit("-"),
                                          F.col("l_linenumber").cast("string"))))
    supplier_name = F.when(pk % 103 == 0, F.lit("")).otherwise(supplier_text(sk, F.col("s_name")))
    payment_date = (F.when(pk % 97 == 0, F.lit("31/02/2026"))
                    .when(sk % 4 == 0, F.date_format(ship, "dd/MM/yyyy"))
                    .when(sk % 4 == 1, F.date_format(ship, "yyyy-MM-dd"))
                    .when(sk % 4 == 2, F.date_format(ship, "dd-MMM-yyyy"))
                    .otherwise(F.date_format(ship, "d/M/yyyy")))
    # The number stands in the expression once: a branch for each style, with the number in
    # it, made a method that the JVM leaves to its interpreter (over 8,000 bytes).
    style = ok % 4
    inclusive, refund = (style == 1) & (pk % 5 == 0), (style == 1) & (pk % 5 == 1)
    before = (F.when(style == 0, F.lit("£")).when(refund, F.lit("GBP "))
              .when(style.isin(1, 2), F.lit("")).otherwise(F.lit("(")))
    after = (F.when(inclusive, F.lit(" (inc VAT)")).when(refund, F.lit(" (refund) (see note)"))
             .when(style.isin(0, 1, 2), F.lit("")).otherwise(F.lit(")")))
    number = F.when(style == 2, money.cast("string")).otherwise(_money_text(money))
    amount = F.when(pk % 89 == 0, F.lit("INVALID")).otherwise(F.concat(before, number, after))
    vat_amount = F.when(dept.isin(vat_departments()), vat.cast("string"))

    drift_depts = sorted(LEDGER_DRIFT_COLUMNS)
    extras = F.when(dept.isin(drift_depts),
                    F.create_map(F.lit("Grant Ref"),
                                 F.concat(F.lit("PC-"), (pk % 50).cast("string")))
                    ).otherwise(F.create_map().cast("map<string,string>"))

    return rows.select(
        transaction_id.alias("transaction_id"),
        supplier_name.alias("supplier_name"),
        payment_date.alias("payment_date"),
        amount.alias("amount"),
        F.col("p_type").alias("expense_category"),
        vat_amount.alias("vat_amount"),
        extras.alias("raw_extras"),
        dept.alias("source_department"),
        F.concat(dept, F.lit("_spend_"), F.date_format(ship, "yyyy_MM"), F.lit(".csv"))
         .alias("source_file"),
        F.lit(LEDGER_SCHEMA_VERSION).alias("schema_version"),
        ship.alias("ingested_at"),
    )


def approvals_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One approval per line; those of some orders carry an id that no transaction has."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    # customers meet the orders first: the line items are dealt out once
    bought = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    rows = li.hint("merge").join(bought, F.col("l_orderkey") == F.col("o_orderkey"))
    prio = F.col("o_orderpriority")
    status = (F.when(prio.isin("1-URGENT", "2-HIGH"), F.lit("Approved"))
              .when(prio == "3-MEDIUM", F.lit("Pending"))
              .when(prio == "5-LOW", F.lit("Rejected")))
    return rows.select(
        F.concat(F.when(F.col("l_orderkey") % 20 < 17, F.lit("")).otherwise(F.lit("old/")),
                 F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("transaction_id"),
        F.concat(F.lit("CC-"), (F.col("l_partkey") % 40).cast("string")).alias("cost_centre"),
        F.replace(F.lower(F.col("c_name")), F.lit("customer#"), F.lit("approver.")).alias("approver"),
        F.concat(F.lit("owner-"), F.col("c_nationkey").cast("string")).alias("budget_owner"),
        status.alias("processing_status"),
        F.concat(F.lit("order status "), F.col("o_orderstatus")).alias("internal_notes"),
    )


def supplier_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier risk reference (raw spelling; some under a name that no feed uses)."""
    s = read_table(spark, sf_dir, "supplier").select(
        "s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    bal = F.col("s_acctbal")
    return s.select(
        F.concat(F.when(F.col("s_suppkey") % 7 == 0, F.lit("formerly ")).otherwise(F.lit("")),
                 supplier_text(F.col("s_suppkey"), F.col("s_name"))).alias("supplier_name"),
        F.concat(F.lit("Tier "), (F.col("s_nationkey") % 3 + 1).cast("string")).alias("supplier_category"),
        F.when(bal < 0, F.lit("High")).when(bal < 5000, F.lit("Medium")).otherwise(F.lit("Low"))
         .alias("risk_rating"),
        F.concat(F.lit("checked nation "), F.col("s_nationkey").cast("string")).alias("due_diligence_notes"),
    )


def feed_frame(ledger: DataFrame, department: str, mapping: dict[str, str],
               drift: list[str] | None = None) -> DataFrame:
    """One department's rows laid out under that feed's own header names (as its CSV
    would arrive), for exercising conform. Drift headers come from ``raw_extras``."""
    cols = [F.col(canon).alias(src) for src, canon in mapping.items()]
    cols += [F.element_at("raw_extras", F.lit(name)).alias(name) for name in (drift or [])]
    return (ledger.filter(F.col("source_department") == department)
            .select(*cols, "source_file", "ingested_at"))
