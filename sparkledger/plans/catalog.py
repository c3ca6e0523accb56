"""Query catalogue: one registered query per operator family, over the driver tables.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame over the whole spend ledger
derived from the driver tables (no row caps; a LIMIT appears only where the top-k report
is the feature). Matching SQL for every query lives in :mod:`sparkledger.plans.oracle`.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkledger.config import (LEDGER_DRIFT_COLUMNS, LEDGER_FEEDS, LEDGER_LAYOUTS,
                                LEDGER_SCHEMA_VERSION)
from sparkledger.functions import casts
from sparkledger.functions.hashing import record_hash
from sparkledger.operators.cleanse import EVIDENCE, add_record_hash
from sparkledger.operators.conform import conform, union_all_by_name
from sparkledger.operators.marts import department_totals, ordered_for_display, run_summary
from sparkledger.operators.policy import (Grant, column_policy, create_governed_view,
                                          denied_columns, grants_table, row_policy)
from sparkledger.operators.upsert import hash_gated_merge, upsert_latest
from sparkledger.plans import silver as S
from sparkledger.sources.files import source_key
from sparkledger.sources.ledger import feed_frame, spend_ledger
from sparkledger.session import scratch_path
from sparkledger.sources.sinks import SORTED_FILE_ROWS, small_scans, stage
from sparkledger.sources.storage import delete_path

# Split point between the "existing" and the "incoming" batch in the upsert queries
# (a timestamp_ntz, like the ship dates it is compared with: no session time zone).
UPSERT_CUTOFF = "1999-01-01 00:00:00"
# The department the row-policy principal may read.
ROW_POLICY_DEPARTMENT = "asia"
# Rows in the analyst's top-k proof report.
COLUMN_POLICY_TOP_K = 50

Query = Callable[[SparkSession, str], DataFrame]


def _grant_ref(df: DataFrame) -> DataFrame:
    """Project the drift map to a comparable column."""
    return (df.withColumn("grant_ref", F.element_at("raw_extras", F.lit("Grant Ref")))
              .drop("raw_extras"))


# ---- scalar parsing -------------------------------------------------------------------

def q_parse_amount(spark, sf_dir):
    return spend_ledger(spark, sf_dir).select(
        F.col("amount").alias("amount_raw"), casts.parse_amount("amount").alias("amount_gbp"))


def q_parse_date(spark, sf_dir):
    return spend_ledger(spark, sf_dir).select(
        F.col("payment_date").alias("payment_date_raw"),
        casts.parse_date("payment_date").alias("payment_date"))


def q_month_bucket(spark, sf_dir):
    return spend_ledger(spark, sf_dir).select(
        F.col("payment_date").alias("payment_date_raw"),
        casts.month_bucket(casts.parse_date("payment_date")).alias("payment_month"))


def q_credit_flag(spark, sf_dir):
    amount = casts.parse_amount("amount")
    return spend_ledger(spark, sf_dir).select(
        F.col("amount").alias("amount_raw"), amount.alias("amount_gbp"),
        casts.credit_flag(amount).alias("needs_review"))


def q_normalise_names(spark, sf_dir):
    return spend_ledger(spark, sf_dir).select(
        F.col("supplier_name").alias("supplier_raw"),
        casts.normalise_name("supplier_name").alias("supplier_name"))


def q_scalar_functions(spark, sf_dir):
    led = spend_ledger(spark, sf_dir)
    amount_text = F.trim(F.col("amount"))
    digits = F.regexp_replace(amount_text, r"[^0-9.\-]", "")
    amount_try = digits.try_cast("decimal(18,2)")
    key_text = F.concat_ws("|", F.col("source_department"), F.col("transaction_id"))
    bracketed = amount_text.like("(%)")
    day = casts.parse_date("payment_date")
    return led.select(
        F.col("transaction_id"),
        F.upper(F.col("source_department")).alias("department_upper"),
        casts.normalise_name("supplier_name").alias("supplier_title"),
        digits.alias("amount_digits"),
        bracketed.alias("is_bracketed"),
        amount_try.alias("amount_try"),
        amount_try.try_cast("bigint").alias("amount_whole"),
        F.sha2(key_text, 256).alias("key_sha256"),
        F.md5(key_text).alias("key_md5"),
        day.alias("payment_day"),
        F.date_format(day, "yyyy-MM").alias("payment_month"),
        F.when(amount_try.isNull(), "none").when(bracketed, "credit").otherwise("debit")
         .alias("amount_kind"),
        F.coalesce(casts.parse_amount("vat_amount"), F.lit(0).cast("decimal(18,2)"))
         .alias("vat_or_zero"),
        F.element_at("raw_extras", F.lit("Grant Ref")).alias("extra_code"),
        F.size("raw_extras").alias("extras_size"),
        (F.col("ingested_at").cast("date")).alias("ingested_day"),
    )


# ---- conform, drift, union --------------------------------------------------------------

def conformed_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every department's rows under its own header, conformed back and unioned.

    The ledger is staged once, by department; each feed reads its own partition."""
    led = stage(spend_ledger(spark, sf_dir), "ledger", ["source_department"])
    frames = []
    for dept, mapping in sorted(LEDGER_LAYOUTS.items()):
        raw = feed_frame(led, dept, mapping, LEDGER_DRIFT_COLUMNS.get(dept))
        frames.append(conform(raw, mapping, source_department=dept,
                              schema_version=LEDGER_SCHEMA_VERSION))
    return union_all_by_name(frames)


def q_conform_columns(spark, sf_dir):
    return _grant_ref(conformed_feeds(spark, sf_dir)).drop("ingested_at")


def q_schema_drift_extras(spark, sf_dir):
    return conformed_feeds(spark, sf_dir).select(
        "source_department", "source_file", "transaction_id",
        F.element_at("raw_extras", F.lit("Grant Ref")).alias("grant_ref"),
        F.size("raw_extras").alias("extras_size"))


def q_union_by_name(spark, sf_dir):
    led = stage(spend_ledger(spark, sf_dir), "ledger", ["source_department"])
    frames = [feed_frame(led, dept, mapping, LEDGER_DRIFT_COLUMNS.get(dept))
              .withColumn("source_department", F.lit(dept))
              for dept, mapping in sorted(LEDGER_LAYOUTS.items())]
    return union_all_by_name(frames).drop("ingested_at")


# ---- typed rows, hash, quality ----------------------------------------------------------

def q_record_hash(spark, sf_dir):
    typed = S.every_ledger_row_typed(spark, sf_dir)
    return typed.select("transaction_id", "source_department", "payment_date", "amount_gbp",
                        record_hash().alias("record_hash"))


def q_rejection_reasons(spark, sf_dir):
    return S.ledger_tagged(spark, sf_dir).select(
        "source_file", "transaction_id", F.col("amount_raw").alias("raw_amount"),
        F.col("payment_date_raw").alias("raw_date"), "rejection_reason")


def q_quarantine_split(spark, sf_dir):
    from sparkledger.operators.quality import rejected_rows
    return rejected_rows(S.ledger_tagged(spark, sf_dir))


def q_broadcast_lookup(spark, sf_dir):
    return S.every_ledger_row_typed(spark, sf_dir).select(
        "source_file", "transaction_id", "source_department", "department_group")


# ---- keep latest, silver --------------------------------------------------------------------

def q_dedup_latest(spark, sf_dir):
    return S.latest_valid(S.ledger_tagged(spark, sf_dir)).select(
        "transaction_id", "source_department", "payment_date", "amount_gbp", "supplier_name",
        "record_hash", "ingested_at")


def q_silver_build(spark, sf_dir):
    return _grant_ref(S.ledger_silver(spark, sf_dir))


# ---- joins ----------------------------------------------------------------------------------

ASSURANCE_COLUMNS = ["transaction_id", "source_department", "supplier_name", "cost_centre",
                     "approver", "budget_owner", "processing_status", "internal_notes",
                     "supplier_category", "risk_rating", "due_diligence_notes",
                     "missing_approval"]


def q_assurance_join(spark, sf_dir):
    return S.ledger_assured(spark, sf_dir).select(*ASSURANCE_COLUMNS)


def q_missing_approval(spark, sf_dir):
    return (S.ledger_assured(spark, sf_dir)
            .groupBy("source_department", "missing_approval")
            .agg(F.count(F.lit(1)).alias("transactions")))


# ---- marts ------------------------------------------------------------------------------------

def q_gold_metrics(spark, sf_dir):
    return S.ledger_gold(spark, sf_dir)


def q_gold_display(spark, sf_dir):
    return ordered_for_display(S.ledger_gold(spark, sf_dir))


def q_run_summary(spark, sf_dir):
    return run_summary(S.ledger_tagged(spark, sf_dir))


# ---- policy -----------------------------------------------------------------------------------

def q_open_layer(spark, sf_dir):
    return _grant_ref(S.ledger_open(spark, sf_dir))


def q_column_policy(spark, sf_dir):
    view = _grant_ref(column_policy(S.ledger_assured(spark, sf_dir), "analyst"))
    return (view.orderBy("payment_month", "transaction_id", "source_department")
            .limit(COLUMN_POLICY_TOP_K))


def q_row_policy(spark, sf_dir):
    view = row_policy(S.ledger_silver(spark, sf_dir), "source_department", ROW_POLICY_DEPARTMENT)
    return department_totals(view)


#: Principals of the governance queries; the session's own user holds the analyst's grants.
GRANTS = {
    "analyst": [Grant(levels=("public", "internal"))],
    "assurance": [Grant(levels=("public", "internal", "restricted"))],
    "regional": [Grant(row_filter=("source_department", "asia"))],
    "mixed": [Grant(levels=("public",)), Grant(row_filter=("source_department", "europe"))],
}


def _governance_tables(spark, sf_dir):
    """Temporary tables of the assured rows and of the grants."""
    rows = stage(_grant_ref(S.ledger_assured(spark, sf_dir)), "assured")
    user = spark.sql("SELECT session_user()").first()[0]
    rows.createOrReplaceTempView("assured_rows")
    grants = grants_table(spark, {**GRANTS, user: GRANTS["analyst"]})
    grants.createOrReplaceTempView("spend_grants")
    return rows, grants, user


def q_governed_view(spark, sf_dir):
    """What each principal reads through one dynamic view, and the session's user by name."""
    _governance_tables(spark, sf_dir)
    seen = []
    for principal in ["session", *sorted(GRANTS)]:
        who = "session_user()" if principal == "session" else f"'{principal}'"
        create_governed_view(spark, "spend_governed", "assured_rows", "spend_grants",
                             ["source_department"], principal=who)
        seen.append(spark.sql(f"""SELECT '{principal}' AS principal, source_department,
            count(*) AS rows_visible, count(transaction_id) AS ids, count(approver) AS approvers,
            count(risk_rating) AS ratings, CAST(sum(amount_gbp) AS DECIMAL(38,2)) AS spend
            FROM spend_governed GROUP BY source_department"""))
    return functools.reduce(DataFrame.unionByName, seen)


def q_denied_columns(spark, sf_dir):
    rows, grants, user = _governance_tables(spark, sf_dir)
    return denied_columns(rows, grants.filter(F.col("principal") != user), "source_department")


# ---- upserts -----------------------------------------------------------------------------------

def _split_batches(spark, sf_dir, scratch=None):
    # staged once: both batches read typed rows, not the ledger; silver has no evidence columns,
    # and the record hash is made again from the rows
    tagged = S.ledger_tagged(spark, sf_dir).drop(*[f"{c}_raw" for c in EVIDENCE], "record_hash")
    tagged = add_record_hash(stage(tagged, "tagged", None, scratch, SORTED_FILE_ROWS))
    cutoff = F.lit(UPSERT_CUTOFF).cast("timestamp_ntz")
    existing = S.build_silver(tagged.filter(F.col("ingested_at") < cutoff))
    incoming = S.build_silver(tagged.filter(F.col("ingested_at") >= cutoff))
    return existing, incoming


UPSERT_OUTPUT = ["transaction_id", "source_department", "payment_month", "payment_date",
                 "amount_gbp", "supplier_name", "record_hash", "ingested_at"]


def q_upsert_latest(spark, sf_dir):
    existing, incoming = _split_batches(spark, sf_dir)
    return upsert_latest(existing, incoming).select(*UPSERT_OUTPUT)


def q_upsert_hash_gated(spark, sf_dir):
    existing, incoming = _split_batches(spark, sf_dir)
    merged = hash_gated_merge(existing.drop("raw_extras"), incoming.drop("raw_extras"),
                              with_action=True)
    return merged.select(*UPSERT_OUTPUT, "merge_action")


def q_upsert_writer(spark, sf_dir):
    """The table writer: a stored first batch, a second one merged into it by hash, and the
    second delivered again, which must rewrite nothing."""
    from sparkledger.plans.pipeline import upsert_partitions
    from sparkledger.sources.sinks import read_parquet_or_none
    work, path = scratch_path(spark, "upsert-batches"), scratch_path(spark, "upsert-table")
    with small_scans(spark):
        existing, incoming = (
            add_record_hash(stage(b.drop("raw_extras", "record_hash"), "batch", scratch=work))
            for b in _split_batches(spark, sf_dir, f"{work}/tagged"))
    delete_path(spark, f"{work}/tagged")
    upsert_partitions(spark, path, existing, staged=True)
    upsert_partitions(spark, path, incoming, merge="hash_gated", staged=True)
    again = upsert_partitions(spark, path, incoming, merge="hash_gated", staged=True)
    if again.touched:
        raise RuntimeError("a batch delivered again rewrote partitions")
    delete_path(spark, work)
    return read_parquet_or_none(spark, path, existing.schema).select(*UPSERT_OUTPUT)


# ---- file routing -------------------------------------------------------------------------------

def q_source_routing(spark, sf_dir):
    return (spend_ledger(spark, sf_dir).select("source_file").distinct()
            .select("source_file", source_key(F.col("source_file")).alias("source_key")))


def q_parked_sources(spark, sf_dir):
    files = q_source_routing(spark, sf_dir)
    mapped = spark.createDataFrame([(k,) for k in sorted(LEDGER_FEEDS)], "source_key string")
    return files.join(F.broadcast(mapped), "source_key", "left_anti")


def queries() -> dict[str, Query]:
    from sparkledger.plans import filelane
    return {
        "gold_metrics": q_gold_metrics,
        "parse_amount": q_parse_amount,
        "parse_date": q_parse_date,
        "month_bucket": q_month_bucket,
        "credit_flag": q_credit_flag,
        "normalise_names": q_normalise_names,
        "scalar_functions": q_scalar_functions,
        "conform_columns": q_conform_columns,
        "schema_drift_extras": q_schema_drift_extras,
        "union_by_name": q_union_by_name,
        "record_hash": q_record_hash,
        "rejection_reasons": q_rejection_reasons,
        "quarantine_split": q_quarantine_split,
        "dedup_latest": q_dedup_latest,
        "silver_build": q_silver_build,
        "broadcast_lookup": q_broadcast_lookup,
        "assurance_join": q_assurance_join,
        "missing_approval": q_missing_approval,
        "run_summary": q_run_summary,
        "open_layer": q_open_layer,
        "column_policy": q_column_policy,
        "row_policy": q_row_policy,
        "upsert_latest": q_upsert_latest,
        "upsert_hash_gated": q_upsert_hash_gated,
        "governed_view": q_governed_view,
        "denied_columns": q_denied_columns,
        "upsert_writer": q_upsert_writer,
        "gold_display": q_gold_display,
        "source_routing": q_source_routing,
        "parked_sources": q_parked_sources,
        **filelane.queries(),
    }
