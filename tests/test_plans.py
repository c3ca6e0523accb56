"""Plan-shape regressions: properties that matter at scale, checked on the physical plan."""

import os
import re

import pytest

from sparkledger.plans import catalog as C
from sparkledger.plans import silver as S
from sparkledger.sources import ledger as L

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_fact_table_is_never_the_broadcast_side(spark):
    plan = _plan(S.ledger_silver(spark, SF_DIR))
    # Every broadcast exchange must sit over a dimension scan, never over lineitem.
    for block in plan.split("BroadcastExchange")[1:]:
        first_scan = re.search(r"FileScan parquet \[([^\]]*)\]", block)
        if first_scan:
            assert "l_orderkey" not in first_scan.group(1)
    assert "SortMergeJoin" in plan


def test_scans_read_only_needed_columns(spark):
    plan = _plan(C.q_parse_amount(spark, SF_DIR))
    lineitem = [m for m in re.findall(r"ReadSchema: struct<([^>]*)>", plan) if "l_orderkey" in m]
    assert lineitem and all("l_comment" not in m and "l_quantity" not in m for m in lineitem)
    assert all("l_discount" not in m for m in lineitem)


def test_keep_latest_has_a_partial_top1_and_parsers_run_once(spark):
    plan = _plan(S.ledger_silver(spark, SF_DIR))
    assert plan.count("WindowGroupLimit") >= 2  # partial (before shuffle) and final
    assert plan.count("gettimestamp") == 4       # one attempt per date format, not repeated


def test_row_policy_filter_reaches_the_aggregate_input(spark):
    plan = _plan(C.q_row_policy(spark, SF_DIR))
    assert "asia" in plan


def test_rejected_rows_are_parsed_once(spark):
    assert _plan(C.q_quarantine_split(spark, SF_DIR)).count("gettimestamp") == 4


@pytest.mark.parametrize("query", [C.q_upsert_latest, C.q_upsert_hash_gated])
def test_upserts_read_staged_rows_not_the_ledger(spark, query):
    plan = _plan(query(spark, SF_DIR))
    assert "l_orderkey" not in plan and "gettimestamp" not in plan


#: The JVM leaves longer methods to its interpreter.
COMPILED_BYTES = 8000


@pytest.mark.parametrize("query", [C.q_scalar_functions, C.q_silver_build, C.q_open_layer,
                                   C.q_gold_metrics, C.q_run_summary, C.q_rejection_reasons])
def test_fused_methods_are_short_enough_to_be_compiled(spark, query):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = query(spark, SF_DIR)._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    debug = spark.sparkContext._jvm.org.apache.spark.sql.execution.debug
    stages = debug.package.codegenStringSeq(plan)
    sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
    assert 0 < max(sizes) < COMPILED_BYTES


def test_line_items_are_dealt_out_once_for_the_approvals(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(L.approvals_ledger(spark, SF_DIR))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    by_customer = plan.split("hashpartitioning(o_custkey")[1]
    assert "Join" not in by_customer.split("FileScan")[0]
