from sparkledger.config import APPROVAL_COLUMNS, SUPPLIER_REFERENCE_COLUMNS
from sparkledger.operators.enrich import (attach_assurance, department_groups,
                                          prepare_approvals, prepare_suppliers)

APPROVAL_COLS = APPROVAL_COLUMNS


def test_approvals_and_suppliers_attach_without_fan_out(spark):
    silver = spark.createDataFrame([(f"k{i}", name) for i, name in enumerate(
        ["Elm", "Elm", "Oak & Sons", None])], "transaction_id string, supplier_name string")
    approvals = spark.createDataFrame([("k0", "c7", "kim", "lee", "Pending", None),
                                       ("k1", "c8", "kim", "lee", None, "no status"),
                                       ("k8", "c9", "kim", "lee", "Approved", None)],
                                      ", ".join(f"{c} string" for c in APPROVAL_COLUMNS))
    suppliers = spark.createDataFrame([("ELM ", "Tier 2", "Low", "b"), (" elm", "Tier 1", "High", "a")],
                                      SUPPLIER_REFERENCE_COLUMNS)
    out = attach_assurance(silver, prepare_approvals(approvals), prepare_suppliers(suppliers))
    assert sorted((r.transaction_id, r.cost_centre, r.missing_approval, r.supplier_category)
                  for r in out.collect()) == [
        ("k0", "c7", False, "Tier 1"), ("k1", "c8", True, "Tier 1"), ("k2", None, True, None),
        ("k3", None, True, None)]


def test_ledger_duplicates_keep_one_reproducible_row(spark):
    approvals = spark.createDataFrame([("T1", "CC2", "b", "O", "Approved", ""),
                                       ("T1", "CC1", "a", "O", "Approved", "")], APPROVAL_COLS)
    rows = prepare_approvals(approvals).collect()
    assert len(rows) == 1 and rows[0]["cost_centre"] == "CC1"


def test_department_group_lookup_is_a_broadcast_left_join(spark):
    df = spark.createDataFrame([("mod",), ("unknown",)], "source_department string")
    out = department_groups(df, {"mod": "Defence"})
    assert {r.source_department: r.department_group for r in out.collect()} == {"mod": "Defence", "unknown": None}
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()
