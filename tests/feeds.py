"""Small inline spend feeds for pipeline tests (CSV text written to a temp folder)."""

from __future__ import annotations

import os

CABINET_2026_04 = """transaction_id,supplier_name,payment_date,amount,expense_area
CO-1,ACME LTD,01/04/2026,"£1,234.56",IT
CO-2,beta plc,02/04/2026,(500.00),Consultancy
CO-2,beta plc,02/04/2026,(500.00),Consultancy
CO-3, Gamma ,03/04/2026,250,Estates
"""

CABINET_2026_05_DRIFT = """transaction_id,supplier_name,payment_date,amount,expense_area,VAT,Programme Code
CO-4,ACME LTD,01/05/2026,"1,000.00",IT,200.00,P-9
"""

MOD_2026_04 = """Ref,Vendor,Payment Date,Gross (£),Cost Centre
MOD-1,Delta,01-Apr-2026,"£2,000.00",Ops
"""

MOD_2026_05_MALFORMED = """Ref,Vendor,Payment Date,Gross (£),Cost Centre
MOD-2,Delta,31-Feb-2026,INVALID,Ops
,Epsilon,02-May-2026,100,Ops
MOD-3,,03-May-2026,100,Ops
MOD-4,Zeta,04-May-2026,300,Ops
"""

DHSC_2026_04 = """Invoice ID,Supplier,Date Paid,Amount Paid,Category,VAT
DH-1,acme ltd,2026-04-10,400.00,Drugs,80.00
"""

UNKNOWN_2026_04 = """id,who,when,how_much
X-1,Someone,2026-04-01,1
"""

APPROVALS = """transaction_id,cost_centre,approver,budget_owner,processing_status,internal_notes
CO-1,CC1,b.approver,Owner A,Approved,ok
CO-1,CC1,a.approver,Owner A,Approved,ok
CO-2,CC2,c.approver,Owner B,Approved,credit note
MOD-1,CC9,d.approver,Owner C,,pending review
DH-1,CC7,e.approver,Owner D,Approved,
"""

SUPPLIERS = """supplier_name,supplier_category,risk_rating,due_diligence_notes
acme ltd,Strategic,High,watch
DELTA,Defence,Low,cleared
"""

FIRST_RUN = {
    "cabinet_office_spend_2026_04.csv": CABINET_2026_04,
    "cabinet_office_spend_2026_05_schemadrift.csv": CABINET_2026_05_DRIFT,
    "mod_spend_2026_04.csv": MOD_2026_04,
    "mod_spend_2026_05_malformed.csv": MOD_2026_05_MALFORMED,
    "dhsc_spend_2026_04.csv": DHSC_2026_04,
    "unknown_spend_2026_04.csv": UNKNOWN_2026_04,
}


def write(folder, files: dict[str, str]) -> None:
    os.makedirs(folder, exist_ok=True)
    for name, text in files.items():
        with open(os.path.join(folder, name), "w", encoding="utf-8") as fh:
            fh.write(text)


def landing(tmp_path, files=None):
    raw, ref, out = tmp_path / "raw", tmp_path / "reference", tmp_path / "out"
    write(raw, FIRST_RUN if files is None else files)
    write(ref, {"approvals_ledger.csv": APPROVALS, "supplier_reference.csv": SUPPLIERS})
    return str(raw), str(ref), str(out)
