"""Independent SQL (DuckDB dialect) for every registered query.

Written from the operator semantics, not generated from the Spark plans: the spend
ledger, parsing rules, quarantine, keep-latest, joins and aggregates are spelled out in
plain SQL over the driver's tables, so agreement is evidence both sides are right.
"""

from __future__ import annotations

from sparkledger.config import BASELINE_LEVEL, CLASSIFICATION, LEDGER_DRIFT_COLUMNS, LEDGER_LAYOUTS, LEDGER_SCHEMA_VERSION

DATE_FORMATS_SQL = "['%d/%m/%Y', '%Y-%m-%d', '%d-%b-%Y', '%-d/%-m/%Y']"


def money_sql(x: str) -> str:
    t = f"trim({x})"
    value = f"TRY_CAST(regexp_replace({t}, '[^0-9.\\-]', '', 'g') AS DECIMAL(18,2))"
    return (f"(CASE WHEN regexp_matches({t}, '\\..*,') THEN CAST(NULL AS DECIMAL(18,2)) "
            f"WHEN regexp_matches({t}, '^[^0-9()]*\\([^()]*[0-9][^()]*\\)[^0-9()]*$') THEN -abs({value}) ELSE {value} END)")


def date_sql(x: str) -> str:
    return f"CAST(try_strptime(trim({x}), {DATE_FORMATS_SQL}) AS DATE)"


def initcap_sql(x: str) -> str:
    return (f"array_to_string(list_transform(string_split(lower(trim({x})), ' '), "
            f"lambda w: upper(left(w, 1)) || substr(w, 2)), ' ')")


def pence_money_sql(x: str) -> str:
    return f"CAST(CAST({x} AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,2))"


def fmt_sql(x: str) -> str:
    return f"format('{{:,.2f}}', {x})"


LEDGER_CTES = f"""
dept AS (
  SELECT c.c_custkey, replace(lower(r.r_name), ' ', '_') AS source_department
  FROM customer c
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey),
li AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_shipdate,
         d.source_department, s.s_name, p.p_type,
         CAST(round(l.l_extendedprice * 100) AS BIGINT) AS pence,
         CAST(round(l.l_tax * 100) AS BIGINT) AS tax_pct
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN dept d ON o.o_custkey = d.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN part p ON l.l_partkey = p.p_partkey),
li2 AS (
  SELECT *, {pence_money_sql('pence')} AS money,
         {pence_money_sql('(pence * tax_pct) // 100')} AS vat
  FROM li),
ledger AS (
  SELECT
    CASE WHEN l_partkey % 101 = 0 THEN ''
         ELSE CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) END AS transaction_id,
    CASE WHEN l_partkey % 103 = 0 THEN ''
         WHEN l_suppkey % 3 = 0 THEN '  ' || upper(s_name) || ' '
         WHEN l_suppkey % 3 = 1 THEN lower(s_name)
         ELSE s_name || ' trading ltd' END AS supplier_name,
    CASE WHEN l_partkey % 97 = 0 THEN '31/02/2026'
         WHEN l_suppkey % 4 = 0 THEN strftime(l_shipdate, '%d/%m/%Y')
         WHEN l_suppkey % 4 = 1 THEN strftime(l_shipdate, '%Y-%m-%d')
         WHEN l_suppkey % 4 = 2 THEN strftime(l_shipdate, '%d-%b-%Y')
         ELSE strftime(l_shipdate, '%-d/%-m/%Y') END AS payment_date,
    CASE WHEN l_partkey % 89 = 0 THEN 'INVALID'
         WHEN l_orderkey % 4 = 0 THEN '£' || {fmt_sql('money')}
         WHEN l_orderkey % 4 = 1 AND l_partkey % 5 = 0 THEN {fmt_sql('money')} || ' (inc VAT)'
         WHEN l_orderkey % 4 = 1 AND l_partkey % 5 = 1
           THEN 'GBP ' || {fmt_sql('money')} || ' (refund) (see note)'
         WHEN l_orderkey % 4 = 1 THEN {fmt_sql('money')}
         WHEN l_orderkey % 4 = 2 THEN CAST(money AS VARCHAR)
         ELSE '(' || {fmt_sql('money')} || ')' END AS amount,
    p_type AS expense_category,
    CASE WHEN source_department IN ('africa', 'asia') THEN CAST(vat AS VARCHAR) END AS vat_amount,
    CASE WHEN source_department = 'africa'
         THEN 'PC-' || CAST(l_partkey % 50 AS VARCHAR) END AS grant_ref,
    CASE WHEN source_department = 'africa' THEN 1 ELSE 0 END AS extras_size,
    source_department,
    source_department || '_spend_' || strftime(l_shipdate, '%Y_%m') || '.csv' AS source_file,
    '{LEDGER_SCHEMA_VERSION}' AS schema_version,
    l_shipdate AS ingested_at
  FROM li2)"""

TYPED_CTES = LEDGER_CTES + f""",
routed AS (
  SELECT * FROM ledger
  WHERE split_part(source_file, '_spend_', 1) IN ('africa', 'america', 'asia', 'europe')),
typed0 AS (
  SELECT transaction_id, source_department, source_file, schema_version, expense_category,
         grant_ref, ingested_at,
         supplier_name AS supplier_raw,
         amount AS amount_raw, payment_date AS payment_date_raw,
         {money_sql('amount')} AS amount_gbp,
         {money_sql('vat_amount')} AS vat_amount_gbp,
         {date_sql('payment_date')} AS payment_date,
         {initcap_sql('supplier_name')} AS supplier_name
  FROM routed),
typed AS (
  SELECT *,
    strftime(payment_date, '%Y-%m') AS payment_month,
    coalesce(amount_gbp < 0, false) AS needs_review,
    sha256(concat_ws('|', coalesce(transaction_id, ''), source_department,
                     coalesce(CAST(payment_date AS VARCHAR), ''),
                     coalesce(CAST(amount_gbp AS VARCHAR), ''))) AS record_hash,
    CASE source_department WHEN 'africa' THEN 'Southern' WHEN 'america' THEN 'Western'
         WHEN 'asia' THEN 'Eastern' END AS department_group,
    NULLIF(concat_ws('; ',
      CASE WHEN transaction_id IS NULL OR trim(transaction_id) = '' THEN 'missing_transaction_id' END,
      CASE WHEN supplier_name IS NULL OR trim(supplier_name) = '' THEN 'missing_supplier' END,
      CASE WHEN payment_date IS NULL THEN 'invalid_payment_date' END,
      CASE WHEN amount_gbp IS NULL THEN 'invalid_amount' END), '') AS rejection_reason
  FROM typed0)"""

# every department, the unmapped one too
ALL_TYPED_CTES = TYPED_CTES.replace(
    "WHERE split_part(source_file, '_spend_', 1) IN ('africa', 'america', 'asia', 'europe')", "")

LATEST_ORDER = ("ingested_at DESC NULLS LAST, record_hash DESC NULLS LAST, "
                "payment_date DESC NULLS LAST, amount_gbp DESC NULLS LAST, "
                "supplier_name DESC NULLS LAST, expense_category DESC NULLS LAST, "
                "vat_amount_gbp DESC NULLS LAST, source_file DESC NULLS LAST, "
                "grant_ref DESC NULLS LAST")


def latest_sql(source: str) -> str:
    return (f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER ("
            f"PARTITION BY coalesce(transaction_id, record_hash), source_department "
            f"ORDER BY {LATEST_ORDER}) AS rn FROM {source}) WHERE rn = 1")


SILVER_COLS_SQL = ("record_hash, transaction_id, source_department, department_group, "
                   "payment_month, payment_date, supplier_name, amount_gbp, vat_amount_gbp, "
                   "expense_category, needs_review, grant_ref, schema_version, "
                   "source_file, ingested_at")

SILVER_CTES = TYPED_CTES + f""",
valid AS (SELECT * FROM typed WHERE rejection_reason IS NULL),
silver AS ({latest_sql('valid')})"""

ASSURANCE_SQL = ("cost_centre, approver, budget_owner, processing_status, internal_notes, "
                 "supplier_category, risk_rating, due_diligence_notes, missing_approval")

ASSURED_CTES = SILVER_CTES + """,
appr_raw AS (
  SELECT CASE WHEN l.l_orderkey % 20 < 17 THEN '' ELSE 'old/' END
           || CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS transaction_id,
         'CC-' || CAST(l.l_partkey % 40 AS VARCHAR) AS cost_centre,
         replace(lower(c.c_name), 'customer#', 'approver.') AS approver,
         'owner-' || CAST(c.c_nationkey AS VARCHAR) AS budget_owner,
         CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Approved'
              WHEN o.o_orderpriority = '3-MEDIUM' THEN 'Pending'
              WHEN o.o_orderpriority = '5-LOW' THEN 'Rejected' END AS processing_status,
         'order status ' || o.o_orderstatus AS internal_notes
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey),
approvals AS (
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id
    ORDER BY cost_centre ASC NULLS LAST, approver ASC NULLS LAST, budget_owner ASC NULLS LAST,
             processing_status ASC NULLS LAST, internal_notes ASC NULLS LAST) AS rn
  FROM appr_raw) WHERE rn = 1),
supp_raw AS (
  SELECT """ + initcap_sql(
    "CASE WHEN s_suppkey % 7 = 0 THEN 'formerly ' ELSE '' END || "
    "CASE WHEN s_suppkey % 3 = 0 THEN '  ' || upper(s_name) || ' ' "
    "WHEN s_suppkey % 3 = 1 THEN lower(s_name) ELSE s_name || ' trading ltd' END") + """ AS supplier_name,
         'Tier ' || CAST(s_nationkey % 3 + 1 AS VARCHAR) AS supplier_category,
         CASE WHEN s_acctbal < 0 THEN 'High' WHEN s_acctbal < 5000 THEN 'Medium' ELSE 'Low' END AS risk_rating,
         'checked nation ' || CAST(s_nationkey AS VARCHAR) AS due_diligence_notes
  FROM supplier),
suppliers AS (
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY supplier_name
    ORDER BY supplier_category ASC NULLS LAST, risk_rating ASC NULLS LAST,
             due_diligence_notes ASC NULLS LAST) AS rn
  FROM supp_raw) WHERE rn = 1),
assured AS (
  SELECT s.*, a.cost_centre, a.approver, a.budget_owner, a.processing_status, a.internal_notes,
         p.supplier_category, p.risk_rating, p.due_diligence_notes,
         a.processing_status IS NULL AS missing_approval
  FROM silver s
  LEFT JOIN approvals a ON s.transaction_id = a.transaction_id
  LEFT JOIN suppliers p ON s.supplier_name = p.supplier_name)"""


def gold_sql(source: str) -> str:
    s = "CAST(sum(CAST(amount_gbp * 100 AS BIGINT)) AS BIGINT)"
    n = "count(amount_gbp)"
    avg = pence_money_sql(f"sign({s}) * ((2 * abs({s}) + {n}) // (2 * {n}))")
    return f"""SELECT source_department, department_group, payment_month,
  {pence_money_sql(s)} AS total_spend,
  count(*) AS transaction_count,
  count(DISTINCT supplier_name) AS supplier_count,
  count(*) FILTER (WHERE needs_review) AS credit_count,
  {avg} AS avg_amount
FROM {source} GROUP BY source_department, department_group, payment_month"""


UPSERT_CUTOFF_SQL = "TIMESTAMP '1999-01-01 00:00:00'"

UPSERT_CTES = TYPED_CTES + f""",
valid_old AS (SELECT * FROM typed WHERE rejection_reason IS NULL AND ingested_at < {UPSERT_CUTOFF_SQL}),
valid_new AS (SELECT * FROM typed WHERE rejection_reason IS NULL AND ingested_at >= {UPSERT_CUTOFF_SQL}),
existing AS ({latest_sql('valid_old')}),
incoming AS ({latest_sql('valid_new')})"""

UPSERT_OUTPUT_SQL = ("transaction_id, source_department, payment_month, payment_date, "
                     "amount_gbp, supplier_name, record_hash, ingested_at")


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body}"


def union_sql() -> str:
    """Every region's rows under its own headers, the others' headers NULL."""
    headers: list[str] = []
    for region in sorted(LEDGER_LAYOUTS):
        names = [*LEDGER_LAYOUTS[region], *LEDGER_DRIFT_COLUMNS.get(region, [])]
        headers += [h for h in names if h not in headers]
    parts = []
    for region, mapping in sorted(LEDGER_LAYOUTS.items()):
        own = {**mapping, **{d: "grant_ref" for d in LEDGER_DRIFT_COLUMNS.get(region, [])}}
        cols = ", ".join(f'CAST({own.get(h, "NULL")} AS VARCHAR) AS "{h}"' for h in headers)
        parts.append(f"SELECT {cols}, source_file, source_department FROM ledger "
                     f"WHERE source_department = '{region}'")
    return "\nUNION ALL\n".join(parts)


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["gold_metrics"] = _with(SILVER_CTES, gold_sql("silver"))
    q["parse_amount"] = _with(LEDGER_CTES, f"SELECT amount AS amount_raw, {money_sql('amount')} AS amount_gbp FROM ledger")
    q["parse_date"] = _with(LEDGER_CTES, f"SELECT payment_date AS payment_date_raw, {date_sql('payment_date')} AS payment_date FROM ledger")
    q["month_bucket"] = _with(LEDGER_CTES, f"SELECT payment_date AS payment_date_raw, strftime({date_sql('payment_date')}, '%Y-%m') AS payment_month FROM ledger")
    q["credit_flag"] = _with(LEDGER_CTES, f"SELECT amount AS amount_raw, {money_sql('amount')} AS amount_gbp, coalesce({money_sql('amount')} < 0, false) AS needs_review FROM ledger")
    q["normalise_names"] = _with(LEDGER_CTES, f"SELECT supplier_name AS supplier_raw, {initcap_sql('supplier_name')} AS supplier_name FROM ledger")
    digits = "regexp_replace(trim(amount), '[^0-9.\\-]', '', 'g')"
    amount_try = f"TRY_CAST({digits} AS DECIMAL(18,2))"
    key_text = "concat_ws('|', source_department, transaction_id)"
    q["scalar_functions"] = _with(LEDGER_CTES, f"""SELECT transaction_id,
  upper(source_department) AS department_upper,
  {initcap_sql('supplier_name')} AS supplier_title,
  {digits} AS amount_digits,
  trim(amount) LIKE '(%)' AS is_bracketed,
  {amount_try} AS amount_try,
  TRY_CAST(trunc({amount_try}) AS BIGINT) AS amount_whole,
  sha256({key_text}) AS key_sha256,
  md5({key_text}) AS key_md5,
  {date_sql('payment_date')} AS payment_day,
  strftime({date_sql('payment_date')}, '%Y-%m') AS payment_month,
  CASE WHEN {amount_try} IS NULL THEN 'none' WHEN trim(amount) LIKE '(%)' THEN 'credit' ELSE 'debit' END AS amount_kind,
  coalesce({money_sql('vat_amount')}, CAST(0 AS DECIMAL(18,2))) AS vat_or_zero,
  grant_ref AS extra_code,
  CAST(extras_size AS INTEGER) AS extras_size,
  CAST(ingested_at AS DATE) AS ingested_day
FROM ledger""")
    conformed = ("SELECT trim(transaction_id) AS transaction_id, supplier_name, payment_date, amount, "
                 "expense_category, vat_amount, grant_ref, extras_size, source_department, "
                 f"'{LEDGER_SCHEMA_VERSION}' AS schema_version, source_file FROM ledger")
    q["conform_columns"] = _with(LEDGER_CTES + f",\nconformed AS ({conformed})",
                                 "SELECT * EXCLUDE (extras_size) FROM conformed")
    q["schema_drift_extras"] = _with(LEDGER_CTES + f",\nconformed AS ({conformed})",
                                     "SELECT source_department, source_file, transaction_id, grant_ref, "
                                     "CAST(extras_size AS INTEGER) AS extras_size FROM conformed")
    q["union_by_name"] = _with(LEDGER_CTES, union_sql())
    q["record_hash"] = _with(ALL_TYPED_CTES, "SELECT transaction_id, source_department, payment_date, amount_gbp, record_hash FROM typed")
    q["rejection_reasons"] = _with(TYPED_CTES, "SELECT source_file, transaction_id, amount_raw AS raw_amount, payment_date_raw AS raw_date, rejection_reason FROM typed")
    q["quarantine_split"] = _with(TYPED_CTES, "SELECT source_file, source_department, transaction_id, amount_raw AS raw_amount, payment_date_raw AS raw_date, rejection_reason, ingested_at FROM typed WHERE rejection_reason IS NOT NULL")
    q["broadcast_lookup"] = _with(ALL_TYPED_CTES, "SELECT source_file, transaction_id, source_department, department_group FROM typed")
    q["dedup_latest"] = _with(SILVER_CTES, "SELECT transaction_id, source_department, payment_date, amount_gbp, supplier_name, record_hash, ingested_at FROM silver")
    q["silver_build"] = _with(SILVER_CTES, f"SELECT {SILVER_COLS_SQL} FROM silver")
    q["assurance_join"] = _with(ASSURED_CTES, """SELECT transaction_id, source_department, supplier_name, cost_centre,
  approver, budget_owner, processing_status, internal_notes, supplier_category, risk_rating,
  due_diligence_notes, missing_approval FROM assured""")
    q["missing_approval"] = _with(ASSURED_CTES, "SELECT source_department, missing_approval, count(*) AS transactions FROM assured GROUP BY source_department, missing_approval")
    q["run_summary"] = _with(TYPED_CTES, """SELECT source_file, source_department,
  count(*) AS rows_read,
  count(DISTINCT CASE WHEN rejection_reason IS NULL THEN transaction_id END) AS rows_valid,
  count(*) FILTER (WHERE rejection_reason IS NOT NULL) AS rows_rejected,
  count(*) - count(DISTINCT CASE WHEN rejection_reason IS NULL THEN transaction_id END)
    - count(*) FILTER (WHERE rejection_reason IS NOT NULL) AS duplicates_removed
FROM typed GROUP BY source_file, source_department""")
    q["open_layer"] = _with(ASSURED_CTES, f"""SELECT {SILVER_COLS_SQL}, cost_centre, processing_status,
  supplier_category, missing_approval FROM assured""")
    q["column_policy"] = _with(ASSURED_CTES, f"""SELECT {SILVER_COLS_SQL}, cost_centre, processing_status,
  supplier_category, missing_approval
FROM assured ORDER BY payment_month, transaction_id, source_department LIMIT 50""")
    q["row_policy"] = _with(SILVER_CTES, """SELECT source_department, count(*) AS rows_visible,
  CAST(sum(amount_gbp) AS DECIMAL(38,2)) AS total_spend
FROM silver WHERE source_department = 'asia' GROUP BY source_department ORDER BY source_department""")
    q["upsert_latest"] = _with(UPSERT_CTES + ",\nboth_batches AS (SELECT * FROM existing UNION ALL SELECT * FROM incoming)",
                               f"SELECT {UPSERT_OUTPUT_SQL} FROM ({latest_sql("both_batches")})")
    pick = ("(s.transaction_id IS NOT NULL AND (t.transaction_id IS NULL "
            "OR t.record_hash IS NULL OR t.record_hash <> s.record_hash))")
    cols = ", ".join(f"CASE WHEN {pick} THEN s.{c} ELSE t.{c} END AS {c}"
                     for c in UPSERT_OUTPUT_SQL.split(", "))
    q["upsert_hash_gated"] = _with(UPSERT_CTES, f"""SELECT {cols},
  CASE WHEN t.transaction_id IS NULL THEN 'insert' WHEN s.transaction_id IS NULL THEN 'keep'
       WHEN {pick} THEN 'update' ELSE 'unchanged' END AS merge_action
FROM existing t FULL OUTER JOIN incoming s
  ON t.transaction_id = s.transaction_id AND t.source_department = s.source_department""")
    levels = ", ".join(f"('{c}', '{level}')" for c, level in CLASSIFICATION.items())
    hidden = [c.strip() for c in f"{SILVER_COLS_SQL}, {ASSURANCE_SQL}".split(",")
              if c.strip() != "source_department"]
    every = {"session": "true", "analyst": "true", "assurance": "true",
             "regional": "source_department = 'asia'", "mixed": "true"}
    shown = {"session": ("true", "false"), "analyst": ("true", "false"),
             "assurance": ("true", "true"), "regional": ("true", "true"),
             "mixed": ("source_department = 'europe'", "source_department = 'europe'")}
    q["governed_view"] = _with(ASSURED_CTES, "\nUNION ALL\n".join(
        f"""SELECT '{p}' AS principal, source_department, count(*) AS rows_visible,
  count(CASE WHEN {shown[p][0]} THEN transaction_id END) AS ids,
  count(CASE WHEN {shown[p][1]} THEN approver END) AS approvers,
  count(CASE WHEN {shown[p][1]} THEN risk_rating END) AS ratings,
  CAST(sum(amount_gbp) AS DECIMAL(38,2)) AS spend
FROM assured WHERE {every[p]} GROUP BY source_department""" for p in every))
    counts = "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, source_department, count({c}) AS n FROM assured "
        "GROUP BY source_department" for c in hidden)
    q["denied_columns"] = _with(ASSURED_CTES, f""", counts AS ({counts}),
levels(column_name, level) AS (VALUES {levels}),
held(principal, level) AS (VALUES ('analyst', 'public'), ('analyst', 'internal'),
  ('assurance', 'public'), ('assurance', 'internal'), ('assurance', 'restricted'),
  ('mixed', 'public')),
filters(principal, source_department) AS (VALUES ('regional', 'asia'), ('mixed', 'europe')),
principals(principal) AS (VALUES ('analyst'), ('assurance'), ('regional'), ('mixed')),
needed AS (
  SELECT p.principal, c.column_name, c.source_department, c.n,
         coalesce(l.level, '{BASELINE_LEVEL}') AS level
  FROM counts c LEFT JOIN levels l ON l.column_name = c.column_name, principals p)
SELECT n.principal, n.column_name, n.level,
       CAST(sum(CASE WHEN f.principal IS NULL THEN n.n ELSE 0 END) AS BIGINT) AS hidden_values
FROM needed n LEFT JOIN held h ON h.principal = n.principal AND h.level = n.level
LEFT JOIN filters f ON f.principal = n.principal AND f.source_department = n.source_department
WHERE h.principal IS NULL GROUP BY ALL""")
    q["upsert_writer"] = _with(UPSERT_CTES, f"""SELECT {cols}
FROM existing t FULL OUTER JOIN incoming s
  ON t.transaction_id = s.transaction_id AND t.source_department = s.source_department""")
    q["gold_display"] = _with(SILVER_CTES, f"""SELECT *, CAST(row_number() OVER (
  ORDER BY source_department, payment_month, department_group NULLS FIRST) AS INTEGER) AS position
FROM ({gold_sql("silver")})""")
    q["source_routing"] = _with(LEDGER_CTES, "SELECT DISTINCT source_file, split_part(source_file, '_spend_', 1) AS source_key FROM ledger")
    q["parked_sources"] = _with(LEDGER_CTES, """SELECT DISTINCT split_part(source_file, '_spend_', 1) AS source_key, source_file FROM ledger
WHERE split_part(source_file, '_spend_', 1) NOT IN ('africa', 'america', 'asia', 'europe')""")
    from sparkledger.plans.filelane import oracle_sql as filelane_sql
    q.update(filelane_sql())
    return q
