"""Independent DuckDB SQL for every registered query.

The oracles never parse JSON: they compute each answer directly from the
driver's base tables (``orders``, ``lineitem``, ``customer``, ``events``,
``part``), following the fixture's packing rules, so the Spark side's
parse + explode + dedup + key logic is checked by a separate path.
"""

from __future__ import annotations

from loanweave.plans.oracle_paths import outer_columns_sql, path_drift_sql, schema_drift_sql, schema_sql

# --------------------------------------------------------------------------- shared CTEs

_BASE = """
o AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority,
         CAST(o_custkey AS VARCHAR) AS loan_id, CAST(o_orderkey AS VARCHAR) AS sid,
         sha256(CAST(o_custkey AS VARCHAR)) AS loan_uuid
  FROM orders),
vis AS (SELECT * FROM o WHERE o_orderstatus <> 'P'),
lat AS (SELECT * FROM vis
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, sid DESC) = 1),
li AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
         l_tax, l_returnflag, l_linestatus, l_shipdate,
         concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                   strftime(l_shipdate, '%Y%m%d')) AS lid,
         'S' || l_suppkey AS supp,
         -- the fixture writes ship times as whole seconds or as days
         date_trunc('second', l_shipdate) AS ship_s,
         CAST(date_trunc('day', l_shipdate) AS TIMESTAMP) AS ship_d,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY
             l_linenumber NULLS FIRST, l_partkey NULLS FIRST, l_suppkey NULLS FIRST,
             l_shipdate NULLS FIRST, l_quantity NULLS FIRST, l_extendedprice NULLS FIRST,
             l_discount NULLS FIRST, l_tax NULLS FIRST, l_returnflag NULLS FIRST,
             l_linestatus NULLS FIRST) AS pos
  FROM lineitem)"""

_EVENTS = """
ev AS (
  SELECT user_id, ts, event_id, event_type, CAST(ts AS DATE) AS day,
         CASE WHEN event_id % 2 = 0 THEN '7' ELSE '13' END AS chapter,
         CASE event_type WHEN 'error' THEN 'petitioned' WHEN 'purchase' THEN 'discharged'
                         ELSE event_type END AS status
  FROM events)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def _ranked(name: str, cond: str) -> str:
    """Lines matching ``cond`` with their rank ``k`` inside the order's payload."""
    return f"""
{name} AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY pos) AS k
           FROM li WHERE {cond})"""


def _days(a: str, n: int, base: str = "ship_s") -> str:
    return f"{a}.{base} + INTERVAL {n} DAY"


def _dec(expr: str, spec: str) -> str:
    """Double -> decimal as Spark does it: round half-up on the shortest text."""
    return f"CAST(CAST({expr} AS VARCHAR) AS DECIMAL({spec}))"


# --------------------------------------------------------------------- table columns

def _sale(a: str) -> str:
    f = f"{a}.l_linestatus = 'F'"
    return f"""{a}.ship_s AS created_time, {a}.ship_s AS sale_date,
  {a}.supp AS debt_buyer_name, CAST({a}.l_partkey AS VARCHAR) AS loan_task_id,
  {a}.l_discount AS percentage_sold, {a}.l_extendedprice AS sale_amount,
  {a}.l_tax AS sale_fees_amount, {a}.l_quantity AS sale_interest_amount,
  {a}.l_extendedprice AS sale_principal_amount,
  CAST({a}.l_linenumber AS VARCHAR) AS debt_sale_file_id, {a}.ship_d AS debt_sale_file_date,
  {a}.lid AS debt_sale_file_uuid,
  CASE WHEN {f} THEN {_days(a, 30, "ship_d")} END AS rebuy_date,
  CASE WHEN {f} THEN {a}.l_quantity END AS rebuy_amount,
  CASE WHEN {f} THEN 'reversal' END AS rebuy_reason,
  CASE WHEN {f} THEN {a}.lid END AS rebuy_file_uuid,
  CASE WHEN {f} THEN {_days(a, 30)} END AS rebuy_time,
  {a}.lid AS loan_debt_sale_uuid"""


def _settlement(a: str, loan: str) -> str:
    return f"""{a}.l_extendedprice AS total_amount, {a}.l_linestatus AS status,
  {_days(a, 30)} AS end_date, {a}.ship_s AS start_date,
  CASE WHEN {a}.l_orderkey IS NOT NULL THEN 'ach' END AS payment_method,
  {a}.supp AS structure, {a}.l_quantity AS payment_count, {a}.ship_s AS created_time,
  sha256(concat_ws('', {loan}, {a}.ship_s)) AS loan_servicing_settlement_uuid"""


def _installment(a: str, key: str) -> str:
    return f"""{a}.lid AS active_installment_id, {a}.l_tax AS interest_amount,
  {a}.l_extendedprice AS principal_amount, {a}.l_discount AS late_fees_amount,
  {a}.ship_s AS adjusted_effective_date, {a}.ship_d AS original_effective_date,
  sha256({key}) AS active_installment_uuid"""


def _collection(a: str, loan: str) -> str:
    return f"""{a}.lid AS case_type, {a}.ship_s AS start_date, {_days(a, 90)} AS end_date,
  'Agency ' || {a}.l_suppkey AS collection_agency_name,
  'agency' || {a}.l_suppkey || '@example.com' AS collection_agency_email,
  '555-' || {a}.l_suppkey AS collection_agency_phone,
  {a}.ship_d AS poa_effective_date,
  sha256(concat_ws('', {loan}, {a}.ship_s)) AS loan_collection_case_uuid"""


def _owner(a: str, loan: str, money: str) -> str:
    f = f"{a}.l_linestatus = 'F'"
    return f"""{a}.supp AS legal_entity, {a}.supp AS financial_owner_name,
  {a}.l_returnflag AS financial_owner_type, {a}.lid AS financial_owner_uuid,
  {a}.ship_s AS effective_date,
  CASE WHEN {f} THEN {_days(a, 30)} END AS termination_date,
  CASE WHEN {f} THEN 'sold' END AS termination_reason,
  {a}.l_linestatus AS marketplace_status,
  CAST({_dec(f"{a}.l_discount * 100", "12,2")} AS {money}) AS marketplace_premium,
  CAST({_dec(f"{a}.l_extendedprice", "12,2")} AS {money}) AS marketplace_final_principal_ar_amount,
  CAST({_dec(f"{a}.l_quantity", "12,2")} AS {money}) AS marketplace_final_interest_ar_amount,
  sha256(concat_ws('', {loan}, {a}.ship_s, {a}.supp)) AS loan_financial_owner_uuid"""


def _operational(a: str, snap: str) -> str:
    return f"""{a}.lid AS operational_charge_off_uuid, {a}.ship_s AS charge_off_date,
  {a}.l_returnflag AS charge_off_reason, 'A' || {snap}.o_custkey AS servicing_account_id,
  CASE WHEN {a}.l_returnflag = 'R' THEN {_days(a, 60)} END AS forgiveness_date,
  {a}.l_quantity AS write_off_amount, {a}.l_tax AS charge_off_fees_amount,
  {a}.l_discount AS charge_off_interest_amount, {a}.l_extendedprice AS charge_off_principal_amount"""


def _original(a: str, key: str, money: str) -> str:
    return f"""{a}.lid AS original_installment_id, {a}.ship_s AS installment_date,
  CAST({_dec(f"{a}.l_tax", "12,2")} AS {money}) AS interest_amount,
  CAST({_dec(f"{a}.l_extendedprice", "12,2")} AS {money}) AS principal_amount,
  CAST({a}.l_partkey AS VARCHAR) AS installment_schedule_id,
  sha256({key}) AS original_installment_uuid"""


def _treasury(a: str, snap: str) -> str:
    return f"""{a}.lid AS treasury_charge_off_uuid, 'A' || {snap}.o_custkey AS servicing_account_id,
  {a}.ship_s AS effective_date, {a}.l_returnflag AS charge_off_reason,
  {a}.ship_s AS created_time, {a}.lid AS treasury_charge_off_id,
  CASE WHEN {a}.l_linestatus = 'O' THEN {_days(a, 5)} END AS reverted_time,
  {a}.ship_s AS updated_time, {a}.lid AS source_uuid,
  CASE WHEN {a}.l_orderkey IS NOT NULL THEN 'order' END AS source_type,
  {a}.l_linestatus = 'F' AS revertible_flag"""


E18, E10 = "DECIMAL(18,2)", "DECIMAL(10,0)"

# Line filters of the fixture's payloads.
COND = {
    "sale_info": "l_returnflag = 'R'",
    "settlements": "l_returnflag = 'A'",
    "collection_cases": "l_returnflag = 'N' AND l_linestatus = 'O'",
    "operational_charge_offs": "l_linestatus = 'F'",
    "treasury_charge_offs": "l_returnflag = 'R'",
}


def _per_element(cond: str | None, cols: str, distinct: bool = False) -> str:
    where = f"WHERE li.{cond.replace(' AND ', ' AND li.')}" if cond else ""
    return (_with(_BASE) + f"SELECT {'DISTINCT ' if distinct else ''}lat.loan_id, lat.loan_uuid, "
            f"{cols}\nFROM lat JOIN li ON li.l_orderkey = lat.o_orderkey {where}")


def _observed(frame: str, cond: str | None, fan: str, index: int, cols: str,
              distinct: bool = False, keep_all: bool = False) -> str:
    """``frame`` rows, values from the ``index``-th (1-based) matching line,
    repeated once per line of the fan-out payload."""
    ranked = _ranked("r", cond or "TRUE")
    join = "LEFT JOIN" if keep_all or index > 1 else "JOIN"
    fan_sql = {"all": "JOIN li m ON m.l_orderkey = f.o_orderkey",
               "cond": "JOIN r m ON m.l_orderkey = f.o_orderkey",
               "none": ""}[fan]
    return (_with(_BASE, ranked) +
            f"SELECT {'DISTINCT ' if distinct else ''}f.loan_id, f.loan_uuid, {cols}\n"
            f"FROM {frame} f {join} r a ON a.l_orderkey = f.o_orderkey AND a.k = {index}\n"
            f"{fan_sql}")


TABLES: dict[str, str] = {
    "loan_debt_sale": _per_element(COND["sale_info"], _sale("li")),
    "loan_servicing_settlement": _per_element(COND["settlements"],
                                              _settlement("li", "lat.loan_id")),
    "active_installment": _per_element(None, _installment("li", "li.lid")),
    "loan_collection_case": _per_element(COND["collection_cases"],
                                         _collection("li", "lat.loan_id")),
    "loan_financial_owner": _per_element(None, _owner("li", "lat.loan_id", E18)),
    "operational_charge_off": _per_element(COND["operational_charge_offs"],
                                           _operational("li", "lat")),
    "original_installment": _per_element(None, _original("li", "li.lid", E18), distinct=True),
    "treasury_charge_off": _per_element(COND["treasury_charge_offs"], _treasury("li", "lat")),
}

OBSERVED: dict[str, str] = {
    # latest, sale_info non-empty, x every owner (= every line), first sale.
    "loan_debt_sale_observed": _observed("lat", COND["sale_info"], "all", 1, _sale("a")),
    "loan_servicing_settlement_observed": _observed(
        "lat", COND["settlements"], "all", 1, _settlement("a", "f.loan_id")),
    "active_installment_observed": _observed("lat", None, "all", 1, _installment("a", "f.sid")),
    "loan_collection_case_observed": _observed(
        "lat", COND["collection_cases"], "cond", 1, _collection("a", "f.loan_id")),
    # visible (not latest), x every owner, values of the second owner.
    "loan_financial_owner_observed": _observed(
        "vis", None, "all", 2, _owner("a", "f.loan_id", E10)),
    "operational_charge_off_observed": _observed(
        "lat", COND["operational_charge_offs"], "cond", 1, _operational("a", "f")),
    "original_installment_observed": _observed(
        "vis", None, "all", 1, _original("a", "f.sid", E10), distinct=True),
    # latest, no filter and no fan-out: one row per loan.
    "treasury_charge_off_observed": _observed(
        "lat", COND["treasury_charge_offs"], "none", 1, _treasury("a", "f"), keep_all=True),
}

def _first(status: str, as_type: str) -> str:
    """Earliest time of the day's events with ``status``; NULL when one of
    them has no time (the minimum is then undefined, as on the Spark side)."""
    m = f"min(ts) FILTER (WHERE status = '{status}')"
    if as_type == "DATE":
        m = f"CAST({m} AS DATE)"
    else:
        m = f"strftime({m}, '%Y-%m-%d %H:%M:%S.%f')"
    return f"CASE WHEN bool_or(status = '{status}' AND ts IS NULL) THEN NULL ELSE {m} END"


# Loans with bankruptcy payloads are those whose customer has events.
TABLES["bankruptcy"] = _with(_BASE, _EVENTS, """
lastev AS (SELECT user_id, day, chapter, status FROM ev
           QUALIFY row_number() OVER (PARTITION BY user_id, day ORDER BY ts DESC NULLS LAST,
                                      status DESC NULLS LAST, chapter DESC NULLS LAST) = 1),
days AS (SELECT user_id, day,
                """ + _first("petitioned", "DATE") + """ AS petitioned_date,
                """ + _first("discharged", "DATE") + """ AS discharged_date,
                row_number() OVER (PARTITION BY user_id ORDER BY day NULLS FIRST) - 1 AS ordinal
         FROM ev GROUP BY user_id, day)""") + """
SELECT lat.loan_id, lat.loan_uuid, CAST(NULL AS VARCHAR) AS claimed_date,
       d.petitioned_date, d.discharged_date,
       sha256(concat_ws('', lat.loan_id, 'timeline', d.ordinal)) AS bankruptcy_uuid,
       l.chapter, l.status
FROM lat JOIN days d ON d.user_id = lat.o_custkey
JOIN lastev l ON l.user_id = d.user_id AND l.day IS NOT DISTINCT FROM d.day
UNION ALL
SELECT lat.loan_id, lat.loan_uuid, strftime(e.ts, '%Y-%m-%d') AS claimed_date,
       CAST(NULL AS DATE) AS petitioned_date, CAST(NULL AS DATE) AS discharged_date,
       sha256(concat_ws('', lat.loan_id, strftime(e.ts, '%Y-%m-%d'))) AS bankruptcy_uuid,
       e.chapter, 'filed' AS status
FROM lat JOIN ev e ON e.user_id = lat.o_custkey AND e.event_type = 'signup'"""

OBSERVED["bankruptcy_observed"] = _with(_BASE, _EVENTS, """
cl AS (SELECT user_id, ts, event_id, chapter, strftime(ts, '%Y-%m-%d') AS eff,
              row_number() OVER (PARTITION BY user_id
                                 ORDER BY ts NULLS FIRST, event_id NULLS FIRST) AS k
       FROM ev WHERE event_type = 'signup'),
agg AS (SELECT user_id, string_agg(eff, '' ORDER BY ts NULLS FIRST, event_id NULLS FIRST)
               AS all_dates
        FROM cl GROUP BY user_id)""") + """
SELECT lat.loan_id, lat.loan_uuid, f.eff AS claimed_date,
       CAST(NULL AS DATE) AS petitioned_date, CAST(NULL AS DATE) AS discharged_date,
       sha256(concat_ws('', lat.loan_id, a.all_dates)) AS claims_hash,
       f.chapter, 'filed' AS status
FROM lat JOIN agg a ON a.user_id = lat.o_custkey
JOIN cl f ON f.user_id = lat.o_custkey AND f.k = 1
JOIN cl m ON m.user_id = lat.o_custkey"""

_RATE = """
ir AS (SELECT l_orderkey, CAST(""" + _dec("l_tax", "4,2") + """ AS VARCHAR) AS interest_rate,
              strftime(l_shipdate, '%Y-%m-%d') AS effective_date FROM li)"""


def _rate_cols(loan: str, a: str) -> str:
    key = f"sha256(concat_ws('', {loan}, {a}.interest_rate, {a}.effective_date))"
    return f"""{a}.interest_rate, {a}.effective_date, {key} AS interest_rate_uuid,
  {key} AS interest_rate_id, 'False' AS inactive_flag, 'False' AS source_type,
  {loan} AS source_uuid, 'False' AS cap_flag"""


TABLES["interest_rate"] = _with(_BASE, _RATE) + f"""
SELECT lat.loan_id, lat.loan_uuid, {_rate_cols('lat.loan_id', 'ir')},
       lat.o_orderdate AS created_time, lat.o_orderdate + INTERVAL 1 DAY AS updated_time,
       lat.o_orderdate + INTERVAL 30 DAY AS end_date
FROM lat LEFT JOIN ir ON ir.l_orderkey = lat.o_orderkey"""

OBSERVED["interest_rate_observed"] = _with(_BASE, _RATE, """
ent AS (SELECT v.loan_id AS jl, ir.interest_rate, ir.effective_date, count(*) AS entry_count
        FROM vis v JOIN ir ON ir.l_orderkey = v.o_orderkey GROUP BY ALL),
ver AS (SELECT loan_id, count(*) AS version_count FROM vis GROUP BY loan_id)""") + f"""
SELECT ver.loan_id, {_rate_cols('ver.loan_id', 'e')},
       coalesce(e.entry_count, 0) AS entry_count, ver.version_count,
       coalesce(e.entry_count, 1) * ver.version_count AS row_count
FROM ver LEFT JOIN ent e ON e.jl = ver.loan_id"""

OBSERVED["interest_rate_observed_versions"] = _with(_BASE, """
sched AS (SELECT v.loan_id AS jl, count(*) AS schedule_rows
          FROM vis v JOIN li ON li.l_orderkey = v.o_orderkey GROUP BY 1)""") + """
SELECT v.loan_id, v.sid AS id, v.loan_uuid, v.o_orderdate AS created_time,
       v.o_orderdate + INTERVAL 1 DAY AS updated_time, v.o_orderdate + INTERVAL 30 DAY AS end_date,
       coalesce(s.schedule_rows, 0) AS schedule_rows
FROM vis v LEFT JOIN sched s ON s.jl = v.loan_id"""

_CENTRAL = "timezone('America/Chicago', timezone('UTC', {}))"

TABLES["payment_plan"] = _with(_BASE, """
pv AS (SELECT * FROM vis WHERE EXISTS (SELECT 1 FROM lineitem x WHERE x.l_orderkey = vis.o_orderkey)
       QUALIFY row_number() OVER (PARTITION BY loan_id ORDER BY o_orderdate DESC, sid DESC) = 1),
pl AS (
  SELECT pv.*, li.*,
         (['standard', 'loan_mod_trial', 'term_extension_trial', 'deferment', 'long_term'])
           [li.l_linenumber % 5 + 1] AS plan_type,
         CASE li.l_returnflag WHEN 'A' THEN 'completed' WHEN 'R' THEN 'terminated'
                              ELSE 'active' END AS st,
         CASE WHEN li.l_linestatus = 'F' THEN li.l_shipdate + INTERVAL 60 DAY END AS adj_end,
         CASE WHEN li.l_returnflag = 'R' THEN li.l_shipdate + INTERVAL 45 DAY END AS early_term,
         li.l_shipdate + INTERVAL 90 DAY AS end_d,
         CASE WHEN li.l_linestatus = 'O' THEN li.l_shipdate + INTERVAL 10 DAY END AS adj_lock,
         """ + _CENTRAL.format("li.ship_d + INTERVAL '03:04:05'") + """ AS created_c
  FROM pv JOIN li ON li.l_orderkey = pv.o_orderkey),
pt AS (SELECT *, plan_type IN ('loan_mod_trial', 'term_extension_trial') AS trial FROM pl)""") + """
SELECT TRY_CAST(pt.o_custkey AS INTEGER) AS loan_id, pt.loan_uuid, pt.o_orderpriority AS payment_method,
  TRY_CAST(pt.o_custkey AS INTEGER) AS customer_id,
  CASE WHEN c.c_mktsegment IN ('FURNITURE', 'MACHINERY') THEN 15 ELSE 10 END AS grace_period_days,
  CASE WHEN trial AND st = 'completed' THEN 'locked_in' ELSE st END AS status,
  CAST(l_shipdate + INTERVAL 7 DAY AS DATE) AS lock_in_date,
  """ + _dec("l_extendedprice", "12,2") + """ AS total_amount,
  """ + _dec("l_quantity", "12,2") + """ AS payment_amount,
  CAST(CASE WHEN trial AND st = 'terminated' THEN early_term
            WHEN NOT trial THEN coalesce(adj_end, early_term, end_d) END AS DATE) AS adjusted_end_date,
  CAST(l_shipdate + INTERVAL 30 DAY AS DATE) AS first_payment_date,
  CAST(early_term AS DATE) AS early_terminate_date,
  CAST(CASE WHEN trial AND st = 'completed' THEN coalesce(adj_end, end_d)
            ELSE adj_lock END AS DATE) AS adjusted_lock_in_date,
  l_linestatus = 'F' AS troubled_debt_restructuring_flag,
  TRY_CAST(l_partkey AS INTEGER) AS loan_payment_plan_id,
  CASE WHEN plan_type IN ('deferment', 'long_term') THEN CAST(created_c AS DATE)
       ELSE CAST(l_shipdate AS DATE) END AS start_date,
  CASE WHEN NOT trial THEN CAST(end_d AS DATE) END AS end_date,
  created_c AS created_time,
  CASE plan_type WHEN 'loan_mod_trial' THEN 'apr_reduction'
                 WHEN 'term_extension_trial' THEN 'term_extension' ELSE plan_type END AS structure,
  lid AS loan_payment_plan_uuid,
  CASE WHEN l_suppkey % 2 = 0 THEN 'monthly' ELSE 'biweekly' END AS frequency,
  TRY_CAST(l_orderkey AS INTEGER) AS contract_id,
  CAST(l_shipdate AS DATE) AS contract_signed_date,
  TRY_CAST(l_suppkey AS INTEGER) AS created_by_portal_id,
  strftime(l_shipdate + INTERVAL 30 DAY, '%Y-%m-%d') || '|' ||
    strftime(l_shipdate + INTERVAL 60 DAY, '%Y-%m-%d') AS payment_dates_text,
  'v' || (l_linenumber % 3) AS rule_version,
  CASE WHEN NOT trial AND st = 'completed' THEN CAST(coalesce(adj_end, end_d) AS DATE) END
    AS completed_date,
  CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate + INTERVAL 120 DAY AS DATE) END
    AS lateness_reset_date,
  l_returnflag = 'N' AS freezes_lateness_flag,
  pt.o_orderdate AS etl_ingestion_time, pt.o_orderdate AS source_file_creation_time,
  """ + _CENTRAL.format("ship_d + INTERVAL 1 DAY + INTERVAL '23:30:00'") + """ AS updated_time
FROM pt LEFT JOIN customer c ON c.c_custkey = pt.o_custkey"""


# ------------------------------------------------------------------------- operators

_SEGMENT_STATE = ("CASE c.c_mktsegment WHEN 'FURNITURE' THEN 'CA' WHEN 'MACHINERY' THEN 'MO' "
                  "ELSE 'TX' END")

OPERATORS: dict[str, str] = {
    "snapshot_scan": """
SELECT CAST(o_custkey AS VARCHAR) AS loan_id, CAST(o_orderkey AS VARCHAR) AS id,
       o_orderstatus = 'P' AS dark, o_orderdate AS published_at,
       o_orderdate AS portfolios_created_at, o_orderdate AS accounts_created_at,
       o_orderdate + INTERVAL 1 DAY AS accounts_updated_at,
       o_orderdate + INTERVAL 30 DAY AS accounts_build_end_time,
       'A' || o_custkey AS servicing_account_id,
       o_orderdate AS etl_ingestion_time, o_orderdate AS source_file_creation_time
FROM orders""",
    "rename_by_mapping": """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus, o_totalprice,
       o_orderdate, o_orderpriority
FROM orders""",
    "visible_rows": """
SELECT CAST(o_custkey AS VARCHAR) AS loan_id, CAST(o_orderkey AS VARCHAR) AS id
FROM orders WHERE o_orderstatus <> 'P'""",
    "latest_per_key": _with(_BASE) + "SELECT loan_id, sid AS id, o_orderdate AS published_at FROM lat",
    "non_empty_payload": """
SELECT CAST(o_custkey AS VARCHAR) AS loan_id, CAST(o_orderkey AS VARCHAR) AS id
FROM orders WHERE EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = orders.o_orderkey)""",
    "json_object_fields": f"""
SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS loan_id,
       sha256(CAST(o_custkey AS VARCHAR)) AS loan_uuid, o_orderpriority AS payment_method,
       {_SEGMENT_STATE} AS origination_state, CAST(o_orderkey % 60 AS VARCHAR) AS term
FROM orders LEFT JOIN customer c ON c.c_custkey = orders.o_custkey""",
    "json_array_elements": _with(_BASE) + """
SELECT o.sid AS id, CAST(count(*) OVER (PARTITION BY li.l_orderkey) AS INTEGER) AS n_elements,
       CAST(li.pos - 1 AS INTEGER) AS pos, li.lid AS element_id
FROM o JOIN li ON li.l_orderkey = o.o_orderkey""",
    "json_array_rows": _with(_BASE) + """
SELECT v.sid AS id, li.lid AS installment_id, li.l_extendedprice AS principal_amount,
       li.ship_s AS adjusted_effective_date
FROM vis v JOIN li ON li.l_orderkey = v.o_orderkey""",
    "array_nth": _with(_BASE) + """
SELECT o.sid AS id, li.lid AS second_id
FROM o LEFT JOIN li ON li.l_orderkey = o.o_orderkey AND li.pos = 2""",
    "json_path": """
SELECT event_id,
       TRY_CAST(trunc(TRY_CAST(json_extract_string(CASE WHEN json_valid(props) THEN props END,
                                                   '$.k') AS DOUBLE)) AS INTEGER) AS k
FROM events""",
    "json_array_or_object": """
SELECT 'event' AS source, CAST(event_id AS VARCHAR) AS key,
       CASE json_type(CASE WHEN json_valid(props) THEN props END)
            WHEN 'OBJECT' THEN 1
            WHEN 'ARRAY' THEN CAST(json_array_length(props) AS INTEGER)
            ELSE 0 END AS n_elements
FROM events
UNION ALL
SELECT 'snapshot' AS source, CAST(o_orderkey AS VARCHAR) AS key,
       CAST((SELECT count(*) FROM lineitem l WHERE l.l_orderkey = orders.o_orderkey) AS INTEGER)
         AS n_elements
FROM orders""",
    "surrogate_key": """
SELECT l_orderkey, l_linenumber,
       sha256(concat_ws('', l_orderkey, l_linenumber, l_shipdate)) AS row_key
FROM lineitem""",
    "hash_concat": """
SELECT o_orderkey,
       sha256(CAST(o_orderkey AS VARCHAR)) ||
       sha256(CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END) AS pair_hash
FROM orders""",
    "child_ordinal": _with(_BASE) + """
SELECT lat.sid AS id, CAST(li.pos - 1 AS INTEGER) AS ordinal, li.lid AS installment_id,
       CAST(row_number() OVER (PARTITION BY li.l_orderkey ORDER BY li.ship_s NULLS FIRST, li.pos)
            AS INTEGER) AS date_rank
FROM lat JOIN li ON li.l_orderkey = lat.o_orderkey""",
    "typed_casts": """
SELECT p_partkey, TRY_CAST(p_brand AS INTEGER) AS brand_as_int, p_size AS size_as_int,
       p_size AS size_fraction_as_int,
       """ + _dec("p_retailprice", "12,2") + """ AS price_as_decimal,
       TRY_CAST('1998-01-' || lpad(CAST(p_size AS VARCHAR), 2, '0') AS DATE) AS day_as_date,
       CASE WHEN p_size % 3 = 0 THEN true WHEN p_size % 3 = 1 THEN false
            ELSE TRY_CAST(p_type AS BOOLEAN) END AS flag_as_bool
FROM part""",
    "utc_to_central": """
SELECT event_id, ts, timezone('America/Chicago', timezone('UTC', ts)) AS central_ts FROM events""",
    "distinct_rows": "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem",
    "left_join_children": """
SELECT o.o_orderkey, o.o_orderdate, f.first_ship_date
FROM orders o LEFT JOIN (SELECT l_orderkey, min(l_shipdate) AS first_ship_date
                         FROM lineitem GROUP BY l_orderkey) f ON f.l_orderkey = o.o_orderkey""",
    "first_event_dates": _with(_BASE, _EVENTS) + """
SELECT lat.loan_id, """ + _first("petitioned", "TEXT") + """ AS first_petitioned,
       """ + _first("discharged", "TEXT") + """ AS first_discharged
FROM lat JOIN ev ON ev.user_id = lat.o_custkey
GROUP BY lat.loan_id""",
}

OPERATORS["table_row_counts"] = "\nUNION ALL\n".join(
    f"SELECT '{name}' AS table_name, (SELECT count(*) FROM ({sql}) t) AS n_rows"
    for name, sql in TABLES.items())

OPERATORS["sink_roundtrip"] = (
    "SELECT t.*, TIMESTAMP '2024-01-02 06:00:00' AS extract_timestamp, "
    f"DATE '2024-01-02' AS extract_date FROM ({TABLES['active_installment']}) t")

OPERATORS["latest_by_ids"] = OPERATORS["latest_of_buckets"] = _with(_BASE) + """
SELECT loan_id, sid AS id, o_orderdate AS published_at,
       (SELECT count(*) FROM lineitem l WHERE l.l_orderkey = lat.o_orderkey)::INT AS n_installments
FROM lat"""

OPERATORS["published_date"] = "\nUNION ALL\n".join(
    f"SELECT '{name}' AS table_name, DATE '2024-01-02' AS extract_date, loan_id, count(*) AS n_rows "
    f"FROM ({TABLES[name]}) t GROUP BY loan_id" for name in ("active_installment", "treasury_charge_off"))


# Keys of each payload element as the fixture writes them: name -> (line
# filter, [(key, condition under which it is present)]).  NULL values are
# not written, so conditional fields count only where they hold (and only
# where their source column is set, see _KEY_SOURCE).
_F, _O, _R = "l_linestatus = 'F'", "l_linestatus = 'O'", "l_returnflag = 'R'"
_PAYLOAD_KEYS: dict[str, tuple[str, list[tuple[str, str]]]] = {
    "sale_info": (COND["sale_info"], [
        ("uuid", ""), ("sale_date", ""), ("debt_buyer", ""), ("loan_task_id", ""),
        ("percentage_sold", ""), ("sale_amount", ""), ("sale_fees_amount", ""),
        ("sale_interest_amount", ""), ("sale_principal_amount", ""), ("debt_sale_file_id", ""),
        ("debt_sale_file_date", ""), ("debt_sale_file_uuid", ""), ("rebuy_date", _F),
        ("rebuy_amount", _F), ("rebuy_reason", _F), ("rebuy_file_uuid", _F),
        ("rebuy_transaction_timestamp", _F), ("sale_transaction_timestamp", "")]),
    "settlements": (COND["settlements"], [(k, "") for k in (
        "amount", "status", "end_date", "start_date", "payment_method", "settlement_type",
        "number_of_payments", "transaction_timestamp")]),
    "installments": ("TRUE", [
        ("id", ""), ("interest_amount", ""), ("principal_amount", ""),
        ("late_fees_amount", "before_split"), ("adjusted_effective_date", ""),
        ("original_effective_date", ""), ("currency", "NOT before_split")]),
    "original_installments": ("TRUE", [(k, "") for k in (
        "id", "installment_date", "original_interest", "original_principal",
        "installment_schedule_id")]),
    "financial_owners": ("TRUE", [
        ("legal_entity", ""), ("financial_owner", ""), ("financial_owner_type", ""),
        ("uuid", ""), ("financial_owner_eff_date", ""),
        ("financial_owner_termination_date", _F), ("financial_owner_termination_reason", _F),
        ("marketplace_status", ""), ("marketplace_premium", ""),
        ("marketplace_final_principal_ar", ""), ("marketplace_final_interest_ar", "")]),
    "collection_cases": (COND["collection_cases"], [(k, "") for k in (
        "case_type", "start_date", "end_date", "agency_name", "agency_email", "agency_phone",
        "poa_effective_date")]),
    "operational_charge_offs": (COND["operational_charge_offs"], [
        ("uuid", ""), ("charge_off_date", ""), ("charge_off_reason", ""),
        ("forgiveness_date", _R), ("write_off_amount", ""), ("charge_off_amount", "")]),
    "treasury_charge_offs": (COND["treasury_charge_offs"], [
        ("uuid", ""), ("effective_date", ""), ("charge_off_reason", ""),
        ("transaction_timestamp", ""), ("id", ""), ("reverted_at", _O), ("updated_at", ""),
        ("source_uuid", ""), ("source_type", ""), ("revertible", "")]),
    "payment_plans": ("TRUE", [
        ("status", ""), ("lock_in_date", ""), ("total_amount", ""), ("payment_amount", ""),
        ("adjusted_end_date", _F), ("first_payment_date", ""), ("early_terminate_date", _R),
        ("adjusted_lock_in_date", _O), ("tdr", ""), ("id", ""), ("start_date", ""),
        ("end_date", ""), ("created_timestamp", ""), ("plan_type", ""), ("uuid", ""),
        ("frequency", ""), ("contract_id", ""), ("contract_signed_datetime", ""),
        ("created_by_id", ""), ("payment_dates", ""), ("rule_version", ""),
        ("freezes_lateness", ""), ("lateness_reset_date", _F), ("updated_at", "")]),
}


# The line column each key is rendered from: ``to_json`` leaves a key out
# when its value is NULL, so it counts only where that column is set.
_SHIP, _SUPP, _DISC, _EXT, _QTY, _TAX = ("l_shipdate", "l_suppkey", "l_discount",
                                         "l_extendedprice", "l_quantity", "l_tax")
_KEY_SOURCE: dict[str, dict[str, str]] = {
    "sale_info": {
        "sale_date": _SHIP, "debt_buyer": _SUPP, "loan_task_id": "l_partkey",
        "percentage_sold": _DISC, "sale_amount": _EXT, "sale_fees_amount": _TAX,
        "sale_interest_amount": _QTY, "sale_principal_amount": _EXT,
        "debt_sale_file_id": "l_linenumber", "debt_sale_file_date": _SHIP, "rebuy_date": _SHIP,
        "rebuy_amount": _QTY, "rebuy_transaction_timestamp": _SHIP,
        "sale_transaction_timestamp": _SHIP},
    "settlements": {
        "amount": _EXT, "status": "l_linestatus", "end_date": _SHIP, "start_date": _SHIP,
        "settlement_type": _SUPP, "number_of_payments": _QTY, "transaction_timestamp": _SHIP},
    "installments": {
        "interest_amount": _TAX, "principal_amount": _EXT, "late_fees_amount": _DISC,
        "adjusted_effective_date": _SHIP, "original_effective_date": _SHIP},
    "original_installments": {
        "installment_date": _SHIP, "original_interest": _TAX, "original_principal": _EXT,
        "installment_schedule_id": "l_partkey"},
    "financial_owners": {
        "legal_entity": _SUPP, "financial_owner": _SUPP,
        "financial_owner_type": "l_returnflag", "financial_owner_eff_date": _SHIP,
        "financial_owner_termination_date": _SHIP, "marketplace_status": "l_linestatus",
        "marketplace_premium": _DISC, "marketplace_final_principal_ar": _EXT,
        "marketplace_final_interest_ar": _QTY},
    "collection_cases": {
        "start_date": _SHIP, "end_date": _SHIP, "agency_name": _SUPP, "agency_email": _SUPP,
        "agency_phone": _SUPP, "poa_effective_date": _SHIP},
    "operational_charge_offs": {
        "charge_off_date": _SHIP, "charge_off_reason": "l_returnflag",
        "forgiveness_date": _SHIP, "write_off_amount": _QTY},
    "treasury_charge_offs": {
        "effective_date": _SHIP, "transaction_timestamp": _SHIP, "reverted_at": _SHIP,
        "updated_at": _SHIP, "revertible": "l_linestatus"},
    "payment_plans": {
        "lock_in_date": _SHIP, "total_amount": _EXT, "payment_amount": _QTY,
        "adjusted_end_date": _SHIP, "first_payment_date": _SHIP, "early_terminate_date": _SHIP,
        "adjusted_lock_in_date": _SHIP, "tdr": "l_linestatus", "id": "l_partkey",
        "start_date": _SHIP, "end_date": _SHIP, "created_timestamp": _SHIP,
        "plan_type": "l_linenumber", "contract_id": "l_orderkey",
        "contract_signed_datetime": _SHIP, "created_by_id": _SUPP, "payment_dates": _SHIP,
        "rule_version": "l_linenumber", "freezes_lateness": "l_returnflag",
        "lateness_reset_date": _SHIP, "updated_at": _SHIP},
}


def _key_drift_sql() -> str:
    parts = []
    for payload, (cond, keys) in _PAYLOAD_KEYS.items():
        for key, when in keys:
            pres = f" AND ({when})" if when else ""
            src = _KEY_SOURCE.get(payload, {}).get(key)
            if src:
                pres += f" AND {src} IS NOT NULL"
            parts.append(
                f"SELECT '{payload}' AS payload, '{key}' AS key, "
                f"count(*) FILTER (WHERE before_split) AS b, "
                f"count(*) FILTER (WHERE NOT before_split) AS a "
                f"FROM ol WHERE ({cond}){pres}")
    parts.append("SELECT 'bankruptcy_timeline', 'event_history', "
                 "count(*) FILTER (WHERE before_split), count(*) FILTER (WHERE NOT before_split) "
                 "FROM one JOIN (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events) e "
                 "ON e.user_id = one.o_custkey")
    for key in ("status", "chapter", "effective_date"):
        present = " AND e.ts IS NOT NULL" if key == "effective_date" else ""
        parts.append(f"SELECT 'bankruptcy_claims', '{key}', "
                     "count(*) FILTER (WHERE before_split), "
                     "count(*) FILTER (WHERE NOT before_split) "
                     "FROM one JOIN events e ON e.user_id = one.o_custkey "
                     f"AND e.event_type = 'signup'{present}")
    for payload, key, source in (
            ("loan_data", "term", "o_orderkey"), ("loan_data", "loan_id", "o_custkey"),
            ("loan_data", "loan_uuid", "o_custkey"), ("loan_data", "payment_method", "o_orderpriority"),
            ("loan_data", "origination_state", "1"), ("loan_data", "interest_rate_schedule", "1"),
            ("customer_information", "customer_id", "o_custkey")):
        parts.append(f"SELECT '{payload}', '{key}', count(*) FILTER (WHERE before_split), "
                     f"count(*) FILTER (WHERE NOT before_split) FROM os WHERE {source} IS NOT NULL")
    return ("WITH os AS (SELECT o_orderkey, o_custkey, o_orderpriority, "
            "o_orderdate < TIMESTAMP '1998-01-01' AS before_split FROM orders),\n"
            # a half holds a customer's events once, on the newest version
            "one AS (SELECT DISTINCT o_custkey, before_split FROM os),\n"
            "ol AS (SELECT os.before_split, l.* FROM os JOIN lineitem l "
            "ON l.l_orderkey = os.o_orderkey),\n"
            "c AS (" + "\nUNION ALL\n".join(parts) + ")\n"
            "SELECT payload, key, b AS before_count, a AS after_count, "
            "CASE WHEN b = 0 THEN 'added' WHEN a = 0 THEN 'removed' ELSE 'kept' END AS status "
            "FROM c WHERE a + b > 0")


OPERATORS["payload_key_drift"] = _key_drift_sql()

# Outer columns of the two drift halves, as (name, type before,
# type after, status, source column that may be NULL); a column after the
# removed one moves by one place.
_OUTER = [
    ("loan_id", "string", "string", "same", "o_custkey"), ("id", "string", "string", "same", "o_orderkey"),
    ("dark", "boolean", "boolean", "same", "o_orderstatus"),
    ("published_at", "timestamp_ntz", "timestamp_ntz", "same", None),
    ("portfolios_created_at", "timestamp_ntz", "timestamp_ntz", "same", None),
    ("accounts_created_at", "timestamp_ntz", "timestamp_ntz", "same", None),
    ("accounts_updated_at", "timestamp_ntz", "timestamp_ntz", "same", None),
    ("accounts_build_end_time", "timestamp_ntz", None, "removed", None),
    ("servicing_account_id", "string", "string", "position_changed", "o_custkey"),
    ("etl_ingestion_time", "timestamp_ntz", "date", "type_changed", None),
    ("source_file_creation_time", "timestamp_ntz", "timestamp_ntz", "position_changed", None),
    *[(c, "string", "string", "position_changed", None) for c in (
        "loan_data", "customer_information", "sale_info", "settlements", "installments", "bankruptcy_timeline",
        "bankruptcy_claims", "collection_cases", "financial_owners", "operational_charge_offs", "original_installments",
        "treasury_charge_offs", "payment_plans")],
    ("servicing_region", None, "string", "added", "o_custkey"), ("*", None, None, "different", None),
]
OPERATORS["outer_schema_drift"] = outer_columns_sql(_OUTER)
OPERATORS["payload_path_drift"] = path_drift_sql(_PAYLOAD_KEYS, _KEY_SOURCE)
OPERATORS["payload_schema"] = schema_sql(_PAYLOAD_KEYS, _KEY_SOURCE)
OPERATORS["schema_drift"] = schema_drift_sql(_PAYLOAD_KEYS, _KEY_SOURCE, _OUTER)

ORACLE_SQL: dict[str, str] = {**TABLES, **OBSERVED, **OPERATORS}
