"""DuckDB SQL of the path-level drift and schema reports.

Every path of every payload column is one aggregate over the base tables,
following the fixture's packing rules: how often it occurs, how many objects
could hold it and its JSON type, in each of two halves.  No JSON is read.
"""

from __future__ import annotations

#: JSON type of each key's value where it is no string.  ``number``: written from a
#: double, which gets an exponent when it is very large or very small.
KEY_TYPE: dict[str, dict[str, str]] = {
    "sale_info": {"loan_task_id": "long", "debt_sale_file_id": "long", **{k: "number" for k in (
        "percentage_sold", "sale_amount", "sale_fees_amount", "sale_interest_amount", "sale_principal_amount", "rebuy_amount")}},
    "settlements": {"amount": "number", "number_of_payments": "number"},
    "installments": {"interest_amount": "number", "principal_amount": "number", "late_fees_amount": "number"},
    "original_installments": {"original_interest": "decimal", "original_principal": "decimal", "installment_schedule_id": "long"},
    "financial_owners": {"marketplace_premium": "decimal", "marketplace_final_principal_ar": "decimal",
                         "marketplace_final_interest_ar": "decimal"},
    "operational_charge_offs": {"write_off_amount": "number", "charge_off_amount": "object"},
    "treasury_charge_offs": {"revertible": "boolean"},
    "payment_plans": {"payment_amount": "decimal", "tdr": "boolean", "id": "long", "contract_id": "long", "created_by_id": "long"},
}
SPLIT = "o_orderdate < TIMESTAMP '1998-01-01'"


def _row(payload: str, path: str, kind: str, source: str, holder: str = "TRUE", present: str = "TRUE", value: str = "") -> str:
    """One path over the rows of ``source``: ``holder`` rows could hold it, those that are ``present`` too do."""
    cols = []
    for side, half in (("b", "before_split"), ("a", "NOT before_split")):
        here = f"{half} AND ({holder})"
        t = f"'{kind}'"
        if kind == "number":
            t = (f"CASE WHEN count(*) FILTER (WHERE {here} AND ({present}) AND (abs({value}) >= 1e7 OR ({value} <> 0 AND abs({value}) < 1e-3)))"
                 " > 0 THEN 'double' ELSE 'decimal' END")
        cols.append(f"count(*) FILTER (WHERE {here} AND ({present})) AS n{side}, "
                    f"count(*) FILTER (WHERE {here}) AS h{side}, {t} AS t{side}")
    return f"SELECT '{payload}' AS payload, '{path}' AS path, {', '.join(cols)} FROM {source}"


def _rows(payload_keys: dict, key_source: dict) -> list[str]:
    out = []
    for payload, (cond, keys) in payload_keys.items():
        out.append(_row(payload, "$", "array", "os"))
        out.append(_row(payload, "$[]", "object", "ol", cond))
        for key, when in keys:
            column = key_source.get(payload, {}).get(key)
            present = " AND ".join(f"({x})" for x in (when, f"{column} IS NOT NULL" if column else "") if x) or "TRUE"
            out.append(_row(payload, f"$[].{key}", KEY_TYPE.get(payload, {}).get(key, "string"), "ol", cond, present, column or ""))
    cond = payload_keys["operational_charge_offs"][0]
    for key, column in (("fees", "l_tax"), ("interest", "l_discount"), ("principal", "l_extendedprice")):
        out.append(_row("operational_charge_offs", f"$[].charge_off_amount.{key}", "number", "ol", cond, f"{column} IS NOT NULL", column))
    days = "(SELECT DISTINCT before_split, user_id, CAST(ts AS DATE) AS d FROM oe) days"
    out += [_row("bankruptcy_timeline", "$", "array", "os"), _row("bankruptcy_timeline", "$[]", "object", days),
            _row("bankruptcy_timeline", "$[].event_history", "array", days),
            _row("bankruptcy_timeline", "$[].event_history[]", "object", "oe")]
    for key, present in (("date", "ts IS NOT NULL"), ("status", "event_type IS NOT NULL"), ("chapter", "TRUE"), ("event_id", "event_id IS NOT NULL")):
        out.append(_row("bankruptcy_timeline", f"$[].event_history[].{key}", "string", "oe", present=present))
    signup = "event_type = 'signup'"
    out += [_row("bankruptcy_claims", "$", "array", "os"), _row("bankruptcy_claims", "$[]", "object", "oe", signup)]
    for key, present in (("status", "TRUE"), ("chapter", "TRUE"), ("effective_date", "ts IS NOT NULL")):
        out.append(_row("bankruptcy_claims", f"$[].{key}", "string", "oe", signup, present))
    out += [_row("loan_data", "$", "object", "os"), _row("customer_information", "$", "object", "os"),
            _row("customer_information", "$.customer_id", "long", "os", present="o_custkey IS NOT NULL")]
    for key, kind, present in (("term", "long", "o_orderkey IS NOT NULL"), ("loan_id", "string", "o_custkey IS NOT NULL"),
                               ("loan_uuid", "string", "o_custkey IS NOT NULL"), ("payment_method", "string", "o_orderpriority IS NOT NULL"),
                               ("origination_state", "string", "TRUE"), ("interest_rate_schedule", "array", "TRUE")):
        out.append(_row("loan_data", f"$.{key}", kind, "os", present=present))
    out.append(_row("loan_data", "$.interest_rate_schedule[]", "object", "ol"))
    for key, column in (("interest_rate", "l_tax"), ("effective_date", "l_shipdate")):
        out.append(_row("loan_data", f"$.interest_rate_schedule[].{key}", "string", "ol", present=f"{column} IS NOT NULL"))
    return out


def _paths(payload_keys: dict, key_source: dict, split: str) -> str:
    """CTEs up to ``c``: one row per path with (n, h, t) of both halves."""
    return (f"WITH os AS (SELECT *, {split} AS before_split FROM orders),\n"
            "ol AS (SELECT os.before_split, l.* FROM os JOIN lineitem l ON l.l_orderkey = os.o_orderkey),\n"
            # a half holds a customer's events once, on the newest version
            "one AS (SELECT DISTINCT o_custkey, before_split FROM os),\n"
            "oe AS (SELECT one.before_split, e.* FROM one JOIN events e ON e.user_id = one.o_custkey),\n"
            "c AS (" + "\nUNION ALL\n".join(_rows(payload_keys, key_source)) + ")\n")


def path_drift_sql(payload_keys: dict, key_source: dict) -> str:
    return _paths(payload_keys, key_source, SPLIT) + (
        "SELECT payload, path, nb AS before_count, na AS after_count, "
        "CASE WHEN nb = 0 THEN 'added' WHEN na = 0 THEN 'removed' ELSE 'kept' END AS status FROM c WHERE na + nb > 0")


def schema_sql(payload_keys: dict, key_source: dict) -> str:
    """The whole snapshot is packed like the first half."""
    return _paths(payload_keys, key_source, "TRUE") + (
        "SELECT payload, path, tb AS type, hb > nb AS nullable, nb::BIGINT AS n FROM c WHERE nb > 0")


def outer_columns_sql(outer: list[tuple]) -> str:
    """Outer columns: fixed types and status, counted values.  ``outer``: (name, type
    before, type after, status, source column of ``orders`` or None for always there)."""
    parts = []
    for name, before, after, status, column in outer:
        text = ["CAST(NULL AS VARCHAR)" if v is None else f"'{v}'" for v in (name, before, after, status)]
        held = f" AND {column} IS NOT NULL" if column else ""
        counts = [f"count(*) FILTER (WHERE {half}{held})" if t is not None or name == "*" else "CAST(NULL AS BIGINT)"
                  for t, half in ((before, SPLIT), (after, f"NOT ({SPLIT})"))]
        parts.append(f"SELECT 'column' AS kind, {text[0]} AS \"column\", {text[1]} AS before_type, {text[2]} AS after_type, "
                     f"{text[3]} AS status, {counts[0]} AS before_count, {counts[1]} AS after_count FROM orders")
    return "\nUNION ALL\n".join(parts)


def schema_drift_sql(payload_keys: dict, key_source: dict, outer: list[tuple]) -> str:
    return _paths(payload_keys, key_source, SPLIT) + (
        f"SELECT *, CAST(NULL AS VARCHAR) AS path FROM ({outer_columns_sql(outer)}) o\nUNION ALL\n"
        "SELECT 'path', payload, CASE WHEN nb > 0 THEN tb END, CASE WHEN na > 0 THEN ta END, "
        "CASE WHEN nb = 0 THEN 'added' WHEN na = 0 THEN 'removed' WHEN tb <> ta THEN 'type_changed' "
        "WHEN (hb > nb) <> (ha > na) THEN 'nullability_changed' ELSE 'same' END, "
        "CASE WHEN nb > 0 THEN nb END, CASE WHEN na > 0 THEN na END, path FROM c WHERE na + nb > 0")
