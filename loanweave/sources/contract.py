"""Input contract of a portfolio snapshot and the JSON payload schemas.

A snapshot holds one row per published version of a loan.  Scalar columns are
typed; the payload columns are JSON text (objects or arrays of objects).
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Outer snapshot columns the mart reads.
# ---------------------------------------------------------------------------
SNAPSHOT_SCHEMA = T.StructType([
    T.StructField("loan_id", T.StringType()),
    T.StructField("id", T.StringType()),
    T.StructField("dark", T.BooleanType()),
    T.StructField("published_at", T.TimestampNTZType()),
    T.StructField("portfolios_created_at", T.TimestampNTZType()),
    T.StructField("accounts_created_at", T.TimestampNTZType()),
    T.StructField("accounts_updated_at", T.TimestampNTZType()),
    T.StructField("accounts_build_end_time", T.TimestampNTZType()),
    T.StructField("servicing_account_id", T.StringType()),
    T.StructField("etl_ingestion_time", T.TimestampNTZType()),
    T.StructField("source_file_creation_time", T.TimestampNTZType()),
    T.StructField("loan_data", T.StringType()),
    T.StructField("customer_information", T.StringType()),
    T.StructField("sale_info", T.StringType()),
    T.StructField("settlements", T.StringType()),
    T.StructField("installments", T.StringType()),
    T.StructField("bankruptcy_timeline", T.StringType()),
    T.StructField("bankruptcy_claims", T.StringType()),
    T.StructField("collection_cases", T.StringType()),
    T.StructField("financial_owners", T.StringType()),
    T.StructField("operational_charge_offs", T.StringType()),
    T.StructField("original_installments", T.StringType()),
    T.StructField("treasury_charge_offs", T.StringType()),
    T.StructField("payment_plans", T.StringType()),
])

SCALAR_COLUMNS = [f.name for f in SNAPSHOT_SCHEMA.fields
                  if not isinstance(f.dataType, T.StringType)
                  or f.name in ("loan_id", "id", "servicing_account_id")]

PAYLOAD_ARRAY_COLUMNS = [
    "sale_info", "settlements", "installments", "bankruptcy_timeline",
    "bankruptcy_claims", "collection_cases", "financial_owners",
    "operational_charge_offs", "original_installments", "treasury_charge_offs",
    "payment_plans",
]
PAYLOAD_OBJECT_COLUMNS = ["loan_data", "customer_information"]
PAYLOAD_COLUMNS = PAYLOAD_OBJECT_COLUMNS + PAYLOAD_ARRAY_COLUMNS

# ---------------------------------------------------------------------------
# Element schemas of the JSON payloads (field names, order and
# types as the source system publishes them).  ``decimal(10,0)`` is the
# unparameterised decimal the source declares for owner and installment money.
# ---------------------------------------------------------------------------
SALE_INFO = (
    "uuid string, sale_date timestamp, debt_buyer string, loan_task_id string, "
    "percentage_sold double, sale_amount double, sale_fees_amount double, "
    "sale_interest_amount double, sale_principal_amount double, "
    "debt_sale_file_id string, debt_sale_file_date timestamp, "
    "debt_sale_file_uuid string, rebuy_date timestamp, rebuy_amount double, "
    "rebuy_reason string, rebuy_file_uuid string, "
    "rebuy_transaction_timestamp timestamp, sale_transaction_timestamp timestamp"
)

SETTLEMENTS = (
    "amount double, status string, end_date timestamp, start_date timestamp, "
    "payment_method string, settlement_type string, number_of_payments double, "
    "transaction_timestamp timestamp"
)

INSTALLMENTS = (
    "id string, interest_amount double, principal_amount double, "
    "late_fees_amount double, adjusted_effective_date timestamp, "
    "original_effective_date timestamp"
)

BANKRUPTCY_EVENT = (
    "date string, status string, chapter string, event_id string, "
    "removed_on string, case_number string, confirmed_at string, "
    "attorney_name string, law_firm_name string, event_created_at string, "
    "proof_of_claim_date string, attorney_phone_number string, "
    "attorney_email_address string, representation_confirmed string"
)
BANKRUPTCY_TIMELINE_ENTRY = f"event_history array<struct<{BANKRUPTCY_EVENT}>>"

BANKRUPTCY_CLAIMS = "status string, chapter string, effective_date string"

LOAN_DATA = (
    "term string, loan_id string, loan_uuid string, payment_method string, "
    "origination_state string, "
    "interest_rate_schedule array<struct<interest_rate string, effective_date string>>"
)

COLLECTION_CASES = (
    "case_type string, start_date timestamp, end_date timestamp, "
    "agency_name string, agency_email string, agency_phone string, "
    "poa_effective_date timestamp"
)


def financial_owners(money: str = "decimal(10,0)") -> str:
    return (
        "legal_entity string, financial_owner string, financial_owner_type string, "
        "uuid string, financial_owner_eff_date timestamp, "
        "financial_owner_termination_date timestamp, "
        "financial_owner_termination_reason string, marketplace_status string, "
        f"marketplace_premium {money}, marketplace_final_principal_ar {money}, "
        f"marketplace_final_interest_ar {money}"
    )


OPERATIONAL_CHARGE_OFFS = (
    "uuid string, charge_off_date timestamp, charge_off_reason string, "
    "forgiveness_date timestamp, write_off_amount double, "
    "charge_off_amount struct<fees double, interest double, principal double>"
)


def original_installments(money: str = "decimal(10,0)") -> str:
    return (
        "id string, installment_date timestamp, "
        f"original_interest {money}, original_principal {money}, "
        "installment_schedule_id string"
    )


TREASURY_CHARGE_OFFS = (
    "uuid string, effective_date timestamp, charge_off_reason string, "
    "transaction_timestamp timestamp, id string, reverted_at timestamp, "
    "updated_at timestamp, source_uuid string, source_type string, "
    "revertible boolean"
)

# Payment plan fields, read one by one as text.
PAYMENT_PLAN_FIELDS = [
    "status", "lock_in_date", "total_amount", "payment_amount", "adjusted_end_date",
    "first_payment_date", "early_terminate_date", "adjusted_lock_in_date", "tdr",
    "id", "start_date", "end_date", "created_timestamp", "plan_type", "uuid",
    "frequency", "contract_id", "contract_signed_datetime", "created_by_id",
    "payment_dates", "rule_version", "freezes_lateness", "lateness_reset_date",
    "updated_at",
]


def pick(ddl: str, *names: str) -> str:
    """The named top-level fields of a payload schema, so that only they are parsed."""
    fields, depth, at = [], 0, 0
    for i, ch in enumerate(ddl):
        depth += (ch in "<(") - (ch in ">)")
        if ch == "," and depth == 0:
            fields.append(ddl[at:i].strip())
            at = i + 1
    fields.append(ddl[at:].strip())
    by_name = {f.split(None, 1)[0]: f for f in fields}
    return ", ".join(by_name[n] for n in names)
