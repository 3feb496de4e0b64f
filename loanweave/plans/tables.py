"""The eleven mart tables.

Every table has a *per-element* build (one row per payload element of the
latest visible version of a loan, as the source system's own step comments
describe).  Where the source's code yields something else, an ``*_observed``
build reproduces those values and row multiplicities exactly.

All builds are DataFrame -> DataFrame functions over a snapshot frame, so
one scan and one ``latest`` frame can feed every table (see ``plans.mart``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanweave.functions import casts
from loanweave.functions.json import (
    element_count, element_rows, first_event_date, parse_object,
)
from loanweave.functions.keys import key_text, surrogate_key
from loanweave.operators.joins import join_aggregate
from loanweave.operators.payload import bind_array, explode_elements, fan_out, values_at
from loanweave.operators.snapshot import latest_per_key, non_empty, visible
from loanweave.session import stage
from loanweave.sources import contract as C

OBSERVED_MONEY = "decimal(10,0)"
ELEMENT_MONEY = "decimal(18,2)"

_LOAN_IDS = "loan_id string, loan_uuid string"


def latest(snapshot: DataFrame) -> DataFrame:
    """Latest visible version of every loan."""
    return latest_per_key(visible(snapshot))


def _ntz(df: DataFrame) -> DataFrame:
    """Timestamps parsed from JSON are instants; publish wall-clock NTZ."""
    return df.select(*[
        casts.to_ntz(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.TimestampType)
        else F.col(f.name) for f in df.schema.fields])


# ---------------------------------------------------------------------------
# Uniform payload tables (debt sale, settlement, active installment,
# collection case, financial owner, operational / treasury charge-off,
# original installment)
# ---------------------------------------------------------------------------

@dataclass(frozen=True)
class Observed:
    frame: str            # "latest" | "visible"
    text_filter: bool     # payload != '[]' before unpacking
    fan_out: str          # "owners" | "payload" | "none"
    index: int            # element whose values fill every row
    loan_id_from: str     # "snapshot" | "json"
    key: tuple[str, ...] | None = None   # key parts, if different from per-element


@dataclass(frozen=True)
class PayloadTable:
    name: str
    payload: str
    element_ddl: Callable[[str], str]
    fields: tuple[tuple[str, str], ...]          # (output name, element path)
    output: tuple[str, ...]
    key_name: str | None
    key: tuple[str, ...]                          # per-element key parts
    observed: Observed
    snapshot_cols: tuple[str, ...] = ()
    distinct: bool = False


def _fixed(ddl: str) -> Callable[[str], str]:
    return lambda money: ddl


# Source fields and published columns of each table.
PAYLOAD_TABLES: dict[str, PayloadTable] = {t.name: t for t in [
    PayloadTable(
        name="loan_debt_sale", payload="sale_info", element_ddl=_fixed(C.SALE_INFO),
        fields=(("created_time", "sale_transaction_timestamp"), ("sale_date", "sale_date"),
                ("debt_buyer_name", "debt_buyer"), ("loan_task_id", "loan_task_id"),
                ("percentage_sold", "percentage_sold"), ("sale_amount", "sale_amount"),
                ("sale_fees_amount", "sale_fees_amount"),
                ("sale_interest_amount", "sale_interest_amount"),
                ("sale_principal_amount", "sale_principal_amount"),
                ("debt_sale_file_id", "debt_sale_file_id"),
                ("debt_sale_file_date", "debt_sale_file_date"),
                ("debt_sale_file_uuid", "debt_sale_file_uuid"), ("rebuy_date", "rebuy_date"),
                ("rebuy_amount", "rebuy_amount"), ("rebuy_reason", "rebuy_reason"),
                ("rebuy_file_uuid", "rebuy_file_uuid"),
                ("rebuy_time", "rebuy_transaction_timestamp"),
                ("loan_debt_sale_uuid", "uuid")),
        output=("loan_id", "loan_uuid", "created_time", "sale_date", "debt_buyer_name",
                "loan_task_id", "percentage_sold", "sale_amount", "sale_fees_amount",
                "sale_interest_amount", "sale_principal_amount", "debt_sale_file_id",
                "debt_sale_file_date", "debt_sale_file_uuid", "rebuy_date", "rebuy_amount",
                "rebuy_reason", "rebuy_file_uuid", "rebuy_time", "loan_debt_sale_uuid"),
        key_name=None, key=(),
        observed=Observed("latest", True, "owners", 0, "snapshot")),
    PayloadTable(
        name="loan_servicing_settlement", payload="settlements",
        element_ddl=_fixed(C.SETTLEMENTS),
        fields=(("total_amount", "amount"), ("status", "status"), ("end_date", "end_date"),
                ("start_date", "start_date"), ("payment_method", "payment_method"),
                ("structure", "settlement_type"), ("payment_count", "number_of_payments"),
                ("created_time", "transaction_timestamp")),
        output=("loan_id", "loan_uuid", "total_amount", "status", "end_date", "start_date",
                "payment_method", "structure", "payment_count", "created_time",
                "loan_servicing_settlement_uuid"),
        key_name="loan_servicing_settlement_uuid", key=("loan_id", "start_date"),
        observed=Observed("latest", True, "owners", 0, "snapshot")),
    PayloadTable(
        name="active_installment", payload="installments", element_ddl=_fixed(C.INSTALLMENTS),
        fields=(("active_installment_id", "id"), ("interest_amount", "interest_amount"),
                ("principal_amount", "principal_amount"),
                ("late_fees_amount", "late_fees_amount"),
                ("adjusted_effective_date", "adjusted_effective_date"),
                ("original_effective_date", "original_effective_date")),
        output=("loan_id", "loan_uuid", "active_installment_id", "interest_amount",
                "principal_amount", "late_fees_amount", "adjusted_effective_date",
                "original_effective_date", "active_installment_uuid"),
        key_name="active_installment_uuid", key=("active_installment_id",),
        observed=Observed("latest", True, "payload", 0, "snapshot", key=("_snapshot_id",))),
    PayloadTable(
        name="loan_collection_case", payload="collection_cases",
        element_ddl=_fixed(C.COLLECTION_CASES),
        fields=(("case_type", "case_type"), ("start_date", "start_date"),
                ("end_date", "end_date"), ("collection_agency_name", "agency_name"),
                ("collection_agency_email", "agency_email"),
                ("collection_agency_phone", "agency_phone"),
                ("poa_effective_date", "poa_effective_date")),
        output=("loan_id", "loan_uuid", "case_type", "start_date", "end_date",
                "collection_agency_name", "collection_agency_email",
                "collection_agency_phone", "poa_effective_date", "loan_collection_case_uuid"),
        key_name="loan_collection_case_uuid", key=("loan_id", "start_date"),
        observed=Observed("latest", True, "payload", 0, "json")),
    PayloadTable(
        name="loan_financial_owner", payload="financial_owners",
        element_ddl=C.financial_owners,
        fields=(("legal_entity", "legal_entity"), ("financial_owner_name", "financial_owner"),
                ("financial_owner_type", "financial_owner_type"),
                ("financial_owner_uuid", "uuid"), ("effective_date", "financial_owner_eff_date"),
                ("termination_date", "financial_owner_termination_date"),
                ("termination_reason", "financial_owner_termination_reason"),
                ("marketplace_status", "marketplace_status"),
                ("marketplace_premium", "marketplace_premium"),
                ("marketplace_final_principal_ar_amount", "marketplace_final_principal_ar"),
                ("marketplace_final_interest_ar_amount", "marketplace_final_interest_ar")),
        output=("loan_id", "loan_uuid", "legal_entity", "financial_owner_name",
                "financial_owner_type", "financial_owner_uuid", "effective_date",
                "termination_date", "termination_reason", "marketplace_status",
                "marketplace_premium", "marketplace_final_principal_ar_amount",
                "marketplace_final_interest_ar_amount", "loan_financial_owner_uuid"),
        key_name="loan_financial_owner_uuid", key=("loan_id", "effective_date", "legal_entity"),
        observed=Observed("visible", False, "payload", 1, "json")),
    PayloadTable(
        name="operational_charge_off", payload="operational_charge_offs",
        element_ddl=_fixed(C.OPERATIONAL_CHARGE_OFFS),
        fields=(("operational_charge_off_uuid", "uuid"), ("charge_off_date", "charge_off_date"),
                ("charge_off_reason", "charge_off_reason"),
                ("forgiveness_date", "forgiveness_date"),
                ("write_off_amount", "write_off_amount"),
                ("charge_off_fees_amount", "charge_off_amount.fees"),
                ("charge_off_interest_amount", "charge_off_amount.interest"),
                ("charge_off_principal_amount", "charge_off_amount.principal")),
        output=("loan_id", "loan_uuid", "operational_charge_off_uuid", "charge_off_date",
                "charge_off_reason", "servicing_account_id", "forgiveness_date",
                "write_off_amount", "charge_off_fees_amount", "charge_off_interest_amount",
                "charge_off_principal_amount"),
        key_name=None, key=(), snapshot_cols=("servicing_account_id",),
        observed=Observed("latest", False, "payload", 0, "json")),
    PayloadTable(
        name="original_installment", payload="original_installments",
        element_ddl=C.original_installments,
        fields=(("original_installment_id", "id"), ("installment_date", "installment_date"),
                ("interest_amount", "original_interest"),
                ("principal_amount", "original_principal"),
                ("installment_schedule_id", "installment_schedule_id")),
        output=("loan_id", "loan_uuid", "original_installment_id", "installment_date",
                "interest_amount", "principal_amount", "installment_schedule_id",
                "original_installment_uuid"),
        key_name="original_installment_uuid", key=("original_installment_id",),
        distinct=True,
        observed=Observed("visible", False, "payload", 0, "json", key=("_snapshot_id",))),
    PayloadTable(
        name="treasury_charge_off", payload="treasury_charge_offs",
        element_ddl=_fixed(C.TREASURY_CHARGE_OFFS),
        fields=(("treasury_charge_off_uuid", "uuid"), ("effective_date", "effective_date"),
                ("charge_off_reason", "charge_off_reason"),
                ("created_time", "transaction_timestamp"),
                ("treasury_charge_off_id", "id"), ("reverted_time", "reverted_at"),
                ("updated_time", "updated_at"), ("source_uuid", "source_uuid"),
                ("source_type", "source_type"), ("revertible_flag", "revertible")),
        output=("loan_id", "loan_uuid", "treasury_charge_off_uuid", "servicing_account_id",
                "effective_date", "charge_off_reason", "created_time",
                "treasury_charge_off_id", "reverted_time", "updated_time", "source_uuid",
                "source_type", "revertible_flag"),
        key_name=None, key=(), snapshot_cols=("servicing_account_id",),
        observed=Observed("latest", False, "none", 0, "json")),
]}


def _finish(df: DataFrame, spec: PayloadTable, key: tuple[str, ...]) -> DataFrame:
    df = _ntz(df)
    if spec.distinct and spec.key_name:
        # Rows are told apart by what the key is a hash of: shorter than the hash, and it compresses.
        df = df.select(*[c for c in spec.output if c != spec.key_name], key_text(*key).alias("_key")).dropDuplicates()
        return df.withColumn(spec.key_name, surrogate_key("_key")).select(*spec.output)
    if spec.key_name:
        df = df.withColumn(spec.key_name, surrogate_key(*key))
    df = df.select(*spec.output)
    return df.dropDuplicates() if spec.distinct else df


def payload_table(frame: DataFrame, spec: PayloadTable) -> DataFrame:
    """Per-element build from a *latest* frame: one row per payload element."""
    ids = parse_object("loan_data", _LOAN_IDS)
    keep = [ids["loan_id"].alias("loan_id"), ids["loan_uuid"].alias("loan_uuid"),
            F.col("id").alias("_snapshot_id"), *spec.snapshot_cols]
    rows = explode_elements(frame, spec.payload, spec.element_ddl(ELEMENT_MONEY), keep)
    e = F.col("e")
    fields = []
    for name, path in spec.fields:
        c = e
        for part in path.split("."):
            c = c[part]
        fields.append(c.alias(name))
    df = rows.select("loan_id", "loan_uuid", "_snapshot_id", *spec.snapshot_cols, *fields)
    return _finish(df, spec, spec.key)


def payload_table_observed(visible_frame: DataFrame, latest_frame: DataFrame,
                           spec: PayloadTable) -> DataFrame:
    """The values and row multiplicity the source's code yields (see Observed)."""
    o = spec.observed
    base = latest_frame if o.frame == "latest" else visible_frame
    if o.text_filter:
        base = non_empty(base, spec.payload)
    ids = parse_object("loan_data", _LOAN_IDS)
    loan_id = F.col("loan_id") if o.loan_id_from == "snapshot" else ids["loan_id"]
    base = bind_array(base, "_elements", spec.payload, spec.element_ddl(OBSERVED_MONEY))
    parsed = F.col("_elements")
    fan_col = {"owners": "financial_owners", "payload": spec.payload, "none": None}[o.fan_out]
    # Values are taken once per snapshot row, then the row is repeated.
    df = base.select(loan_id.alias("loan_id"), ids["loan_uuid"].alias("loan_uuid"),
                     F.col("id").alias("_snapshot_id"), *spec.snapshot_cols,
                     *([F.col(fan_col)] if fan_col else []),
                     *values_at(parsed, spec.fields, o.index))
    if fan_col and spec.distinct:  # copies would be removed again: only whether there is one matters
        df = df.filter(element_count(fan_col) > 0).drop(fan_col)
    elif fan_col:
        df = fan_out(df, fan_col).drop(fan_col)
    return _finish(df, spec, o.key or spec.key)


# ---------------------------------------------------------------------------
# Bankruptcy (timeline entries and claims)
# ---------------------------------------------------------------------------

# Published columns.
BANKRUPTCY_OUTPUT = ("loan_id", "loan_uuid", "claimed_date", "petitioned_date",
                     "discharged_date", "bankruptcy_uuid", "chapter", "status")


# Fields of an event that the tables read.
_EVENT = C.pick(C.BANKRUPTCY_EVENT, "date", "status", "chapter")


def bind_timeline(df: DataFrame, name: str, text: str, event_ddl: str = _EVENT) -> DataFrame:
    """``df`` with column ``name``: timeline entries, each ``struct<event_history: array<event>>``.

    Accepts an array of entries, one entry object, or an array of bare events
    (if no element carries ``event_history`` the whole array is one entry).
    One parse reads both shapes: its element has the entry's field and the event's.
    """
    fields = [f.split(None, 1)[0] for f in event_ddl.split(", ")]
    both = bind_array(df, name, text, f"event_history array<struct<{event_ddl}>>, {event_ddl}")
    elements = F.col(name)
    entries = F.transform(elements, lambda e: F.struct(e["event_history"].alias("event_history")))
    bare = F.transform(elements, lambda e: F.struct(*[e[f].alias(f) for f in fields]))
    return both.withColumn(name, F.when(F.exists(elements, lambda e: e["event_history"].isNotNull()), entries)
                           .when(F.size(elements) > 0, F.array(F.struct(bare.alias("event_history"))))
                           .otherwise(entries))


def bankruptcy(frame: DataFrame) -> DataFrame:
    """Per-element: one row per timeline entry plus one row per claim.

    Both kinds are produced by a single generator over the row, so the latest
    frame is read once (no union of two scans).
    """
    base = frame.filter((F.col("bankruptcy_timeline") != "[]") | (F.col("bankruptcy_claims") != "[]"))
    base = bind_array(bind_timeline(base, "_timeline", "bankruptcy_timeline"), "_claims", "bankruptcy_claims", C.BANKRUPTCY_CLAIMS)
    base = base.withColumn("_ids", parse_object("loan_data", _LOAN_IDS))
    ids = F.col("_ids")
    loan_id = ids["loan_id"]
    null_s, null_d = F.lit(None).cast("string"), F.lit(None).cast("date")

    def entry_row(e: Column, i: Column) -> Column:
        hist = e["event_history"]
        last = F.array_max(F.transform(hist, lambda v: F.struct(
            v["date"].alias("d"), v["status"].alias("s"), v["chapter"].alias("c"))))
        return F.struct(
            null_s.alias("claimed_date"),
            casts.to_date(first_event_date(hist, "petitioned")).alias("petitioned_date"),
            casts.to_date(first_event_date(hist, "discharged")).alias("discharged_date"),
            surrogate_key(loan_id, F.lit("timeline"), i).alias("bankruptcy_uuid"),
            last["c"].alias("chapter"), last["s"].alias("status"))

    def claim_row(c: Column) -> Column:
        return F.struct(
            c["effective_date"].alias("claimed_date"), null_d.alias("petitioned_date"),
            null_d.alias("discharged_date"),
            surrogate_key(loan_id, c["effective_date"]).alias("bankruptcy_uuid"),
            c["chapter"].alias("chapter"), c["status"].alias("status"))

    rows = F.concat(
        F.coalesce(F.transform("_timeline", entry_row), F.array()),
        F.coalesce(F.transform("_claims", claim_row), F.array()))
    return (base.select(loan_id.alias("loan_id"), ids["loan_uuid"].alias("loan_uuid"),
                        F.inline(rows))
                .select(*BANKRUPTCY_OUTPUT))


def bankruptcy_observed(frame: DataFrame) -> DataFrame:
    """Latest rows with both payloads non-empty, repeated once per claim, values
    of the first claim.  The source's key is ``concat(h1, h2)`` where ``h1``
    hashes a partition-dependent generated id; only the reproducible half
    ``h2 = sha2(loan_id ‖ all claimed dates)`` is published, as ``claims_hash``."""
    base = frame.filter((F.col("bankruptcy_timeline") != "[]") & (F.col("bankruptcy_claims") != "[]"))
    base = bind_array(base, "_claims", "bankruptcy_claims", C.BANKRUPTCY_CLAIMS)
    ids = parse_object("loan_data", _LOAN_IDS)
    claims = F.col("_claims")
    first = F.get(claims, 0)
    df = base.select(
        ids["loan_id"].alias("loan_id"), ids["loan_uuid"].alias("loan_uuid"),
        first["effective_date"].alias("claimed_date"),
        F.lit(None).cast("date").alias("petitioned_date"),
        F.lit(None).cast("date").alias("discharged_date"),
        surrogate_key(ids["loan_id"], claims["effective_date"]).alias("claims_hash"),
        first["chapter"].alias("chapter"), first["status"].alias("status"),
        "bankruptcy_claims")
    return fan_out(df, "bankruptcy_claims").drop("bankruptcy_claims")


# ---------------------------------------------------------------------------
# Interest rate schedule
# ---------------------------------------------------------------------------

# Published columns.
INTEREST_RATE_OUTPUT = ("loan_id", "loan_uuid", "interest_rate", "effective_date",
                        "interest_rate_uuid", "interest_rate_id", "inactive_flag",
                        "created_time", "updated_time", "source_type", "source_uuid",
                        "end_date", "cap_flag")
# Fixed value: the source publishes the three flags as the text "False".
FLAG_TEXT = "False"


def _rate_columns(loan_id: Column, rate: Column, eff: Column) -> list[Column]:
    key = surrogate_key(loan_id, rate, eff)
    return [rate.alias("interest_rate"), eff.alias("effective_date"),
            key.alias("interest_rate_uuid"), key.alias("interest_rate_id"),
            F.lit(FLAG_TEXT).alias("inactive_flag"), F.lit(FLAG_TEXT).alias("source_type"),
            loan_id.alias("source_uuid"), F.lit(FLAG_TEXT).alias("cap_flag")]


# Snapshot columns published under other names.
INTEREST_RATE_RENAMES = {"accounts_created_at": "created_time",
                         "accounts_updated_at": "updated_time",
                         "accounts_build_end_time": "end_date"}


def interest_rate(frame: DataFrame) -> DataFrame:
    """Per-element: the latest version's own schedule, one row per entry, one
    row of NULL rate/date for a loan without schedule."""
    ld = parse_object("loan_data", C.LOAN_DATA)
    rows = frame.withColumnsRenamed(INTEREST_RATE_RENAMES).select(
        "loan_id", ld["loan_uuid"].alias("loan_uuid"), "created_time", "updated_time", "end_date",
        F.explode_outer(ld["interest_rate_schedule"]).alias("e"))
    return rows.select(
        "loan_id", "loan_uuid", "created_time", "updated_time", "end_date",
        *_rate_columns(F.col("loan_id"), F.col("e")["interest_rate"],
                       F.col("e")["effective_date"]),
    ).select(*INTEREST_RATE_OUTPUT)


def _pooled_schedule(visible_frame: DataFrame) -> DataFrame:
    """Every schedule entry of every visible version, keyed by the JSON loan id."""
    ld = parse_object("loan_data", C.LOAN_DATA)
    return visible_frame.select(ld["loan_id"].alias("json_loan_id"),
                                F.explode(ld["interest_rate_schedule"]).alias("e"))


def interest_rate_observed(visible_frame: DataFrame) -> DataFrame:
    """The source joins every visible version of a loan with every schedule
    entry of every visible version of it (left outer, many-to-many).  That
    product is published factorised, without emitting the pairs: one row per
    distinct (loan, rate, date) with ``entry_count`` (copies of the entry),
    ``version_count`` (visible versions of the loan) and ``row_count`` =
    entry_count × version_count, the number of rows the product holds for it.
    A loan without any entry has one NULL rate/date row with
    ``row_count = version_count``.  The per-version side is
    :func:`interest_rate_observed_versions`.  Both sides are aggregated per
    key before they meet, so a hot loan never multiplies inside a task.  Both
    aggregates are staged: each is computed once, and joining scans of them
    leaves no aggregate between a shuffle and the join, so AQE can split a
    loan with very many entries.
    """
    entries = stage(_pooled_schedule(visible_frame)
               .groupBy("json_loan_id", F.col("e")["interest_rate"].alias("interest_rate"),
                        F.col("e")["effective_date"].alias("effective_date"))
               .agg(F.count(F.lit(1)).alias("entry_count")), "rate_entries")
    versions = stage(visible_frame.groupBy("loan_id").agg(F.count(F.lit(1)).alias("version_count")),
                     "loan_versions")
    # Inner join for loans with entries: AQE may split a skewed partition on
    # either side of an inner join (not the optional side of an outer join).
    with_entries = join_aggregate(entries, versions, F.col("loan_id") == F.col("json_loan_id"), staged=lambda df, _: df)
    # Loans without any entry: one NULL rate/date row each.  The anti side is
    # one row per loan, so a loan with many entries never weighs on it.
    loans_with_entries = entries.select("json_loan_id").distinct()
    without = versions.join(loans_with_entries,
                            versions.loan_id == loans_with_entries.json_loan_id, "left_anti")
    null_s = F.lit(None).cast("string")
    both = (with_entries.select("loan_id", "interest_rate", "effective_date", "entry_count",
                                "version_count")
            .unionByName(without.select("loan_id", null_s.alias("interest_rate"),
                                        null_s.alias("effective_date"),
                                        F.lit(0).cast("long").alias("entry_count"),
                                        "version_count")))
    loan_id = F.col("loan_id")
    return both.select(
        loan_id,
        *_rate_columns(loan_id, F.col("interest_rate"), F.col("effective_date")),
        F.col("entry_count"), F.col("version_count"),
        (F.greatest(F.col("entry_count"), F.lit(1)) * F.col("version_count")).alias("row_count"),
    )


def interest_rate_observed_versions(visible_frame: DataFrame) -> DataFrame:
    """Per visible version: the snapshot-side columns of the source's product
    and ``schedule_rows``, the number of schedule entries it is paired with
    (its rows in the product are ``greatest(schedule_rows, 1)``)."""
    pooled = (_pooled_schedule(visible_frame).groupBy("json_loan_id")
              .agg(F.count(F.lit(1)).alias("schedule_rows"))).alias("p")
    ld = parse_object("loan_data", _LOAN_IDS)
    v = visible_frame.withColumnsRenamed(INTEREST_RATE_RENAMES).select(
        "loan_id", "id", ld["loan_uuid"].alias("loan_uuid"), "created_time", "updated_time",
        "end_date").alias("v")
    # The left side is one row per version, so a hot loan sits on the side AQE can split.
    j = join_aggregate(v, pooled, F.col("v.loan_id") == F.col("p.json_loan_id"), "left",
                       lambda df, label: stage(df, label).alias("p"), "schedule_rows")
    return j.select("v.*", F.coalesce(F.col("p.schedule_rows"), F.lit(0)).alias("schedule_rows"))


# ---------------------------------------------------------------------------
# Payment plans
# ---------------------------------------------------------------------------

# Published columns.
PAYMENT_PLAN_OUTPUT = (
    "loan_id", "loan_uuid", "payment_method", "customer_id", "grace_period_days", "status",
    "lock_in_date", "total_amount", "payment_amount", "adjusted_end_date",
    "first_payment_date", "early_terminate_date", "adjusted_lock_in_date",
    "troubled_debt_restructuring_flag", "loan_payment_plan_id", "start_date", "end_date",
    "created_time", "structure", "loan_payment_plan_uuid", "frequency", "contract_id",
    "contract_signed_date", "created_by_portal_id", "payment_dates_text", "rule_version",
    "completed_date", "lateness_reset_date", "freezes_lateness_flag", "etl_ingestion_time",
    "source_file_creation_time", "updated_time")

# Fixed values of the plan rules.
TRIAL_PLAN_TYPES = ("loan_mod_trial", "term_extension_trial")
DATED_FROM_CREATION = ("deferment", "long_term")
STRUCTURE_NAMES = {"loan_mod_trial": "apr_reduction", "term_extension_trial": "term_extension"}
LONG_GRACE_STATES = ("CA", "MO")
LONG_GRACE_DAYS, SHORT_GRACE_DAYS = 15, 10


def latest_with_plans(snapshot: DataFrame, *carried: str) -> DataFrame:
    """Per loan the latest visible version *that has plans*, with the ``carried`` columns.

    Versions are ranked by the JSON loan id and ``portfolios_created_at``
    after the non-empty filter.
    """
    ld = parse_object("loan_data", "loan_id string, loan_uuid string, "
                                   "payment_method string, origination_state string")
    cust = parse_object("customer_information", "customer_id string")
    base = (non_empty(visible(snapshot), "payment_plans")
            .select(ld.alias("ld"), cust["customer_id"].alias("customer_id_text"), "id",
                    "portfolios_created_at", "etl_ingestion_time", "source_file_creation_time",
                    *carried)
            .withColumn("json_loan_id", F.col("ld")["loan_id"]))
    return latest_per_key(base, "json_loan_id", ("portfolios_created_at", "id"))


def payment_plan(snapshot: DataFrame) -> DataFrame:
    """One row per payment plan of the latest visible version *that has plans*."""
    return payment_plan_rows(latest_with_plans(snapshot, "payment_plans"))


def payment_plan_rows(top: DataFrame) -> DataFrame:
    """One row per plan of the versions of :func:`latest_with_plans`.  Each plan element is
    parsed once into an all-text struct; every rule reads the original texts."""
    plan_ddl = ", ".join(f"{f} string" for f in C.PAYMENT_PLAN_FIELDS)
    rows = explode_elements(top, "payment_plans", plan_ddl,
                            ["ld", "customer_id_text", "etl_ingestion_time", "source_file_creation_time"]).withColumnRenamed("e", "p")

    t = lambda f: F.col("p")[f]  # noqa: E731  (original text of a plan field)
    plan_type, status = t("plan_type"), t("status")
    trial = plan_type.isin(*TRIAL_PLAN_TYPES)
    created_time = casts.utc_to_central(t("created_timestamp"))
    structure = F.when(plan_type == "loan_mod_trial", STRUCTURE_NAMES["loan_mod_trial"])
    structure = structure.when(plan_type == "term_extension_trial",
                               STRUCTURE_NAMES["term_extension_trial"]).otherwise(plan_type)
    ld_ = F.col("ld")
    out = rows.select(
        casts.to_int(ld_["loan_id"]).alias("loan_id"),
        ld_["loan_uuid"].alias("loan_uuid"),
        ld_["payment_method"].alias("payment_method"),
        casts.to_int(F.col("customer_id_text")).alias("customer_id"),
        F.when(ld_["origination_state"].isin(*LONG_GRACE_STATES), F.lit(LONG_GRACE_DAYS))
         .otherwise(F.lit(SHORT_GRACE_DAYS)).cast("int").alias("grace_period_days"),
        F.when(trial & (status == "completed"), F.lit("locked_in")).otherwise(status).alias("status"),
        casts.to_date(t("lock_in_date")).alias("lock_in_date"),
        casts.to_decimal(t("total_amount")).alias("total_amount"),
        casts.to_decimal(t("payment_amount")).alias("payment_amount"),
        casts.to_date(
            F.when(trial & (status == "terminated"), t("early_terminate_date"))
             .when(~trial, F.coalesce(t("adjusted_end_date"), t("early_terminate_date"),
                                      t("end_date")))).alias("adjusted_end_date"),
        casts.to_date(t("first_payment_date")).alias("first_payment_date"),
        casts.to_date(t("early_terminate_date")).alias("early_terminate_date"),
        casts.to_date(
            F.when(trial & (status == "completed"),
                   F.coalesce(t("adjusted_end_date"), t("end_date")))
             .otherwise(t("adjusted_lock_in_date"))).alias("adjusted_lock_in_date"),
        casts.to_bool(t("tdr")).alias("troubled_debt_restructuring_flag"),
        casts.to_int(t("id")).alias("loan_payment_plan_id"),
        F.when(plan_type.isin(*DATED_FROM_CREATION), F.to_date(created_time))
         .otherwise(casts.to_date(t("start_date"))).alias("start_date"),
        casts.to_date(F.when(~trial, t("end_date"))).alias("end_date"),
        created_time.alias("created_time"),
        structure.alias("structure"),
        t("uuid").alias("loan_payment_plan_uuid"),
        t("frequency").alias("frequency"),
        casts.to_int(t("contract_id")).alias("contract_id"),
        casts.to_date(t("contract_signed_datetime")).alias("contract_signed_date"),
        casts.to_int(t("created_by_id")).alias("created_by_portal_id"),
        t("payment_dates").alias("payment_dates_text"),
        t("rule_version").alias("rule_version"),
        F.when(~trial & (status == "completed"),
               F.coalesce(casts.to_date(t("adjusted_end_date")),
                          casts.to_date(t("end_date")))).alias("completed_date"),
        casts.to_date(t("lateness_reset_date")).alias("lateness_reset_date"),
        casts.to_bool(t("freezes_lateness")).alias("freezes_lateness_flag"),
        "etl_ingestion_time", "source_file_creation_time",
        casts.utc_to_central(t("updated_at")).alias("updated_time"),
    )
    return out.select(*PAYMENT_PLAN_OUTPUT)


# ---------------------------------------------------------------------------
# Row counts without materialising the tables
# ---------------------------------------------------------------------------

def _size0(arr: Column) -> Column:
    return F.when(arr.isNull(), F.lit(0)).otherwise(F.size(arr))


def generated_row_counts(snapshot: DataFrame) -> DataFrame:
    """``(table_name, n_rows)`` of every table that is one generator over the
    latest frame.  A generator emits exactly as many rows as the array it
    explodes holds, so each count is a sum of array sizes over the latest
    versions; the sizes are taken from the texts without building elements.  The sizes are computed
    per version *before* the ranking, so the ranking shuffle carries ids and
    a few integers instead of payload text.  Covers the uniform payload
    tables without a ``distinct``, bankruptcy and the interest-rate schedule
    (``explode_outer``: at least one row)."""
    sums = {}
    for name, spec in PAYLOAD_TABLES.items():
        if not spec.distinct:
            sums[name] = element_rows(spec.payload)
    has_payload = (F.col("bankruptcy_timeline") != "[]") | (F.col("bankruptcy_claims") != "[]")
    sums["bankruptcy"] = F.when(has_payload, _size0(F.col("_timeline")) + element_rows("bankruptcy_claims")).otherwise(0)
    sums["interest_rate"] = F.greatest(_size0(F.col("_schedule")), F.lit(1))
    bound = bind_timeline(visible(snapshot), "_timeline", "bankruptcy_timeline", C.pick(C.BANKRUPTCY_EVENT, "status")).withColumn(
        "_schedule", parse_object("loan_data", C.pick(C.LOAN_DATA, "interest_rate_schedule"))["interest_rate_schedule"])
    sizes = bound.select("loan_id", "published_at", "id",
                                     *[e.alias(n) for n, e in sums.items()])
    one = latest_per_key(sizes).agg(*[F.coalesce(F.sum(n), F.lit(0)).cast("long").alias(n)
                                      for n in sums])
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("table_name"), F.col(n).alias("n_rows")) for n in sums])))
