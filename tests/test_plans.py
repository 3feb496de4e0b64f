"""Plan-shape regressions: shuffles per query, partial top-1 before the
shuffle, pushed visibility filter, no Python evaluation anywhere."""

import pytest

from loanweave.plans.catalog import QUERIES
from tools.plan_report import formatted, summarise

from conftest import SF_SMALL

# Upper bounds on shuffle exchanges for the queries built on the latest frame.
MAX_SHUFFLES = {
    **{n: 1 for n in ("loan_debt_sale", "loan_servicing_settlement", "active_installment",
                      "bankruptcy", "interest_rate", "loan_collection_case",
                      "loan_financial_owner", "operational_charge_off", "treasury_charge_off",
                      "payment_plan", "latest_per_key", "child_ordinal", "first_event_dates",
                      "loan_debt_sale_observed", "loan_servicing_settlement_observed",
                      "active_installment_observed", "loan_collection_case_observed",
                      "operational_charge_off_observed", "treasury_charge_off_observed",
                      "bankruptcy_observed")},
    "original_installment": 2,            # ranking + distinct
    "original_installment_observed": 1,   # distinct only (visible frame)
    "loan_financial_owner_observed": 0,   # visible frame, fan-out only
    "visible_rows": 0, "snapshot_scan": 0, "json_array_rows": 0, "array_nth": 0,
    # one narrow ranking for nine tables + global sum; distinct table (2); payment plans (1)
    "table_row_counts": 7,
}


@pytest.fixture(scope="module")
def plans(spark):
    return {n: summarise(formatted(fn(spark, SF_SMALL))) for n, fn in QUERIES.items()}


def test_no_python_in_any_plan(plans):
    assert [n for n, s in plans.items() if s["python"]] == []


@pytest.mark.parametrize("name", sorted(MAX_SHUFFLES))
def test_shuffle_budget(plans, name):
    assert plans[name]["exchanges"] <= MAX_SHUFFLES[name]


@pytest.mark.parametrize("name", sorted(n for n, b in MAX_SHUFFLES.items() if b >= 1
                                        and n != "original_installment_observed"))
def test_latest_frame_is_reduced_before_the_shuffle(plans, name):
    assert plans[name]["partial_top1"]


@pytest.mark.parametrize("name", ["loan_debt_sale", "interest_rate", "payment_plan",
                                  "loan_financial_owner_observed", "visible_rows"])
def test_visibility_filter_reaches_the_scan(plans, name):
    snapshot_scans = [p for t, p, _ in plans[name]["scans"] if t.startswith("portfolio_")]
    assert snapshot_scans and all("EqualTo(dark,true)" in p for p in snapshot_scans)


def test_scans_read_few_columns(plans):
    # the snapshot has 24 columns; table queries read ids + loan_data + one payload
    for name in ("loan_debt_sale", "active_installment", "treasury_charge_off_observed"):
        assert all(w <= 8 for t, _, w in plans[name]["scans"] if t.startswith("portfolio_"))


# Whole-payload parses (from_json to an array of structs at the top of a text) per query.
WHOLE_PARSES = {"first_event_dates": 1, "bankruptcy": 2, "bankruptcy_observed": 1, "loan_debt_sale": 1,
                "loan_debt_sale_observed": 1, "json_array_rows": 1, "child_ordinal": 1, "active_installment": 1,
                "loan_financial_owner_observed": 1, "payment_plan": 1}


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", sorted(WHOLE_PARSES))
def test_each_payload_text_is_parsed_once(spark, name):
    """One top-level parse per payload column; the repair of mixed arrays is a
    branch that only rows without a whole parse reach."""
    plan = _optimized(QUERIES[name](spark, SF_SMALL))
    assert plan.count("from_json(ArrayType(StructType(") == WHOLE_PARSES[name]
    assert plan.count("from_json(ArrayType(StringType") == WHOLE_PARSES[name]


def test_parsed_structs_hold_only_the_fields_that_are_read(spark):
    rows = _optimized(QUERIES["json_array_rows"](spark, SF_SMALL))
    assert "StructField(principal_amount" in rows
    for unread in ("interest_amount", "late_fees_amount", "original_effective_date"):
        assert f"StructField({unread}" not in rows
    events = _optimized(QUERIES["first_event_dates"](spark, SF_SMALL))
    assert "StructField(date" in events and "StructField(chapter" not in events and "attorney" not in events
    counts = _optimized(QUERIES["table_row_counts"](spark, SF_SMALL))
    assert counts.count("StructField(event_history") == 2  # the parse and its repair
