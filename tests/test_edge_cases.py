"""Edge cases on literal snapshot rows (NULLs, malformed payloads, shapes)."""

import datetime as dt
import decimal

from pyspark.sql import functions as F

from loanweave.functions import casts
from loanweave.functions.json import array_elements, array_or_object, first_event_date, nth
from loanweave.operators.payload import fan_out
from loanweave.operators.snapshot import latest_per_key, non_empty, rename_by_mapping, visible
from loanweave.plans import tables as TB
from loanweave.sources.contract import SNAPSHOT_SCHEMA

T0 = dt.datetime(2024, 1, 1)
LOAN_DATA = '{"loan_id":"L1","loan_uuid":"U1","origination_state":"CA","payment_method":"ach"}'


def snap(spark, *rows):
    base = {"loan_id": "L1", "id": "1", "dark": False, "published_at": T0,
            "portfolios_created_at": T0, "loan_data": LOAN_DATA,
            "customer_information": '{"customer_id": 7}'}
    recs = []
    for r in rows:
        d = {**base, **r}
        recs.append(tuple(d.get(f.name) for f in SNAPSHOT_SCHEMA.fields))
    return spark.createDataFrame(recs, SNAPSHOT_SCHEMA)


def test_hidden_flag_null_dropped(spark):
    df = snap(spark, {"id": "1", "dark": None}, {"id": "2", "dark": True}, {"id": "3"})
    assert [r.id for r in visible(df).collect()] == ["3"]


def test_version_tie_higher_id_wins(spark):
    df = snap(spark, {"id": "5"}, {"id": "7"}, {"id": "6", "published_at": dt.datetime(2023, 1, 1)})
    assert [r.id for r in latest_per_key(visible(df)).collect()] == ["7"]


def test_latest_is_per_key_and_nulls_last(spark):
    df = snap(spark, {"id": "1", "published_at": None},
              {"id": "2", "published_at": dt.datetime(2020, 1, 1)},
              {"loan_id": "L2", "id": "3", "published_at": None})
    got = sorted((r.loan_id, r.id) for r in latest_per_key(df).collect())
    assert got == [("L1", "2"), ("L2", "3")]


def test_empty_blank_null_malformed_payloads_give_no_child_rows(spark):
    spec = TB.PAYLOAD_TABLES["treasury_charge_off"]
    df = snap(spark, *[{"loan_id": f"L{i}", "id": str(i), "treasury_charge_offs": p}
                       for i, p in enumerate([None, "[]", "[ ]", "oops"])])
    lat = TB.latest(df)
    assert TB.payload_table(lat, spec).count() == 0
    obs = TB.payload_table_observed(visible(df), lat, spec).collect()
    assert len(obs) == 4
    assert all(r.treasury_charge_off_uuid is None and r.effective_date is None for r in obs)
    # text filter drops NULL and '[]' only
    assert non_empty(df, "treasury_charge_offs").count() == 2


def test_object_payload_is_one_element(spark):
    df = snap(spark, {"sale_info": '{"uuid":"x"}'})
    rows = TB.payload_table(TB.latest(df), TB.PAYLOAD_TABLES["loan_debt_sale"]).collect()
    assert [r.loan_debt_sale_uuid for r in rows] == ["x"]
    # array<string> view of an object is NULL, so fan-out on it drops the row
    assert df.select(array_elements("sale_info").alias("a")).first().a is None


def test_null_element_gives_all_null_row(spark):
    df = snap(spark, {"sale_info": '[null,{"uuid":"x"}]'})
    rows = TB.payload_table(TB.latest(df), TB.PAYLOAD_TABLES["loan_debt_sale"]).collect()
    assert sorted(str(r.loan_debt_sale_uuid) for r in rows) == ["None", "x"]


def test_nth_out_of_range_is_null(spark):
    df = spark.createDataFrame([([1],)], "a array<int>")
    assert df.select(nth(F.col("a"), 1).alias("x")).first().x is None
    assert df.select(nth(F.col("a"), 0).alias("x")).first().x == 1


def test_quoted_number_into_double_is_null(spark):
    df = snap(spark, {"settlements": '[{"amount":"1.5","status":"A"}]'})
    r = TB.payload_table(TB.latest(df), TB.PAYLOAD_TABLES["loan_servicing_settlement"]).first()
    assert r.total_amount is None and r.status == "A"


def test_cents_into_unscaled_decimal(spark):
    payload = ('[{"uuid":"a","marketplace_premium":123.45},{"uuid":"b","marketplace_premium":123.5},'
               '{"uuid":"c","marketplace_premium":12345678901}]')
    df = snap(spark, {"financial_owners": payload})
    spec = TB.PAYLOAD_TABLES["loan_financial_owner"]
    obs = TB.payload_table_observed(visible(df), TB.latest(df), spec).collect()
    # observed: second element, decimal(10,0), repeated once per owner
    assert [r.marketplace_premium for r in obs] == [decimal.Decimal(124)] * 3
    per = {r.financial_owner_uuid: r.marketplace_premium
           for r in TB.payload_table(TB.latest(df), spec).collect()}
    assert per["a"] == decimal.Decimal("123.45")


def test_observed_second_element_null_when_single(spark):
    df = snap(spark, {"financial_owners": '[{"uuid":"a","legal_entity":"E"}]'})
    spec = TB.PAYLOAD_TABLES["loan_financial_owner"]
    r = TB.payload_table_observed(visible(df), TB.latest(df), spec).first()
    assert r.financial_owner_uuid is None and r.loan_id == "L1"
    # the key still hashes the loan id alone (NULL parts skipped)
    assert r.loan_financial_owner_uuid == \
        spark.range(1).select(F.sha2(F.lit("L1"), 256).alias("h")).first().h


def test_timestamp_forms(spark):
    payload = ('[{"id":"1","adjusted_effective_date":"2024-01-02"},'
               '{"id":"2","adjusted_effective_date":"2024-01-02 03:04:05"},'
               '{"id":"3","adjusted_effective_date":"2024-01-02T03:04:05Z"}]')
    df = snap(spark, {"installments": payload})
    rows = TB.payload_table(TB.latest(df), TB.PAYLOAD_TABLES["active_installment"]).collect()
    got = {r.active_installment_id: r.adjusted_effective_date for r in rows}
    assert got == {"1": dt.datetime(2024, 1, 2), "2": dt.datetime(2024, 1, 2, 3, 4, 5),
                   "3": dt.datetime(2024, 1, 2, 3, 4, 5)}


def test_central_time(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05",), ("2024-07-02 03:04:05",), ("nope",)], "s string")
    got = [r.c for r in df.select(casts.utc_to_central(F.col("s")).alias("c")).collect()]
    assert got == [dt.datetime(2024, 1, 1, 21, 4, 5), dt.datetime(2024, 7, 1, 22, 4, 5), None]


def test_bad_casts_are_null(spark):
    df = spark.createDataFrame([("abc",), ("12.0",), ("12",), ("x",)], "s string")
    r = df.select(casts.to_int(F.col("s")).alias("i"), casts.to_date(F.col("s")).alias("d"),
                  casts.to_decimal(F.col("s")).alias("m"), casts.to_bool(F.col("s")).alias("b")).collect()
    assert [x.i for x in r] == [None, 12, 12, None]
    assert all(x.d is None for x in r)
    assert [x.m for x in r] == [None, decimal.Decimal("12.00"), decimal.Decimal("12.00"), None]


def test_payment_plan_null_type_takes_otherwise(spark):
    plan = ('{"status":"completed","adjusted_end_date":"2024-03-01","end_date":"2024-04-01",'
            '"adjusted_lock_in_date":"2024-02-01","start_date":"2024-01-05",'
            '"created_timestamp":"2024-01-02 03:04:05","id":"12.0","tdr":"true"}')
    df = snap(spark, {"payment_plans": plan})
    r = TB.payment_plan(df).first()
    assert r.status == "completed"
    assert r.adjusted_lock_in_date == dt.date(2024, 2, 1)
    assert r.completed_date is None and r.adjusted_end_date is None and r.end_date is None
    assert r.start_date == dt.date(2024, 1, 5) and r.structure is None
    assert r.loan_payment_plan_id == 12 and r.troubled_debt_restructuring_flag is True
    assert r.grace_period_days == 15 and r.customer_id == 7


def test_payment_plan_trial_rules(spark):
    plans = ('[{"plan_type":"loan_mod_trial","status":"completed","end_date":"2024-04-01",'
             '"created_timestamp":"2024-01-02 03:04:05"},'
             '{"plan_type":"deferment","status":"completed","end_date":"2024-04-01",'
             '"early_terminate_date":"2024-03-15","created_timestamp":"2024-01-02 03:04:05"}]')
    df = snap(spark, {"payment_plans": plans})
    rows = {r.structure: r for r in TB.payment_plan(df).collect()}
    t = rows["apr_reduction"]
    assert t.status == "locked_in" and t.adjusted_lock_in_date == dt.date(2024, 4, 1)
    assert t.end_date is None and t.completed_date is None
    d = rows["deferment"]
    assert d.completed_date == dt.date(2024, 4, 1)
    assert d.adjusted_end_date == dt.date(2024, 3, 15)
    assert d.start_date == dt.date(2024, 1, 1)  # Central date of the creation time


def test_payment_plan_latest_version_with_plans(spark):
    df = snap(spark,
              {"id": "1", "portfolios_created_at": dt.datetime(2024, 1, 1),
               "payment_plans": '[{"uuid":"old"}]'},
              {"id": "2", "portfolios_created_at": dt.datetime(2024, 2, 1), "payment_plans": "[]"})
    assert [r.loan_payment_plan_uuid for r in TB.payment_plan(df).collect()] == ["old"]


def test_array_or_object(spark):
    df = spark.createDataFrame([('{"a":1}',), ('[{"a":1},{"a":2}]',), ("[]",), (None,),
                                ("5",), ("oops",)], "s string")
    got = [r.x for r in df.select(array_or_object("s").alias("x")).collect()]
    assert got[0] == ['{"a":1}'] and len(got[1]) == 2
    assert got[2:] == [None, None, None, None]


def test_fan_out_matches_explode_of_elements(spark):
    texts = ['[1,2,3]', '[null,{"a":1}]', "[]", "[ ]", None, "oops", '{"a":1}', '[[1],[2]]']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    a = sorted(r.i for r in fan_out(df, "s").collect())
    b = sorted(r.i for r in df.select("i", F.explode(array_elements("s"))).collect())
    assert a == b


def test_first_event_date_rules(spark):
    ddl = "array<struct<date string, status string>>"
    df = spark.createDataFrame([
        ('[{"date":"2024-01-03","status":"petitioned"},{"date":"2024-01-02","status":"petitioned"}]',),
        ('[{"status":"petitioned"},{"date":"2024-01-02","status":"petitioned"}]',),
        ('[{"date":"2024-01-02","status":"filed"}]',), ("oops",)], "s string")
    got = [r.x for r in df.select(first_event_date(F.from_json("s", ddl), "petitioned").alias("x")).collect()]
    assert got == ["2024-01-02", None, None, None]


def test_timeline_shapes_agree(spark):
    ev = ('{"date":"2024-01-02 10:00:00","status":"petitioned","chapter":"7"},'
          '{"date":"2024-01-05 10:00:00","status":"discharged","chapter":"7"}')
    shapes = [f'[{{"event_history":[{ev}]}}]', f'{{"event_history":[{ev}]}}', f"[{ev}]"]
    df = snap(spark, *[{"loan_id": f"L{i}", "id": str(i), "bankruptcy_timeline": s,
                        "bankruptcy_claims": "[]"} for i, s in enumerate(shapes)])
    rows = TB.bankruptcy(TB.latest(df)).collect()
    assert len(rows) == 3
    assert {(r.petitioned_date, r.discharged_date, r.status) for r in rows} == {
        (dt.date(2024, 1, 2), dt.date(2024, 1, 5), "discharged")}


def test_rename_by_mapping(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    out = rename_by_mapping(df, "a\r\nzz", "x\r\ny")
    assert out.columns == ["x", "b"]


def test_payload_key_counts_shapes(spark):
    from loanweave.operators.drift import payload_key_counts
    df = snap(spark,
              {"id": "1", "installments": '[{"id":"a","x":1},{"id":"b"}]'},
              {"id": "2", "installments": '{"id":"c","y":2}'},         # lone object = one element
              {"id": "3", "installments": '[1, "s", [2], null, {"id":"d"}]'},  # only objects count
              {"id": "4", "installments": "oops"},
              {"id": "5", "installments": None},
              {"id": "6", "installments": "[]"})
    got = {(r.payload, r.key): r.n for r in payload_key_counts(df, ["installments"]).collect()}
    assert got == {("installments", "id"): 4, ("installments", "x"): 1, ("installments", "y"): 1}


def test_element_that_is_no_object_leaves_its_siblings(spark):
    df = snap(spark, {"installments": '[{"id":"a"},{"id":"b"},7]', "bankruptcy_claims": '[{"status":"s"},"x"]'})
    lat = TB.latest(df)
    rows = TB.payload_table(lat, TB.PAYLOAD_TABLES["active_installment"]).collect()
    assert len(rows) == 3 and TB.bankruptcy(lat).count() == 2


def test_key_of_a_null_id_is_null(spark):
    df = snap(spark, {"installments": '[{"interest_amount":1.0},{"id":"b"}]'})
    rows = TB.payload_table(TB.latest(df), TB.PAYLOAD_TABLES["active_installment"]).collect()
    assert sorted((r.active_installment_uuid is None for r in rows)) == [False, True]


def test_to_int_takes_no_exponent(spark):
    from loanweave.functions.casts import to_int
    df = spark.createDataFrame([("1e3",), ("12.0",), ("12.9",), (" 7 ",), ("x",), ("-3.",), (None,), ("1E2",)], "s string")
    assert [r.x for r in df.select(to_int(F.col("s")).alias("x")).collect()] == [None, 12, 12, 7, None, -3, None, None]


def test_element_rows_equals_the_parsed_size(spark):
    from loanweave.functions.json import element_rows, parse_array
    texts = ["[]", "[{}]", '[{"id":"a"},7,null]', '{"id":"a"}', ' {"id":1}', "{bad", "[1,", "5", "null", "", None, '["x"]', "[[1],[2]]"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = df.select(element_rows("s").alias("n"), F.coalesce(F.size(parse_array("s", "id string")), F.lit(0)).alias("m")).collect()
    assert [r.n for r in got] == [max(r.m, 0) for r in got]
