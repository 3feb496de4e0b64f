"""Date texts of the payloads: written by casts, the same as a formatter writes."""

from pyspark.sql import functions as F

from loanweave.sources import fixture

TIMES = ["0001-01-01 00:00:00", "0000-06-01 23:59:59.999999", "-0044-03-15 01:02:03", "1582-10-10 10:10:10", "1969-12-31 23:59:59.999999",
         "2000-02-29 00:00:00", "9999-12-31 23:59:59.5", "+12345-12-31 12:00:00.000001", None]


def test_days_are_as_formatted(spark):
    t = F.col("t").cast("timestamp_ntz")
    df = spark.createDataFrame([(x,) for x in TIMES], "t string")
    for n in (0, 1, 30, 120):
        want = F.date_format(t + F.expr(f"INTERVAL {n} DAYS"), "yyyy-MM-dd")
        rows = df.select(fixture._day(t, n).alias("got"), want.alias("want")).collect()
        assert [r["got"] for r in rows] == [r["want"] for r in rows]
        assert [r["got"] is None for r in rows] == [x is None for x in TIMES]


def test_plan_texts_format_one_date_a_line(spark):
    """The id of a line is the only text of a plan that needs a formatter."""
    lines = "array<struct<l_linenumber:int,l_partkey:bigint,l_suppkey:bigint,l_shipdate:timestamp_ntz,l_quantity:double,l_extendedprice:double," \
            "l_discount:double,l_tax:double,l_returnflag:string,l_linestatus:string>>"
    days = "array<array<struct<ts:timestamp_ntz,event_id:bigint,status:string>>>"
    versions = spark.createDataFrame([], f"loan_id string, id string, _priority string, _segment string, _lines {lines}, _days {days}")
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        plan = fixture.render(versions).select("payment_plans")._jdf.queryExecution().analyzed().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    plans = plan[:plan.index(" AS payment_plans")].split(" AS treasury_charge_offs")[1]
    assert plans.count("date_format") == 1 and "INTERVAL" not in plans
