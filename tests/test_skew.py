"""A loan holding a third of all rows: results stay exact and the plans keep
the hot key from reaching one task whole."""

import datetime as dt
import json

import pytest
import tempfile

from pyspark.sql import functions as F

from loanweave.operators.snapshot import visible
from loanweave.plans import tables as TB
from loanweave.sources.contract import SNAPSHOT_SCHEMA

N_HOT, N_COLD = 600, 400  # hot loan: 600 of 1,800 versions (one third)


@pytest.fixture(scope="module")
def skewed(spark):
    recs = []
    base = dt.datetime(2020, 1, 1)

    def row(loan, i):
        sched = [{"interest_rate": f"0.0{i % 5}", "effective_date": f"2020-01-{1 + i % 3:02d}"}]
        d = {"loan_id": loan, "id": f"{loan}-{i:05d}", "dark": i % 7 == 0,
             "published_at": base + dt.timedelta(hours=i),
             "portfolios_created_at": base + dt.timedelta(hours=i),
             "loan_data": json.dumps({"loan_id": loan, "loan_uuid": f"u-{loan}",
                                      "interest_rate_schedule": sched}),
             "installments": json.dumps([{"id": f"{loan}-{i}-a"}, {"id": f"{loan}-{i}-b"}]),
             "financial_owners": json.dumps([{"uuid": "o1"}, {"uuid": "o2"}]),
             "payment_plans": json.dumps([{"uuid": f"p{i}", "status": "active"}])}
        return tuple(d.get(f.name) for f in SNAPSHOT_SCHEMA.fields)

    recs += [row("HOT", i) for i in range(N_HOT)]
    recs += [row(f"C{j}", i) for j in range(N_COLD) for i in range(3)]
    return spark.createDataFrame(recs, SNAPSHOT_SCHEMA).repartition(16)


def test_latest_exact_under_skew(skewed):
    lat = {r.loan_id: r.id for r in TB.latest(skewed).collect()}
    assert len(lat) == N_COLD + 1
    hot_last = max(i for i in range(N_HOT) if i % 7 != 0)
    assert lat["HOT"] == f"HOT-{hot_last:05d}"


def test_latest_is_reduced_before_the_shuffle(skewed):
    plan = TB.latest(skewed)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_observed_rate_product_exact_under_skew(spark, skewed):
    vis = visible(skewed)
    ld = F.from_json("loan_data", "loan_id string, interest_rate_schedule "
                                  "array<struct<interest_rate string, effective_date string>>")
    right = vis.select(ld["loan_id"].alias("jl"), F.explode(ld["interest_rate_schedule"]).alias("e"))
    product = vis.select("loan_id").join(right, F.col("loan_id") == F.col("jl"), "left")
    brute = sorted((r.loan_id, r.r, r.d, r["count"]) for r in product.groupBy(
        "loan_id", F.col("e.interest_rate").alias("r"), F.col("e.effective_date").alias("d")).count().collect())
    fact = sorted((r.loan_id, r.interest_rate, r.effective_date, r.row_count)
                  for r in TB.interest_rate_observed(vis).collect())
    assert fact == brute
    hot_rows = sum(c for loan, _, _, c in fact if loan == "HOT")
    hot_versions = sum(1 for i in range(N_HOT) if i % 7 != 0)
    assert hot_rows == hot_versions * hot_versions  # every version x every entry


def test_observed_fan_out_exact_under_skew(skewed):
    spec = TB.PAYLOAD_TABLES["loan_financial_owner"]
    obs = TB.payload_table_observed(visible(skewed), TB.latest(skewed), spec)
    visible_rows = visible(skewed).count()
    assert obs.count() == 2 * visible_rows  # two owners per visible version


def test_payment_plan_one_loan_one_version_under_skew(skewed):
    rows = TB.payment_plan(skewed).groupBy("loan_uuid").count().collect()
    # one plan per loan: only the latest version with plans contributes
    assert len(rows) == N_COLD + 1 and all(r["count"] == 1 for r in rows)
    plan = TB.payment_plan(skewed)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_hot_loan_is_split_in_both_rate_joins(spark, skewed):
    """With broadcasts off and small thresholds the final plans split the hot loan."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.files.maxPartitionBytes": "16k",
            "spark.sql.files.openCostInBytes": "1k"}
    before = {k: spark.conf.get(k, None) for k in conf}
    path = tempfile.mkdtemp(prefix="skewed-") + "/s"
    hot = [("HOT", f"{r:.3f}", f"2024-01-{1 + k:02d}") for r in range(900) for k in range(9)]
    cold = [(f"c{i}", "1.000", "2024-01-01") for i in range(60)]
    by = {}
    for loan, rate, day in hot + cold:
        by.setdefault(loan, []).append({"interest_rate": rate, "effective_date": day})
    import json
    rows = [(loan, f"{loan}-{i}", json.dumps({"loan_id": loan, "loan_uuid": loan, "interest_rate_schedule": s[i::60] or s[:1]}))
            for loan, s in by.items() for i in range(60 if loan == "HOT" else 1)] + [
                ("HOT", f"HOT-x{i}", json.dumps({"loan_id": "HOT", "loan_uuid": "HOT", "interest_rate_schedule": []})) for i in range(3000)]
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        spark.createDataFrame(rows, "loan_id string, id string, loan_data string").repartition(16).write.parquet(path)
        frame = spark.read.parquet(path)
        for name in ("accounts_created_at", "accounts_updated_at", "accounts_build_end_time"):
            frame = frame.withColumn(name, F.lit(None).cast("timestamp_ntz"))
        for build in (TB.interest_rate_observed, TB.interest_rate_observed_versions):
            df = build(frame)
            df.collect()
            assert "skew=true" in df._jdf.queryExecution().executedPlan().toString(), build.__name__
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
