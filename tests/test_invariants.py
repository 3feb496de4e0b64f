"""Structural invariants of the mart on the smallest tables."""

import re

from pyspark.sql import functions as F

from loanweave.operators.snapshot import visible
from loanweave.plans import tables as TB
from loanweave.plans.catalog import QUERIES
from loanweave.sources.snapshot import portfolio_snapshot

from conftest import SF_SMALL


def test_one_latest_row_per_loan(spark):
    lat = TB.latest(portfolio_snapshot(spark, SF_SMALL))
    assert lat.groupBy("loan_id").count().filter("count > 1").count() == 0
    assert lat.count() == visible(portfolio_snapshot(spark, SF_SMALL)).select("loan_id").distinct().count()


def test_keys_are_sha256_hex(spark):
    for name, col in [("active_installment", "active_installment_uuid"),
                      ("loan_servicing_settlement", "loan_servicing_settlement_uuid"),
                      ("interest_rate", "interest_rate_uuid"), ("bankruptcy", "bankruptcy_uuid")]:
        vals = [r[0] for r in QUERIES[name](spark, SF_SMALL).select(col).distinct().collect()]
        assert vals and all(re.fullmatch(r"[0-9a-f]{64}", v) for v in vals), name


def test_observed_multiplicity_is_sum_of_element_counts(spark):
    snap = portfolio_snapshot(spark, SF_SMALL)
    lat = TB.latest(snap)
    expected = (lat.filter(F.col("installments") != "[]")
                .select(F.sum(F.json_array_length("installments"))).first()[0])
    assert QUERIES["active_installment_observed"](spark, SF_SMALL).count() == expected
    owners = (lat.filter(F.col("sale_info") != "[]")
              .select(F.sum(F.json_array_length("financial_owners"))).first()[0])
    assert QUERIES["loan_debt_sale_observed"](spark, SF_SMALL).count() == owners


def test_interest_rate_factorisation_equals_brute_force_product(spark):
    """On the small fixture, materialise the source's many-to-many join and
    check that the factorised result describes it exactly."""
    vis = visible(portfolio_snapshot(spark, SF_SMALL))
    ld = F.from_json("loan_data", "loan_id string, interest_rate_schedule "
                                  "array<struct<interest_rate string, effective_date string>>")
    right = vis.select(ld["loan_id"].alias("jl"), F.explode(ld["interest_rate_schedule"]).alias("e"))
    left = vis.select("loan_id", "id")
    product = left.join(right, left.loan_id == right.jl, "left")
    brute = (product.groupBy("loan_id", F.col("e.interest_rate").alias("r"),
                             F.col("e.effective_date").alias("d"))
             .count().collect())
    brute = sorted((r.loan_id, r.r, r.d, r["count"]) for r in brute)
    fact = QUERIES["interest_rate_observed"](spark, SF_SMALL).collect()
    fact = sorted((r.loan_id, r.interest_rate, r.effective_date, r.row_count) for r in fact)
    assert fact == brute
    per_version = QUERIES["interest_rate_observed_versions"](spark, SF_SMALL)
    total = per_version.select(F.sum(F.greatest("schedule_rows", F.lit(1)))).first()[0]
    assert total == product.count()


def test_drift_reports_added_and_removed_key(spark):
    rows = QUERIES["payload_key_drift"](spark, SF_SMALL).filter("payload = 'installments'").collect()
    status = {r.key: r.status for r in rows}
    assert status["currency"] == "added" and status["late_fees_amount"] == "removed"
    assert status["id"] == "kept"
    sd = {(r.kind, r.column, r.path): r.status for r in QUERIES["schema_drift"](spark, SF_SMALL).collect()}
    assert sd[("path", "installments", "$[].currency")] == "added"
    assert sd[("path", "operational_charge_offs", "$[].charge_off_amount.fees")] == "same"
    assert sd[("path", "loan_data", "$")] == "same" and sd[("path", "customer_information", "$.customer_id")] == "same"
    # The halves are compared by their own footers.
    assert sd[("column", "*", None)] == "different" and sd[("column", "loan_id", None)] == "same"
    assert (sd[("column", "servicing_region", None)], sd[("column", "accounts_build_end_time", None)],
            sd[("column", "etl_ingestion_time", None)]) == ("added", "removed", "type_changed")


def test_shuffle_partitions_sized_per_job(spark):
    from loanweave.plans.mart import widest_table_bytes
    from loanweave.session import INITIAL_PARTITIONS, shuffle_partitions_for, sized_shuffles
    before = spark.conf.get(INITIAL_PARTITIONS, None)
    assert shuffle_partitions_for(spark, 1) >= int(spark.conf.get("spark.sql.shuffle.partitions"))
    with sized_shuffles(spark, 100 * 1024 ** 4) as n:  # 100 TB carried: no cap
        assert n * 128 * 1024 ** 2 >= 4 * 100 * 1024 ** 4
        assert spark.conf.get(INITIAL_PARTITIONS) == str(n)
    assert spark.conf.get(INITIAL_PARTITIONS, None) == before
    snap = portfolio_snapshot(spark, SF_SMALL)
    assert 0 < widest_table_bytes(snap, shared=False) < widest_table_bytes(snap, shared=True)


def test_mart_shuffles_carry_ids_and_one_payload(spark):
    """No ranking shuffle of the default mart carries columns its table does not use."""
    from loanweave.plans.mart import build_mart
    from loanweave.sources import contract
    for name, df in build_mart(spark, portfolio_snapshot(spark, SF_SMALL), observed=True).items():
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        for line in plan.splitlines():
            if "Relation [" in line or "Project [" not in line:
                continue
            payloads = [p for p in contract.PAYLOAD_ARRAY_COLUMNS if re.search(rf"(\[|, ){p}#", line)]
            assert len(payloads) <= 2, (name, line)
            assert len(payloads) < 2 or set(payloads) in (
                {"bankruptcy_timeline", "bankruptcy_claims"}, {"sale_info", "financial_owners"},
                {"settlements", "financial_owners"}), (name, line)


def test_shared_folder_is_required_on_a_cluster():
    import pytest
    from loanweave.session import checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

    class Session:
        conf = Conf()
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())


def test_half_written_staged_snapshot_is_rebuilt(spark):
    """A staged snapshot without its _SUCCESS marker (a job lost while
    writing) is not trusted: it is rebuilt, never read half-written."""
    import glob
    import os
    from loanweave.sources.snapshot import _fingerprint
    from loanweave.session import scratch_path
    snap = portfolio_snapshot(spark, SF_SMALL)
    n = snap.count()
    path = scratch_path(spark, "snapshots", f"portfolio_{_fingerprint(spark, SF_SMALL, None)}.parquet")
    os.remove(os.path.join(path, "_SUCCESS"))
    for f in glob.glob(os.path.join(path, "part-*"))[1:]:
        os.remove(f)  # leave a partial file set behind
    assert portfolio_snapshot(spark, SF_SMALL).count() == n
    assert os.path.exists(os.path.join(path, "_SUCCESS"))
