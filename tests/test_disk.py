"""What queries keep on disk: staged versions, what rankings carry, shuffle files of staged frames."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from loanweave.plans import tables as TB
from loanweave.plans.catalog import QUERIES
from loanweave.operators.snapshot import latest_per_key, visible
from loanweave.session import stage
from loanweave.sources import bucketed, snapshot
from tests.test_staged_size import rows, size, tables  # noqa: F401

SF_SMALL = "/root/testdata/sf0.001"


def shuffle_mb(spark):
    local = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    found = [local.apply(i) for i in range(local.size())]
    return sum(f.length() for f in found if f.getName().startswith("shuffle_")) / 1e6


def test_staged_versions_hold_each_field_by_itself(spark, tables):  # noqa: F811
    path = snapshot.portfolio_file(spark, tables)
    kind = spark.read.parquet(path).schema["_lines"].dataType.simpleString()
    assert kind.startswith("array<struct<l_linenumber:")
    assert size(path) < 1.8 * size(tables)


@pytest.mark.parametrize("name", ["active_installment", "interest_rate", "child_ordinal", "operational_charge_off", "payment_plan"])
def test_texts_are_written_after_the_ranking(spark, name):
    """Nothing below the ranking's shuffle carries a text that is written there."""
    plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    ranked = max(i for i, line in enumerate(plan) if "Window [" in line)
    below = next(line for line in plan[ranked + 1:] if "Project [" in line)
    assert "_lines" in below
    assert not any(f"{text}#" in below for text in ("loan_data", "installments", "operational_charge_offs", "payment_plans"))


def test_staged_frames_leave_no_shuffle_files(spark):
    before = shuffle_mb(spark)
    df = spark.range(400_000).select((F.col("id") * 7919 % 400_009).alias("k")).groupBy("k").agg(F.count("*").alias("n"))
    assert stage(df, "counts").count() == 400_000
    assert shuffle_mb(spark) - before < 0.5


def test_layout_needs_no_staged_versions(spark, monkeypatch):
    data = tempfile.mkdtemp(prefix="layout-tables-")
    for name in ("orders", "lineitem", "customer", "events"):
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").write.parquet(f"{data}/{name}.parquet")
    monkeypatch.setattr(snapshot, "PART_BYTES", snapshot.input_bytes(spark, data) // 3)
    path = snapshot.portfolio_layout(spark, data)
    assert not os.path.exists(snapshot._portfolio_path(spark, data, None))
    key = ["loan_id", "id", "published_at"]
    want = latest_per_key(visible(snapshot.portfolio_versions(spark, data)))
    assert rows(bucketed.latest_of_layout(spark, path).select(*key, F.size("_lines").alias("n"))) == \
        rows(want.select(*key, F.size("_lines").alias("n")))


def test_distinct_rows_are_told_apart_before_the_key_is_hashed(spark):
    df = QUERIES["original_installment_observed"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    at = next(i for i, line in enumerate(plan) if "Aggregate [" in line)
    grouped = plan[at].split("], [")[0]
    assert "_key#" in grouped and "original_installment_uuid" not in grouped
    assert any("sha2(" in line for line in plan[:at + 1])
    keyed = TB.PAYLOAD_TABLES["original_installment"]
    assert keyed.distinct and df.columns == list(keyed.output)
    assert df.count() == df.distinct().count()
