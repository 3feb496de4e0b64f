"""Ranking ids first and ranking bucketed versions give the rows of the plain ranking."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from loanweave.operators import late
from loanweave.operators.snapshot import latest_per_key, visible
from loanweave.sources import bucketed

DDL = "loan_id string, id string, dark boolean, published_at timestamp_ntz, payload string"
T0 = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def versions(spark):
    rows = [("HOT", f"h{i:04d}", i % 5 == 0, T0 + dt.timedelta(hours=i), f"p{i}") for i in range(900)]
    rows += [(f"L{j}", f"{j}-{i}", i == 2 and j % 3 == 0, T0 + dt.timedelta(hours=i // 2), f"q{j}.{i}") for j in range(300) for i in range(3)]
    rows += [("SAME", "s", False, T0, "twin"), ("SAME", "s", False, T0, "twin"), (None, "n1", False, T0, "x"),
             (None, "n2", False, None, "y"), ("LATE", None, False, None, "z"), ("GONE", "g", None, T0, "w")]
    path = tempfile.mkdtemp(prefix="versions-") + "/v"
    spark.createDataFrame(rows, DDL).repartition(12).write.parquet(path)
    return spark.read.schema(DDL).parquet(path)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_ids_first_equals_plain_ranking(versions):
    vis = visible(versions)
    ids = late.latest_ids(vis)
    assert late.has_ties(ids)
    want = rows(latest_per_key(vis))
    assert rows(late.fetch_latest(vis, ids)) == want
    only = vis.where("loan_id != 'SAME'")
    ids = late.latest_ids(only)
    assert not late.has_ties(ids)
    assert rows(late.fetch_latest(only, ids, ties=False)) == rows(latest_per_key(only))


def test_payload_is_not_shuffled_or_is_filtered_before(spark, versions):
    vis = visible(versions).where("loan_id is not null and loan_id != 'SAME'")
    ids = late.latest_ids(vis)
    small = late.fetch_latest(vis, ids, ties=False)
    rows(small)
    plan = small._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with late.bloom_filters(spark, ids.count()):
            large = late.fetch_latest(vis, ids, ties=False)
            got = rows(large)
            plan = large._jdf.queryExecution().optimizedPlan().toString()
        assert "might_contain" in plan and got == rows(latest_per_key(vis))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_buckets_rank_without_exchange_and_hot_loan_stands_apart(spark, versions):
    path = tempfile.mkdtemp(prefix="layout-") + "/l"
    assert bucketed.write_layout(versions, path, buckets=4) == 4
    calm, hot = bucketed.read_layout(spark, path)
    assert {r[0] for r in hot.select("loan_id").distinct().collect()} == {"HOT"}
    assert calm.where("loan_id = 'HOT'").count() == 0 and calm.count() + hot.count() == versions.count()
    top = latest_per_key(visible(calm))
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan
    hot_plan = latest_per_key(visible(hot))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in hot_plan and "Partial" in hot_plan  # one row a task before the shuffle
    want = rows(latest_per_key(visible(versions)))
    assert rows(bucketed.latest_of_layout(spark, path)) == want
    spark.sql(f"DROP TABLE {bucketed._table(path)}")  # another session knows nothing of it
    assert rows(bucketed.latest_of_layout(spark, path)) == want
    again = latest_per_key(visible(bucketed.read_layout(spark, path)[0]))
    assert "Exchange" not in again._jdf.queryExecution().executedPlan().toString()


def test_layout_without_hot_loans_or_rows(spark, versions):
    for frame in (versions.where("loan_id != 'HOT'"), versions.limit(0)):
        path = tempfile.mkdtemp(prefix="layout-") + "/l"
        bucketed.write_layout(frame, path, buckets=1 if frame.count() == 0 else 2)
        assert rows(bucketed.latest_of_layout(spark, path)) == rows(latest_per_key(visible(frame)))


def test_bucket_count_follows_bytes(versions):
    assert bucketed.bucket_count(versions, 1 << 40) == 1
    assert bucketed.bucket_count(versions, 1000) > 4
