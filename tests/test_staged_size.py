"""Staged snapshots stay near the size of their tables, and writing them in parts changes no row."""

import datetime as dt
import os
import random
import tempfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

from loanweave.operators.snapshot import latest_per_key, visible
from loanweave.session import CLEAN_UP
from loanweave.sources import bucketed, fixture, snapshot

T0 = dt.datetime(1995, 1, 1)


def size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


@pytest.fixture(scope="module")
def tables(spark):
    r, d = random.Random(5), tempfile.mkdtemp(prefix="tables-")
    day = lambda: T0 + dt.timedelta(days=r.randrange(2400))
    orders = [(k, r.randrange(300), r.choice("OFP"), float(k), day(), r.choice(["1-URGENT", "5-LOW"])) for k in range(3000)]
    orders += [(7, 3, "O", 1.0, day(), None), (None, 4, "F", 1.0, day(), "x"), (9001, None, None, None, None, None)]
    lines = [(r.randrange(3000), r.randrange(20000), r.randrange(1000), r.randrange(7), float(r.randrange(50)), r.randrange(10**7) / 100,
              r.randrange(11) / 100, r.randrange(9) / 100, r.choice("ARN"), r.choice("OF"), day()) for _ in range(12000)]
    lines += [lines[0], (7, None, None, None, None, float("nan"), None, None, None, None, None),
              (7, 1, 1, 1, 1.0, 1e-7, 0.1, 0.1, 'quo"te', "", T0 + dt.timedelta(microseconds=3)), (None, 1, 1, 1, 1.0, 1.0, 1.0, 1.0, "A", "O", T0)]
    events = [(k, T0 + dt.timedelta(seconds=r.randrange(10**8)), r.randrange(300), r.choice(["error", "signup", "purchase", "view", None]))
              for k in range(2000)]
    for name, rows, ddl in (
            ("orders", orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"),
            ("lineitem", lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                                "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
            ("customer", [(k, r.choice(["FURNITURE", "MACHINERY", "OTHER"])) for k in range(250)], "c_custkey long, c_mktsegment string"),
            ("events", events, "event_id long, ts timestamp_ntz, user_id long, event_type string")):
        spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(f"{d}/{name}.parquet")
    return d


def rows(df):
    return Counter(map(repr, df.collect()))


def test_staged_snapshot_is_near_the_size_of_its_tables(spark, tables):
    staged = size(snapshot.portfolio_file(spark, tables))
    assert 0 < staged < 3 * size(tables)


@pytest.mark.parametrize("half", [None, "before", "after"])
def test_parts_hold_the_rows_of_the_whole(spark, tables, half, monkeypatch):
    want = rows(fixture.build_snapshot(spark, tables, half))
    monkeypatch.setattr(snapshot, "PART_BYTES", size(tables) // 3)
    assert snapshot.parts_of(spark, tables) > 2
    path = tempfile.mkdtemp(prefix="versions-") + "/v"
    snapshot.write_versions(spark, tables, half, path)
    assert rows(snapshot.render_versions(spark.read.parquet(path), tables, half)) == want
    assert spark.conf.get(CLEAN_UP, None) in (None, "false")


def test_layout_in_parts_ranks_without_exchange(spark, tables, monkeypatch):
    versions = spark.read.parquet(snapshot.portfolio_file(spark, tables))
    monkeypatch.setattr(bucketed, "PART_BYTES", 20_000)
    assert bucketed.bucket_count(versions, bucketed.PART_BYTES) > 2
    path = tempfile.mkdtemp(prefix="layout-") + "/l"
    bucketed.write_layout(versions, path, buckets=3)
    top = latest_per_key(visible(bucketed.read_layout(spark, path)[0]))
    assert "Exchange" not in top._jdf.queryExecution().executedPlan().toString()
    ids = lambda df: Counter(map(tuple, df.select("loan_id", "id", "published_at").collect()))
    assert ids(bucketed.latest_of_layout(spark, path)) == ids(latest_per_key(visible(versions)).where(F.lit(True)))
