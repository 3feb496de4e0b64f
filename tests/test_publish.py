"""A date's tables appear together or not at all; files are of a bounded size."""

import datetime as dt
import glob
import os
import tempfile
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from loanweave.operators import publish, sink
from loanweave.operators.publish import Publication, read_published
from loanweave.plans import mart
from loanweave.plans import tables as TB
from loanweave.sources.snapshot import portfolio_snapshot

from conftest import SF_SMALL

D, E = dt.date(2024, 5, 1), dt.date(2024, 5, 2)


def write(spark, root, day, **tables):
    with Publication(spark, root, day, dt.datetime(2024, 5, 1)) as run:
        for name, values in tables.items():
            run.write(spark.createDataFrame([(v,) for v in values], "x int"), name)


def seen(spark, root, table, **kw):
    return sorted((r["extract_date"], r["x"]) for r in read_published(spark, root, table, **kw).collect())


def test_readers_see_the_old_date_whole_until_the_new_one_is(spark, monkeypatch):
    root, snap = tempfile.mkdtemp(prefix="pub-"), portfolio_snapshot(spark, SF_SMALL)
    first = dt.datetime(2024, 5, 1, 1)
    mart.run_mart(spark, snap, root, D, first, parallelism=1)
    names = list(mart.MART_TABLES)
    before = {n: read_published(spark, root, n).count() for n in names}
    assert all(before.values())

    def die(snapshot, vis, lat):
        return lat.select(F.raise_error(F.lit("killed between two tables")).cast("string").alias("x"))

    monkeypatch.setitem(mart.MART_TABLES, names[5], die)
    with pytest.raises(Exception, match="killed"):
        mart.run_mart(spark, snap.limit(3), root, D, dt.datetime(2024, 5, 1, 2), parallelism=1)
    for n in names:
        rows = read_published(spark, root, n)
        assert rows.count() == before[n]
        assert {r[0] for r in rows.select("extract_timestamp").distinct().collect()} == {first}
        assert len(glob.glob(f"{root}/{n}/run=*")) == 1  # what the dead run wrote is gone


def test_runs_replace_a_date_and_leave_the_others(spark):
    root = tempfile.mkdtemp(prefix="pub-")
    write(spark, root, D, a=[1, 2], b=[3])
    write(spark, root, E, a=[7], b=[8])
    held = read_published(spark, root, "a")
    write(spark, root, D, a=[])
    assert seen(spark, root, "a") == [(E, 7)] and seen(spark, root, "a", dates=[D]) == []
    assert seen(spark, root, "b") == [(E, 8)]  # the second run of D had no such table
    assert held.count() == 3  # resolved before: still the old run
    with pytest.raises(publish.NotPublished):
        read_published(spark, root, "c")
    with pytest.raises(publish.NotPublished):
        read_published(spark, tempfile.mkdtemp(prefix="pub-"), "a")


def test_a_run_that_never_commits_is_not_seen_and_is_removed_later(spark):
    root = tempfile.mkdtemp(prefix="pub-")
    write(spark, root, D, a=[1])
    dead = Publication(spark, root, D)
    left = dead.write(spark.createDataFrame([(9,)], "x int"), "a")
    open(os.path.join(root, "_manifests", f"extract_date={D}", ".00000002.json.draft"), "w").write("{half")
    assert seen(spark, root, "a") == [(D, 1)]
    assert publish.remove_unpublished(spark, root) == []  # too young: may be under way
    assert publish.remove_unpublished(spark, root, dt.timedelta(0)) == [left]
    assert seen(spark, root, "a") == [(D, 1)]


def test_two_commits_at_once_both_get_a_number(spark):
    root = tempfile.mkdtemp(prefix="pub-")
    runs = [Publication(spark, root, D) for _ in range(6)]
    for i, run in enumerate(runs):
        run.write(spark.createDataFrame([(i,)], "x int"), "a")
    with ThreadPoolExecutor(6) as pool:
        paths = list(pool.map(lambda r: r.commit(), runs))
    assert sorted(os.path.basename(p) for p in paths) == [f"{k:08d}.json" for k in range(1, 7)]
    last = max(range(6), key=lambda i: paths[i])
    assert seen(spark, root, "a") == [(D, last)]


def test_new_columns_and_odd_names(spark):
    root = tempfile.mkdtemp(prefix="pub-")
    write(spark, root, D, a=[1])
    with Publication(spark, root, E) as run:
        run.write(spark.createDataFrame([(2, "y")], "x int, `odd name` string"), "a")
    got = sorted(tuple(r) for r in read_published(spark, root, "a").select("x", "odd name", "extract_date").collect())
    assert got == [(1, None, D), (2, "y", E)]


@pytest.mark.parametrize("name", ["loan_financial_owner", "active_installment"])
def test_files_are_sized_by_bytes(spark, name):
    """No file beyond the stated size and no swarm, though the scan is dealt over many small splits."""
    conf = {"spark.sql.files.maxPartitionBytes": "64k", "spark.sql.files.openCostInBytes": "1k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    snap, spec = portfolio_snapshot(spark, SF_SMALL), TB.PAYLOAD_TABLES[name]
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = TB.payload_table_observed(TB.visible(snap), TB.latest(snap), spec)
        splits = df.rdd.getNumPartitions()
        whole, small = tempfile.mkdtemp(prefix="sized-"), tempfile.mkdtemp(prefix="sized-")
        sink.write_sized(df, f"{whole}/t")
        limit = 40_000
        sink.write_sized(df, f"{small}/t", file_bytes=limit)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    n_rows = spark.read.parquet(f"{whole}/t").count()
    assert n_rows == spark.read.parquet(f"{small}/t").count() > 0
    assert len(glob.glob(f"{whole}/t/part-*")) <= 4 and (splits > 4 or name != "loan_financial_owner")
    sizes = [os.path.getsize(f) for f in glob.glob(f"{small}/t/part-*")]
    assert max(sizes) <= limit
    per_file = sink.rows_per_file(df.schema, limit)
    assert len(sizes) <= -(-n_rows // per_file) + 4
