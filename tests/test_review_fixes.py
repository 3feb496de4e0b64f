"""Regressions: empty reruns, naive as_of, whitespace-led objects, snapshots
arriving over several batches, half-written drops."""

import datetime as dt
import glob
import os
import shutil
import tempfile
import time

from loanweave.operators import sink
from loanweave.operators.drift import payload_key_counts
from loanweave.operators.publish import read_published
from loanweave.plans.daily import run_daily, snapshot_file
from loanweave.plans.mart import run_mart
from loanweave.sources.fixture import build_snapshot
from loanweave.sources.snapshot import read_snapshot, write_snapshot  # noqa: F401
from loanweave.streaming.drops import watch_drops

from conftest import SF_SMALL

D = dt.date(2024, 1, 1)


def test_empty_rerun_clears_the_date(spark):
    root = tempfile.mkdtemp(prefix="sink-")
    df = spark.createDataFrame([(1,)], "x int")
    out = sink.write_table(df, root, "t", D)
    sink.write_table(df, root, "t", D + dt.timedelta(days=1))
    sink.write_table(df.limit(0), root, "t", D)
    got = spark.read.parquet(out).collect()
    assert [r.extract_date for r in got] == [D + dt.timedelta(days=1)]


def test_naive_as_of_is_wall_clock_whatever_the_process_zone(spark):
    old = os.environ.get("TZ")
    os.environ["TZ"] = "America/Chicago"
    time.tzset()
    try:
        df = sink.stamp(spark.range(1), dt.datetime(2024, 1, 1))
        assert df.first().extract_timestamp == dt.datetime(2024, 1, 1)
        aware = dt.datetime(2024, 1, 1, 6, tzinfo=dt.timezone(dt.timedelta(hours=6)))
        assert sink.stamp(spark.range(1), aware).first().extract_timestamp == dt.datetime(2024, 1, 1)
    finally:
        if old is None:
            os.environ.pop("TZ")
        else:
            os.environ["TZ"] = old
        time.tzset()


def test_whitespace_led_object_is_one_element(spark):
    from test_edge_cases import snap
    df = snap(spark, {"id": "1", "installments": '\n\t {"a":{"b":1}}'})
    got = {r.key: r.n for r in payload_key_counts(df, ["installments"]).collect()}
    assert got == {"a": 1}


def test_half_written_drop_is_waiting(spark):
    root, out = tempfile.mkdtemp(prefix="drops-"), tempfile.mkdtemp(prefix="mart-")
    path = snapshot_file(root, D)
    write_snapshot(build_snapshot(spark, SF_SMALL, "before"), path)
    os.remove(os.path.join(path, "_SUCCESS"))
    assert run_daily(spark, root, out, D)["status"] == "waiting"


def test_snapshot_arriving_over_two_batches_is_built_whole(spark):
    root, out = tempfile.mkdtemp(prefix="drops-"), tempfile.mkdtemp(prefix="mart-")
    ckpt = tempfile.mkdtemp(prefix="stream-")
    full = build_snapshot(spark, SF_SMALL, "before")
    staged = tempfile.mkdtemp(prefix="parts-")
    full.repartition(2, "loan_id").write.parquet(staged + "/s")  # two part files
    parts = sorted(glob.glob(staged + "/s/part-*.parquet"))
    assert len(parts) >= 2
    folder = snapshot_file(root, D)
    os.makedirs(folder)
    shutil.copy(parts[0], folder)                      # first part arrives, not committed
    watch_drops(spark, root, out, checkpoint=ckpt).awaitTermination(600)
    assert not os.path.exists(os.path.join(out, "active_installment"))  # nothing built yet
    for p in parts[1:]:                                # the rest arrives, then the commit
        shutil.copy(p, folder)
    open(os.path.join(folder, "_SUCCESS"), "w").close()
    watch_drops(spark, root, out, checkpoint=ckpt).awaitTermination(600)
    expect_root = tempfile.mkdtemp(prefix="mart-")
    run_mart(spark, read_snapshot(spark, folder), expect_root, D, dt.datetime(2024, 1, 1))
    for table in ("active_installment", "loan_payment_plan", "bankruptcy"):
        a = read_published(spark, out, table).drop("extract_timestamp")
        b = read_published(spark, expect_root, table).drop("extract_timestamp")
        assert a.count() == b.count() > 0
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_single_file_drop_is_built(spark):
    root, out = tempfile.mkdtemp(prefix="drops-"), tempfile.mkdtemp(prefix="mart-")
    staged = tempfile.mkdtemp(prefix="parts-")
    build_snapshot(spark, SF_SMALL, "before").coalesce(1).write.parquet(staged + "/s")
    part = glob.glob(staged + "/s/part-*.parquet")[0]
    os.makedirs(root, exist_ok=True)
    shutil.copy(part, snapshot_file(root, D))          # the snapshot is one parquet file
    watch_drops(spark, root, out, checkpoint=tempfile.mkdtemp(prefix="stream-")).awaitTermination(600)
    got = read_published(spark, out, "active_installment")
    assert {r.extract_date for r in got.select("extract_date").distinct().collect()} == {D}
    assert run_daily(spark, root, tempfile.mkdtemp(prefix="mart-"), D)["status"] == "done"
