"""Dated runs and the drop watcher over fixture snapshots."""

import datetime as dt
import os
import tempfile

from loanweave.operators.publish import read_published
from loanweave.plans.daily import run_daily, snapshot_file
from loanweave.sources.fixture import build_snapshot
from loanweave.sources.snapshot import write_snapshot
from loanweave.streaming.drops import watch_drops

from conftest import SF_SMALL

D1, D2 = dt.date(2024, 3, 1), dt.date(2024, 3, 2)


def _drops(spark):
    root = tempfile.mkdtemp(prefix="drops-")
    write_snapshot(build_snapshot(spark, SF_SMALL, "before"), snapshot_file(root, D1))
    write_snapshot(build_snapshot(spark, SF_SMALL, "after"), snapshot_file(root, D2))
    return root


def test_run_daily(spark):
    drops, out = _drops(spark), tempfile.mkdtemp(prefix="mart-")
    assert run_daily(spark, drops, out, dt.date(2024, 3, 5))["status"] == "waiting"
    first = run_daily(spark, drops, out, D1)
    assert first["status"] == "done" and "schema_drift" not in first and first["drift"] == "not_checked"
    second = run_daily(spark, drops, out, D2, payload_drift=True)
    assert second["drift"] == "same"
    drift = spark.read.parquet(second["schema_drift"]).collect()
    assert {(r.column, r.path): r.status for r in drift if r.kind == "path"}["installments", "$[].currency"] == "added"
    ai = read_published(spark, out, "active_installment")
    assert {r.extract_date for r in ai.select("extract_date").distinct().collect()} == {D1, D2}
    assert len(first["tables"]) == 11


def test_watch_drops_processes_each_dated_file(spark):
    drops, out = _drops(spark), tempfile.mkdtemp(prefix="mart-")
    q = watch_drops(spark, drops, out, checkpoint=tempfile.mkdtemp(prefix="stream-"))
    q.awaitTermination(600)
    assert q.exception() is None
    got = read_published(spark, out, "loan_payment_plan")
    days = {r.extract_date for r in got.select("extract_date").distinct().collect()}
    assert days == {D1, D2}
    # each date's tables equal a batch run over that file alone
    daily_out = tempfile.mkdtemp(prefix="mart-")
    run_daily(spark, drops, daily_out, D1)
    a = got.filter(got.extract_date == D1).drop("extract_timestamp").collect()
    b = read_published(spark, daily_out, "loan_payment_plan") \
        .drop("extract_timestamp").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_run_daily_contract_and_drift_gates(spark):
    from pyspark.sql import functions as F
    root, out = tempfile.mkdtemp(prefix="drops-"), tempfile.mkdtemp(prefix="mart-")
    snap = build_snapshot(spark, SF_SMALL, "before")
    write_snapshot(snap, snapshot_file(root, D1))
    # a day whose file lost a column and gained one
    bad = snap.drop("payment_plans").withColumn("extra", F.lit(1))
    bad.write.parquet(snapshot_file(root, D2))
    r = run_daily(spark, root, out, D2)
    assert r["status"] == "contract_violation" and r["problems"] == ["missing payment_plans"]
    # a compatible file whose outer schema differs from yesterday's (the
    # broken D2 file): the drift report names the column D2 lacked
    D3 = D2 + dt.timedelta(days=1)
    snap.withColumn("extra", F.lit(1)).write.parquet(snapshot_file(root, D3))
    r3 = run_daily(spark, root, out, D3, stop_on_drift=True, payload_drift=True)
    assert r3["status"] == "schema_changed" and "tables" not in r3 and r3["drift"] == "changed"
    rep = {(r.kind, r.column): r.status for r in spark.read.parquet(r3["schema_drift"]).collect()}
    assert rep[("column", "payment_plans")] == "added"
    assert rep[("path", "payment_plans")] == "added"
    assert rep[("column", "extra")] == "position_changed"  # payment_plans came back before it


def test_run_daily_renames_before_the_contract_check(spark):
    root, out = tempfile.mkdtemp(prefix="drops-"), tempfile.mkdtemp(prefix="mart-")
    snap = build_snapshot(spark, SF_SMALL, "before")
    snap.withColumnRenamed("dark", "is_hidden").write.parquet(snapshot_file(root, D1))
    assert run_daily(spark, root, out, D1)["status"] == "contract_violation"
    r = run_daily(spark, root, out, D1, rename=("is_hidden", "dark"))
    assert r["status"] == "done" and spark.read.parquet(r["tables"]["active_installment"]).count() > 0


def test_watcher_leaves_a_date_alone_when_a_file_breaks_the_contract(spark):
    root, out = tempfile.mkdtemp(prefix="drops-"), tempfile.mkdtemp(prefix="mart-")
    snap = build_snapshot(spark, SF_SMALL, "before")
    write_snapshot(snap, snapshot_file(root, D1))
    ckpt = tempfile.mkdtemp(prefix="stream-")
    watch_drops(spark, root, out, checkpoint=ckpt).awaitTermination(600)
    n = read_published(spark, out, "active_installment").count()
    again = tempfile.mkdtemp(prefix="drops-")
    snap.drop("dark").write.parquet(snapshot_file(again, D1))
    watch_drops(spark, again, out, checkpoint=tempfile.mkdtemp(prefix="stream-")).awaitTermination(600)
    assert read_published(spark, out, "active_installment").count() == n > 0
    status = spark.read.parquet(os.path.join(out, "drop_status")).collect()
    assert [(r.status, list(r.problems)) for r in status] == [("contract_violation", ["missing dark"])]


def test_pending_list_survives_a_crash_and_a_late_marker_needs_no_drop(spark):
    from loanweave.streaming import drops as S
    root, out = tempfile.mkdtemp(prefix="drops-"), tempfile.mkdtemp(prefix="mart-")
    ckpt = tempfile.mkdtemp(prefix="stream-")
    folder = snapshot_file(root, D1)
    write_snapshot(build_snapshot(spark, SF_SMALL, "before"), folder)
    os.remove(os.path.join(folder, "_SUCCESS"))
    watch_drops(spark, root, out, checkpoint=ckpt).awaitTermination(600)
    waiting = S._read_pending(spark, ckpt)
    assert [d for _, d in waiting] == [D1]
    # A newer list whose write died half way is not trusted; the old one is still there.
    os.makedirs(os.path.join(ckpt, "pending_snapshots", "v=99"))
    assert S._read_pending(spark, ckpt) == waiting
    open(os.path.join(folder, "_SUCCESS"), "w").close()  # the marker comes late, without a data file
    watch_drops(spark, root, out, checkpoint=ckpt).awaitTermination(600)
    assert read_published(spark, out, "active_installment").count() > 0
    assert S._read_pending(spark, ckpt) == set()
