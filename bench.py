"""Benchmark: every registered query plus the whole mart.

Runs on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) and prints one JSON line.  Each query is executed in
full with the ``noop`` sink (no collect to the driver), twice: ``queries``
holds the faster run (``value`` is their sum), ``queries_cold`` the first.
The snapshot is derived and staged once before timing (``snapshot_stage``).
"""

from __future__ import annotations

import datetime as dt
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from loanweave.plans.catalog import QUERIES  # noqa: E402
from loanweave.plans.mart import run_mart  # noqa: E402
from loanweave.session import build_session, scratch_path  # noqa: E402
from loanweave.sources.snapshot import portfolio_snapshot  # noqa: E402


def cpu_model() -> str:
    try:
        with open("/proc/cpuinfo") as f:
            return next((x.split(":", 1)[1].strip() for x in f if x.startswith("model name")), "unknown")
    except OSError:
        return "unknown"


def main() -> None:
    load = round(os.getloadavg()[0], 2)
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    # One machine: any local folder is shared by its executor threads.
    scratch = tempfile.mkdtemp(prefix="loanweave-bench-")
    spark = build_session(
        f"local[{cpus}]", app_name="loanweave-bench", shuffle_partitions=2 * cpus,
        extra={"spark.checkpoint.dir": scratch, "spark.driver.memory": "16g",
               "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(32 * 1024 * 1024)})

    t = time.perf_counter()
    for half in (None, "before", "after", "drifted"):
        portfolio_snapshot(spark, sf_dir, half)
    stage = time.perf_counter() - t

    # One untimed pass of a table query so JIT and codegen warm-up are not
    # charged to whichever query happens to run first.
    QUERIES["active_installment"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    cold: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        runs = []
        try:
            for _ in range(2):  # first run pays JIT / codegen warm-up; report both
                t = time.perf_counter()
                fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
                runs.append(time.perf_counter() - t)
        except Exception as e:  # noqa: BLE001 - record and go on; one line is still printed
            errors[name] = str(e).splitlines()[0][:300]
            continue
        cold[name] = round(runs[0], 3)
        times[name] = round(min(runs), 3)

    mart = {}
    if not only:
        snap = portfolio_snapshot(spark, sf_dir)
        for label, ranking in (("mart_shared_latest", "shared"), ("mart_latest_per_table", "table"), ("mart_latest_ids", "late")):
            out = scratch_path(spark, "bench_out", label)
            t = time.perf_counter()
            try:
                run_mart(spark, snap, out, dt.date(2024, 1, 2), dt.datetime(2024, 1, 2),
                         observed=True, ranking=ranking)
            except Exception as e:  # noqa: BLE001
                errors[label] = str(e).splitlines()[0][:300]
                continue
            mart[label] = round(time.perf_counter() - t, 3)

    total = round(sum(times.values()), 3)
    print(json.dumps({
        "metric": "sum_of_query_seconds", "value": total, "unit": "sec",
        "queries": {**times, **mart}, "queries_cold": cold,
        "cold_total": round(sum(cold.values()), 3), "snapshot_stage": round(stage, 3),
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""), "cpus": cpus,
        "n_queries": len(times), "errors": errors, "cpu_model": cpu_model(), "load_1m": load}))
    spark.stop()


if __name__ == "__main__":
    main()
