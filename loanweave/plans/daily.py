"""One dated run: arrival check, drift against yesterday, the whole mart.

This is the data work of the source system's daily schedule: the dated
snapshot must exist, its schema is compared with the previous day's, then
every table is built and written under ``extract_date=D``.  Scheduling and
retries belong to whatever orchestrator calls this function.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from loanweave.operators import drift, sink
from loanweave.operators.snapshot import rename_by_mapping
from loanweave.plans.mart import run_mart
from loanweave.sources import contract
from loanweave.sources.snapshot import read_snapshot, snapshot_ready

# Fixed value: dated snapshot file names, ``<prefix>YYYY_MM_DD.parquet``.
SNAPSHOT_PREFIX = "portfolio_"


def snapshot_file(drop_root: str, day: dt.date, prefix: str = SNAPSHOT_PREFIX) -> str:
    return f"{drop_root.rstrip('/')}/{prefix}{day:%Y_%m_%d}.parquet"


def contract_violations(file_schema: T.StructType) -> list[str]:
    """Contract columns the file lacks or stores with another type (the
    contract scan would otherwise read them as NULL or fail mid-job)."""
    have = {f.name: f.dataType for f in file_schema.fields}
    out = []
    for f in contract.SNAPSHOT_SCHEMA.fields:
        if f.name not in have:
            out.append(f"missing {f.name}")
        elif have[f.name] != f.dataType:
            out.append(f"{f.name}: {have[f.name].simpleString()} != {f.dataType.simpleString()}")
    return out


def run_daily(spark: SparkSession, drop_root: str, out_root: str, day: dt.date,
              as_of: dt.datetime | None = None, observed: bool = False,
              stop_on_drift: bool = False, payload_drift: bool = False,
              rename: tuple[str, str] | None = None) -> dict:
    """Returns ``{"status": "waiting"}`` when the day's file has not arrived
    (or, for a directory, its writer has not committed yet),
    ``"contract_violation"`` when it does not carry the contract columns,
    ``"schema_changed"`` when ``stop_on_drift`` and its outer schema differs
    from yesterday's; otherwise writes every table and returns their paths.

    ``drift`` is ``"same"``, ``"changed"`` or, without yesterday's file,
    ``"not_checked"``.  Only footers are compared before that decision; the
    outer comparison is written as table ``schema_drift``, and with
    ``payload_drift`` its counts and the payload paths, which scan both snapshots, join it.
    ``rename``: old and new column names (see ``rename_by_mapping``), applied
    to today's file before the contract check.
    """
    today = snapshot_file(drop_root, day)
    if not snapshot_ready(spark, today):  # absent, or still being written
        return {"status": "waiting", "expected": today, "drift": "not_checked"}
    footer = spark.read.parquet(today)
    renamed = rename_by_mapping(footer, *rename) if rename else footer
    problems = contract_violations(renamed.schema)
    if problems:
        return {"status": "contract_violation", "snapshot": today, "problems": problems, "drift": "not_checked"}
    result: dict = {"status": "done", "snapshot": today, "drift": "not_checked"}
    yesterday = snapshot_file(drop_root, day - dt.timedelta(days=1))
    if snapshot_ready(spark, yesterday):
        previous = spark.read.parquet(yesterday)
        result["drift"] = "same" if previous.schema == footer.schema else "changed"
        if payload_drift:
            report = drift.schema_drift(spark, previous, footer, contract.PAYLOAD_COLUMNS)
        else:
            report = drift.outer_schema_drift(spark, previous, footer, counted=False)
        stop = stop_on_drift and result["drift"] == "changed"
        result["schema_drift"] = sink.write_table(report, out_root, "schema_drift", day, as_of)
        if stop:
            result["status"] = "schema_changed"
            return result
    snap = renamed.select(*contract.SNAPSHOT_SCHEMA.fieldNames()) if rename else read_snapshot(spark, today)
    result["tables"] = run_mart(spark, snap, out_root, day, as_of, observed=observed)
    return result
