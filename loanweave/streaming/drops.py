"""Snapshot drops as a Structured Streaming source.

Instead of polling for the day's file, the drop folder is a file stream:
newly arrived snapshot files form a micro-batch, and ``foreachBatch`` rebuilds
the mart for every dated snapshot folder the batch touched, reading that
folder whole.  The stream's checkpoint records which files were consumed and the
sink overwrites only the batch's ``extract_date`` partitions, so a replay
after a lost executor or driver rewrites the same partitions.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loanweave.operators import sink
from loanweave.plans.daily import contract_violations
from loanweave.plans.mart import run_mart
from loanweave.session import scratch_path
from loanweave.sources import contract
from loanweave.sources.snapshot import _fs_path, path_exists, read_snapshot, snapshot_ready

# Fixed value: the date inside a dropped snapshot's folder name.
DATE_IN_PATH = r"_(\d{4})_(\d{2})_(\d{2})\.parquet"
SNAPSHOT_DIR = r"^(.*_\d{4}_\d{2}_\d{2}\.parquet)(?:/|$)"  # a folder or a single file


def drop_stream(spark: SparkSession, drop_root: str) -> DataFrame:
    """Rows of every snapshot file under ``drop_root`` tagged with the
    snapshot folder they belong to and its date."""
    path = F.input_file_name()
    day = F.to_date(F.concat_ws("-", F.regexp_extract(path, DATE_IN_PATH, 1),
                                F.regexp_extract(path, DATE_IN_PATH, 2),
                                F.regexp_extract(path, DATE_IN_PATH, 3)))
    return (spark.readStream.schema(contract.SNAPSHOT_SCHEMA)
            .parquet(f"{drop_root.rstrip('/')}/*.parquet")
            .withColumn("_snapshot_date", day)
            .withColumn("_snapshot_dir", F.regexp_extract(path, SNAPSHOT_DIR, 1)))


def _pending(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}/pending_snapshots"


def _versions(spark: SparkSession, checkpoint: str) -> list[int]:
    """Numbers of the committed pending lists, oldest first."""
    root = _pending(checkpoint)
    if not path_exists(spark, root):
        return []
    fs, p = _fs_path(spark, root)
    names = [st.getPath().getName() for st in fs.listStatus(p)]
    found = sorted(int(n.removeprefix("v=")) for n in names if n.startswith("v="))
    return [v for v in found if path_exists(spark, f"{root}/v={v}/_SUCCESS")]


def _read_pending(spark: SparkSession, checkpoint: str) -> set[tuple[str, dt.date]]:
    done = _versions(spark, checkpoint)
    if not done:
        return set()
    rows = spark.read.schema("folder string, day date").parquet(f"{_pending(checkpoint)}/v={done[-1]}")
    return {(r.folder, r.day) for r in rows.collect()}


def _write_pending(spark: SparkSession, checkpoint: str,
                   waiting: set[tuple[str, dt.date]]) -> None:
    """Write a new list beside the old ones, then delete those: whenever the
    driver dies, a committed list is there."""
    done = _versions(spark, checkpoint)
    number = done[-1] + 1 if done else 0
    spark.createDataFrame(sorted(waiting), "folder string, day date") \
        .coalesce(1).write.mode("overwrite").parquet(f"{_pending(checkpoint)}/v={number}")
    for v in done:
        fs, p = _fs_path(spark, f"{_pending(checkpoint)}/v={v}")
        fs.delete(p, True)


def _build(spark: SparkSession, folder: str, day: dt.date, out_root: str, observed: bool) -> None:
    """Rebuild one date; a snapshot that breaks the contract leaves the date's
    tables as they are and is recorded in ``drop_status`` instead."""
    as_of = dt.datetime.combine(day, dt.time())
    problems = contract_violations(spark.read.parquet(folder).schema)
    if not problems:
        run_mart(spark, read_snapshot(spark, folder), out_root, day, as_of, observed=observed)
    status = spark.createDataFrame([(folder, "contract_violation" if problems else "done", problems)],
                                   "snapshot string, status string, problems array<string>")
    sink.write_table(status, out_root, "drop_status", day, as_of)


def build_ready(spark: SparkSession, touched: set[tuple[str, dt.date]], out_root: str,
                checkpoint: str, observed: bool = False) -> set[tuple[str, dt.date]]:
    """Build every touched or pending snapshot whose writer has committed;
    returns (and remembers) those that still wait."""
    pending = _read_pending(spark, checkpoint)
    waiting = set()
    for folder, day in sorted(touched | pending):
        if snapshot_ready(spark, folder):
            _build(spark, folder, day, out_root, observed)
        else:
            waiting.add((folder, day))
    if waiting != pending:
        _write_pending(spark, checkpoint, waiting)
    return waiting


def watch_drops(spark: SparkSession, drop_root: str, out_root: str,
                checkpoint: str | None = None, observed: bool = False,
                available_now: bool = True) -> StreamingQuery:
    """Start the watcher; with ``available_now`` it processes what has
    arrived and stops (a scheduled run), otherwise it keeps watching.

    A batch only says which snapshots (dated folders or single files)
    received files.  Each committed one is then read whole and its date
    rebuilt, so a snapshot whose files arrive over several batches ends up
    complete, never as the last part.  A folder without its ``_SUCCESS``
    marker is still being written: it is remembered in a small pending list
    next to the stream's checkpoint.  The list is looked at when a watcher
    starts, so a marker that arrives without a data file needs no other drop,
    and again with every batch.  Producers should publish each snapshot
    atomically (write elsewhere, then rename into the drop folder).
    """
    checkpoint = checkpoint or scratch_path(spark, "streams", "snapshot_drops")
    build_ready(spark, set(), out_root, checkpoint, observed)

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        # One row per touched snapshot: a handful of names, never data.
        touched = {(r[0], r[1]) for r in
                   batch.select("_snapshot_dir", "_snapshot_date").distinct().collect()
                   if r[0] and r[1]}
        build_ready(spark, touched, out_root, checkpoint, observed)

    writer = drop_stream(spark, drop_root).writeStream.foreachBatch(per_batch) \
        .option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else \
        writer.trigger(processingTime="1 minute")
    return writer.start()
