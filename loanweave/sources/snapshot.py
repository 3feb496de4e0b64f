"""Snapshot files: read with the contract schema, staged once per input.

A portfolio snapshot is a parquet file.  For the driver's tables the
snapshot is derived by :mod:`loanweave.sources.fixture` and written once to
the shared checkpoint folder (``spark.checkpoint.dir``), keyed by a
fingerprint of its inputs and of the fixture code; later queries scan that
file like the dropped daily file it stands for.  It holds the outer columns
and what the payloads are made of; the texts of the payloads that a query
reads are written in its scan (``fixture.render``), as they are some forty
times the tables.  A staged file counts only once its ``_SUCCESS`` marker
exists, so a job lost half way is rebuilt.
"""

from __future__ import annotations

import hashlib
import inspect
import math
import threading
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanweave.session import app_scratch, drop_staged, prepare_session, scratch_path, shuffles_dropped, stage
from loanweave.sources import bucketed, contract, files, fixture

_INPUTS = ("orders", "customer", "events", "lineitem")
_STAGING_LOCK = threading.Lock()  # queries on driver threads never stage one path twice


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return bool(fs.exists(p))


def snapshot_ready(spark: SparkSession, path: str) -> bool:
    """A dropped snapshot can be read: a single file that exists, or a
    directory whose writer has committed (``_SUCCESS`` present)."""
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return False
    if fs.getFileStatus(p).isDirectory():
        return bool(fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))
    return True


def _fingerprint(spark: SparkSession, sf_dir: str, half: str | None) -> str:
    h = hashlib.sha256()
    h.update(inspect.getsource(fixture).encode())
    h.update(inspect.getsource(version_parts).encode())
    h.update(inspect.getsource(write_versions).encode())
    h.update(repr((sf_dir.rstrip("/"), half)).encode())
    for name in _INPUTS:
        fs, p = _fs_path(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")
        for st in fs.listStatus(p) if fs.getFileStatus(p).isDirectory() else [fs.getFileStatus(p)]:
            h.update(f"{st.getPath().getName()}:{st.getLen()}:{st.getModificationTime()}".encode())
    return h.hexdigest()[:20]


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """Scan a snapshot file with the contract schema (no inference)."""
    prepare_session(spark)
    return spark.read.schema(contract.SNAPSHOT_SCHEMA).parquet(path)


def write_snapshot(df: DataFrame, path: str) -> None:
    """Write a snapshot clustered by loan: range-partitioned on
    (loan_id, published_at) and sorted within files.  The versions of a loan
    then share a split, so the partial top-1 before the ranking shuffle
    drops nearly every older version map-side (at sf0.1: 15k of 100k visible
    rows reach the exchange instead of 68k); the secondary range key spreads
    a loan with very many versions over several partitions.  Parquet min/max
    statistics on ``loan_id`` also let readers skip files."""
    (df.repartitionByRange("loan_id", "published_at")
       .sortWithinPartitions("loan_id", "published_at", "id")
       .write.mode("overwrite").parquet(path))


#: Versions are written in parts of about so many bytes of input tables, and in so many at most:
#: a part's shuffle files go before the next part's are written.
PART_BYTES = 64 * 1024 * 1024
MOST_PARTS = 16
#: A file holds the versions of about so many bytes of input tables; there are a few per core at
#: least, as the texts are written in the scan and a small file is read by one task.
FILE_BYTES = 16 * 1024 * 1024
FILES_A_CORE = 3


def input_bytes(spark: SparkSession, sf_dir: str) -> int:
    return sum(sum(files.data_files(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")) for name in _INPUTS)


def parts_of(spark: SparkSession, sf_dir: str) -> int:
    return min(MOST_PARTS, max(1, math.ceil(input_bytes(spark, sf_dir) / PART_BYTES)))


def version_parts(spark: SparkSession, sf_dir: str, half: str | None) -> tuple[DataFrame, Iterator[DataFrame]]:
    """The versions of a half, and the same rows in parts by loan.  To be written while shuffle files are dropped.

    Lines meet their order in one part of the orders after the other, so shuffle files hold
    a part of the rows at a time.  The rows then stand in scratch files by part of the loans;
    those of a part go when the next one is drawn."""
    n, work = parts_of(spark, sf_dir), app_scratch(spark, f"versions_{uuid.uuid4().hex}")
    source = "after" if half == "drifted" else half
    days = stage(fixture.newest_days(spark, sf_dir, source), "newest_days")
    for i in range(n):
        rows = fixture.build_versions(spark, sf_dir, source, days, (i, n))
        rows = rows.withColumn("_part", fixture.part_of(F.col("loan_id"), n))
        rows.write.mode("append").option("compression", "zstd").partitionBy("_part").parquet(work)
    drop_staged(days)
    whole = spark.read.schema(rows.schema).parquet(work)

    def finished(part: DataFrame) -> DataFrame:
        part = fixture.outer_columns(part.drop("_part"))
        return fixture.redefine_outer(part) if half == "drifted" else part

    def parts() -> Iterator[DataFrame]:
        for i in range(n):
            yield finished(whole.where(F.col("_part") == i))
            files.delete(spark, f"{work}/_part={i}")
        files.delete(spark, work)

    return finished(whole), parts()


def write_versions(spark: SparkSession, sf_dir: str, half: str | None, path: str) -> None:
    """Write the versions of a half, clustered by loan like :func:`write_snapshot`, in one part
    of the loans after the other.  Any writer that died left no marker; what it left is removed first."""
    files.delete(spark, path)
    n = parts_of(spark, sf_dir)
    n_files = math.ceil(max(FILES_A_CORE * spark.sparkContext.defaultParallelism, input_bytes(spark, sf_dir) / FILE_BYTES) / n)
    with shuffles_dropped(spark):
        for i, part in enumerate(version_parts(spark, sf_dir, half)[1], 1):
            (part.repartitionByRange(n_files, "loan_id", "published_at").sortWithinPartitions("loan_id", "published_at", "id")
             .write.mode("append").option("compression", "zstd")
             .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", str(i == n).lower()).parquet(path))


def _portfolio_path(spark: SparkSession, sf_dir: str, half: str | None) -> str:
    return scratch_path(spark, "snapshots", f"portfolio_{_fingerprint(spark, sf_dir, half)}.parquet")


def portfolio_file(spark: SparkSession, sf_dir: str, half: str | None = None) -> str:
    """Path of the versions derived from ``sf_dir``, staged on first use.
    ``half`` = ``"drifted"`` is the ``"after"`` half under changed outer columns."""
    prepare_session(spark)
    path = _portfolio_path(spark, sf_dir, half)
    with _STAGING_LOCK:
        if not path_exists(spark, f"{path}/_SUCCESS"):
            write_versions(spark, sf_dir, half, path)
    return path


def render_versions(versions: DataFrame, sf_dir: str, half: str | None = None, keep: bool = False) -> DataFrame:
    """Versions staged from ``sf_dir`` as snapshot rows.  ``keep``: beside what they are written from."""
    return fixture.render(versions, half in ("after", "drifted"), keep)


def portfolio_versions(spark: SparkSession, sf_dir: str, half: str | None = None) -> DataFrame:
    """The staged versions: outer columns and what the payload texts are written from."""
    return spark.read.parquet(portfolio_file(spark, sf_dir, half))


def portfolio_rows(versions: DataFrame, sf_dir: str, half: str | None = None) -> DataFrame:
    """Staged versions, or some of them, under the contract schema."""
    return render_versions(versions, sf_dir, half).to(contract.SNAPSHOT_SCHEMA)


def portfolio_snapshot(spark: SparkSession, sf_dir: str, half: str | None = None) -> DataFrame:
    """The staged snapshot under the contract schema."""
    return portfolio_rows(portfolio_versions(spark, sf_dir, half), sf_dir, half)


def portfolio_footer(spark: SparkSession, sf_dir: str, half: str | None = None) -> DataFrame:
    """The staged snapshot under its own file schema, whatever the contract says."""
    return render_versions(portfolio_versions(spark, sf_dir, half), sf_dir, half)


def portfolio_layout(spark: SparkSession, sf_dir: str) -> str:
    """Path of the bucketed layout of the versions, written on first use: from the staged
    versions if they stand already, else from the tables, so that the rows are not staged twice."""
    prepare_session(spark)
    path = scratch_path(spark, "snapshots", f"layout_{_fingerprint(spark, sf_dir, None)}")
    with _STAGING_LOCK:
        if not bucketed.layout_ready(spark, path):
            files.delete(spark, path)  # what a writer that died left
            staged = _portfolio_path(spark, sf_dir, None)
            with shuffles_dropped(spark):
                if path_exists(spark, f"{staged}/_SUCCESS"):
                    bucketed.write_layout(spark.read.parquet(staged), path)
                else:
                    versions, parts = version_parts(spark, sf_dir, None)
                    bucketed.write_layout(versions, path, parts=parts)
    return path
