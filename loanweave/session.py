"""SparkSession construction and the few session settings the mart relies on."""

from __future__ import annotations

import atexit
import contextlib
import math
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Timestamps are hashed as text and payload times are parsed without a zone;
# pinning the session zone keeps both reproducible across clusters.
SESSION_TIME_ZONE = "UTC"


def build_session(master: str | None = None, app_name: str = "loanweave",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with AQE and skew handling on and the UI off."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": SESSION_TIME_ZONE,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Wide rows carry JSON payloads: keep input splits moderate and the
        # vectorised reader's batches short so a task holds fewer wide texts.
        "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
        "spark.sql.parquet.columnarReaderBatchSize": "1024",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare_session(spark)
    return spark


def prepare_session(spark: SparkSession) -> SparkSession:
    """Apply the settings every query depends on to an existing session."""
    if spark.conf.get("spark.sql.session.timeZone") != SESSION_TIME_ZONE:
        spark.conf.set("spark.sql.session.timeZone", SESSION_TIME_ZONE)
    return spark


_LOCAL_CHECKPOINT_DIR: str | None = None


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and staging tables.

    ``spark.checkpoint.dir`` names shared storage and is used as is.  Only a
    local master may leave it unset (tests, one machine) and gets a scratch
    folder; on a cluster executors could not see such a folder, so that is an
    error.
    """
    global _LOCAL_CHECKPOINT_DIR
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"spark.checkpoint.dir is not set and the master is {master}: "
                               "name a folder that all executors share")
        if _LOCAL_CHECKPOINT_DIR is None:
            _LOCAL_CHECKPOINT_DIR = tempfile.mkdtemp(prefix="loanweave-ckpt-")
        d = _LOCAL_CHECKPOINT_DIR
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(d)
    return d


def app_scratch(spark: SparkSession, *parts: str) -> str:
    """A path under the shared folder that belongs to this application; all of
    it is deleted when the driver process ends."""
    root = scratch_path(spark, "staging", spark.sparkContext.applicationId)
    if root not in _AT_EXIT:
        _AT_EXIT.add(root)
        atexit.register(_remove, spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), root)
    return os.path.join(root, *parts)


_AT_EXIT: set[str] = set()


def _remove(jvm, conf, path: str) -> None:
    with contextlib.suppress(Exception):  # the JVM may be gone before the driver process
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` under the shared folder and read it back: a lineage cut
    that survives lost executors, and a scan whose joins AQE can split.
    The shuffle files behind it go as soon as it is written."""
    path = app_scratch(df.sparkSession, f"{label}_{uuid.uuid4().hex}")
    with shuffles_dropped(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_staged(df: DataFrame) -> None:
    """Delete the files behind a frame made by :func:`stage`, before the application ends."""
    sc = df.sparkSession.sparkContext
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        _remove(sc._jvm, sc._jsc.hadoopConfiguration(), folder)


# Shuffle sizing: in-memory rows of JSON-heavy snapshots are several times
# their compressed parquet size; aim for ~128 MB shuffle partitions.
SHUFFLE_TARGET_BYTES = 128 * 1024 * 1024
IN_MEMORY_EXPANSION = 4.0
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def shuffle_partitions_for(spark: SparkSession, carried_bytes: int) -> int:
    """Shuffle partitions that keep each near SHUFFLE_TARGET_BYTES when a
    shuffle carries ``carried_bytes``; never fewer than the session's own."""
    current = int(spark.conf.get(INITIAL_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = math.ceil(carried_bytes * IN_MEMORY_EXPANSION / SHUFFLE_TARGET_BYTES)
    return max(wanted, current, spark.sparkContext.defaultParallelism)


@contextlib.contextmanager
def sized_shuffles(spark: SparkSession, carried_bytes: int) -> Iterator[int]:
    """AQE's initial shuffle partition count for the jobs run inside, put back
    afterwards (AQE coalesces small partitions but never splits large ones)."""
    before = spark.conf.get(INITIAL_PARTITIONS, None)
    n = shuffle_partitions_for(spark, carried_bytes)
    spark.conf.set(INITIAL_PARTITIONS, str(n))
    try:
        yield n
    finally:
        if before is None:
            spark.conf.unset(INITIAL_PARTITIONS)
        else:
            spark.conf.set(INITIAL_PARTITIONS, before)


CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of each job run inside go when it ends, not when the driver's
    garbage collector finds them; for jobs that write what they make."""
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEAN_UP)
        else:
            spark.conf.set(CLEAN_UP, before)


def plan_size_bytes(df) -> int:
    """Catalyst's size estimate of a frame (file sizes for a scan; metadata only)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def scratch_path(spark: SparkSession, *parts: str) -> str:
    return os.path.join(checkpoint_dir(spark), *parts)
