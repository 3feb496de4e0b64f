"""Helpers shared by the training-data operators: table access, lineage cuts
in the shared folder, Arrow batches, fingerprints and connected components."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanweave.operators.joins import join_aggregate
from loanweave.session import drop_staged, stage


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Hand the package's source to the Python workers of this application once,
    so that they need no installed copy and no shared source folder."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="loanweave-src-")) / "loanweave_src.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(archive))
    _SHIPPED.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None],
                schema: str) -> DataFrame:
    """``mapInArrow`` with one output batch per input batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                out = fn(b)
                if out is not None and out.num_rows:
                    yield out
    return df.mapInArrow(run, schema)


def byte_slices(batch: pa.RecordBatch, column: int, most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Runs of rows of a batch whose texts hold at most ``most`` bytes together (a longer text alone)."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        used = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, used + most, side="right")))
        yield batch.slice(at, to - at)
        at = to


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextlib.contextmanager
def short_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of at most ``rows`` rows for the jobs run inside.  A batch of texts stands
    in the executor, outside its heap, and in its Python worker, once per running task."""
    before = spark.conf.get(BATCH_ROWS, None)
    own = int(before) if before else 0  # Spark takes 0 and less for no limit
    spark.conf.set(BATCH_ROWS, str(min(own, rows) if own > 0 else rows))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(BATCH_ROWS)
        else:
            spark.conf.set(BATCH_ROWS, before)


def return_memory() -> None:
    """Give what this process has freed back to the system, where its C library can."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
         ) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow``, with its memory returned at the end of a partition: Spark keeps
    the worker, which else holds it beside the stages that follow."""
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            return_memory()
    return wrapped


# ---- byte-level words and fingerprints -------------------------------------
# Words are runs of bytes other than space and \t \n \v \f \r.  Their 64-bit
# fingerprints come from prefix sums of table[byte] * BASE**i (mod 2**64), so
# a whole batch is hashed with a handful of array operations.

_BASE = 0x9E3779B97F4A7C15 | 1
_BLOCK = 1 << 22  # powers are kept for texts up to this many bytes; longer ones are extended
_rng = np.random.default_rng(20240607)
_BYTE_HASH = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_POW: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POW or len(_POW["up"]) < n + 1:
        size = max(n + 1, 1 << 20)
        inv = pow(_BASE, -1, 1 << 64)
        for key, b in (("up", _BASE), ("down", inv)):
            a = np.full(size, np.uint64(b), np.uint64)
            a[0] = 1
            _POW[key] = np.multiply.accumulate(a)
    return _POW["up"], _POW["down"]


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer of a well-known 64-bit mixer, element by element."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit fingerprints of the byte spans [start, end) of ``data``."""
    up, down = _powers(len(data))
    acc = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_HASH[data] * up[:len(data)], out=acc[1:])
    length = (ends - starts).astype(np.uint64)
    return mix64((acc[ends] - acc[starts]) * down[starts] + length * np.uint64(0xD6E8FEB86659FD93))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column, texts set apart by one newline, and
    each text's start (plus the end); a null is an empty text."""
    column = column.cast(pa.large_binary()).fill_null(b"") if column.null_count else column.cast(pa.large_binary())
    texts = column.to_pylist()
    starts = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=starts[1:])
    return np.frombuffer(b"\n".join(texts) + b"\n", np.uint8), starts


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of all words in ``data``."""
    gap = _IS_SPACE[data]
    edge = np.flatnonzero(np.diff(gap.view(np.int8), prepend=1, append=1))
    return edge[0::2], edge[1::2]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


# ---- connected components -----------------------------------------------------

def _as_is(df: DataFrame, label: str) -> DataFrame:
    return df  # staged already


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Smallest node reachable from every node that has a link.

    Alternating large-star / small-star contraction: each round is two
    aggregations (partial minimum before the shuffle, so a hub sends one row
    per task) and two joins on the node.  The aggregates are staged before the
    joins, so that AQE can split a hub's partition.
    Rounds are staged in the shared folder; only a count and two fingerprints
    of the edge set reach the driver, and equal ones end the rounds.  Returns (node, component_id) for nodes with a link; null ends
    and self-links are ignored.
    """
    e = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
         .where("u is not null and v is not null and u != v").distinct())
    e, last = stage(e, "cc"), None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = stage(both.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m")).select(
            "n", F.least("n", "m").alias("m")), "cc_low")
        large = stage(join_aggregate(both, low, F.col("u") == F.col("n"), staged=_as_is).where("v > u")
                      .select(F.col("v").alias("u"), F.col("m").alias("v")), "cc_large")
        low2 = stage(large.groupBy(F.col("u").alias("n")).agg(F.min("v").alias("m")), "cc_low2")
        small = join_aggregate(large, low2, F.col("u") == F.col("n"), staged=_as_is).select(F.col("v").alias("u"), F.col("m").alias("v"))
        nxt = stage(small.unionByName(low2.select(F.col("n").alias("u"), F.col("m").alias("v")))
                    .where("u != v").distinct(), "cc")
        mark = nxt.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first()
        for old in (e, low, large, low2):
            drop_staged(old)
        e = nxt
        if mark == last:
            break
        last = mark
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component_id")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component_id")).unionByName(roots)
