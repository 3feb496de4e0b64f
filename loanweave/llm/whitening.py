"""Embedding whitening from a bit-sliced scatter matrix.

Entries become integers x = floor(1024 c) + 100000.  Less its dimension's
smallest x, a block of rows is stored as bit planes: bit b of dimension i, across
the rows, packed into 64-bit words.  The cross-product of two dimensions is then
the sum of 2^(a+b) popcount(plane(i, a) AND plane(j, b)) over their planes.  A
plane of ones stands for a constant dimension, so that the same counts give the
number of rows and the sums.  Sums of blocks add up as integers, the scatter is
centred as an integer, n * sum(xy) - sum(x) * sum(y), and only then do doubles
and an eigendecomposition follow.

Scale: three passes over the vectors (ranges, scatter, moments of the result)
and one that yields rows.  Each task sends one row per pair of dimensions and
limb, whatever its rows; the driver gets those sums, bounded by the square of
the dimension.  Blocks are sized from the dimension.  Nothing is keyed by a
value of the data, so no group can be hot.

Defined results: vectors that are null, empty, or hold a null, non-finite or
(beyond 62 bits) too large an entry are dropped, and so are vectors of another
length than the commonest one (of equally common lengths the longest).
Repeated rows count each.  A component without spread (an eigenvalue under
1e-12 of the trace) has a null result, and identity_error leaves it out.  An
empty table gives no rows.  Other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanweave.llm.common import drop_staged, ship_package, stage

SCALE, SHIFT = 1024, 100000
COMPONENTS = 8
#: Entries of a block of rows: about 4 MB of bit planes a plane width of 16.
BLOCK_ENTRIES = 1 << 18
MOST_BITS = 62
LIMB = 32
#: Rows after which a task sends its limbs on; they stay far below 2^63.
FLUSH_ROWS = 1 << 19
NO_SPREAD = 1e-12


@dataclass(frozen=True)
class Whitening:
    """Fitted on ``n`` vectors: exact ``sums`` and ``lows`` of x per dimension, unit
    ``components`` (columns) by falling ``eigenvalues``, ``trace`` of the covariance."""
    n: int
    lows: list[int]
    highs: list[int]
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float


def quantised(column: pa.Array, length: int | None = None) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """Rows of a list column that hold only usable entries, and their x by vector
    length: positions in the batch and [(length, x matrix)] (one pair if asked for one length)."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten()
    c = pc.fill_null(values.cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore", invalid="ignore"):
        x = np.floor(c * SCALE)
        bad = ~(np.abs(x) < 2.0 ** (MOST_BITS - 1))
    ends = np.cumsum(lengths)
    wrong = np.concatenate(([0], np.cumsum(bad)))
    good = (lengths > 0) & (wrong[ends] == wrong[ends - lengths])
    at = np.flatnonzero(good if length is None else good & (lengths == length))
    out = []
    for k in np.unique(lengths[at]):
        rows = at[lengths[at] == k]
        out.append((int(k), x[(ends[rows] - k)[:, None] + np.arange(k)].astype(np.int64) + SHIFT))
    return at, out


def _ranges(vectors: DataFrame) -> tuple[int, list[int], list[int]]:
    """Commonest vector length and, per dimension, the least and largest x."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, list] = {}
        for b in batches:
            for k, x in quantised(b.column(0))[1]:
                n, lo, hi = seen.get(k, (0, x[0], x[0]))
                seen[k] = [n + len(x), np.minimum(lo, x.min(0)), np.maximum(hi, x.max(0))]
        for k, (n, lo, hi) in seen.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(k, v, np.int64)) if np.isscalar(v) else pa.array(v)
                                              for v in (k, np.arange(k), n, lo, hi)], ["len", "i", "n", "lo", "hi"])

    parts = vectors.mapInArrow(run, "len bigint, i bigint, n bigint, lo bigint, hi bigint")
    found = stage(parts.groupBy("len", "i").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")),
                  "whiten_ranges")
    top = found.groupBy("len").agg(F.max("n").alias("n")).orderBy(F.desc("n"), F.desc("len")).limit(1).collect()
    rows = found.where(F.col("len") == top[0]["len"]).orderBy("i").collect() if top else []
    drop_staged(found)
    return len(rows), [r["lo"] for r in rows], [r["hi"] for r in rows]


def bit_planes(y: np.ndarray, widths: list[int]) -> np.ndarray:
    """(planes, words): the bits of each column of ``y`` (rows x dimensions, not
    negative), ``widths[i]`` planes for column i, rows packed into 64-bit words."""
    pad = -len(y) % 64
    if pad:
        y = np.concatenate((y, np.zeros((pad, y.shape[1]), y.dtype)))
    turned = np.ascontiguousarray(y.T)
    wide = np.array(widths)
    out = np.empty((int(wide.sum()), len(y) // 64), np.uint64)
    first = np.concatenate(([0], np.cumsum(wide)[:-1]))
    for b in range(int(wide.max())):
        has = np.flatnonzero(wide > b)
        out[first[has] + b] = np.packbits((turned[has] >> b) & 1, axis=1).view(np.uint64)
    return out


class Scatter:
    """Exact sums of products of all pairs of columns, from AND-popcounts of
    their bit planes, kept as limbs of 32 bits: total = sum of 2^(32 l) limbs[l]."""

    def __init__(self, widths: list[int]):
        self.widths = widths
        self.first = np.concatenate(([0], np.cumsum(widths)[:-1])).astype(np.int64)
        self.bit = np.concatenate([np.arange(w) for w in widths])
        self.n_limbs = 2 * (max(widths) - 1) // LIMB + 1
        self.limbs = np.zeros((self.n_limbs, len(widths), len(widths)), np.int64)
        self.rows = 0

    def add(self, y: np.ndarray) -> None:
        planes = bit_planes(y, self.widths)
        for i, w in enumerate(self.widths):
            at = self.first[i]
            count = np.bitwise_count(planes[at:at + w, None, :] & planes[None, at:, :]).sum(axis=2, dtype=np.int64)
            power = np.arange(w)[:, None] + self.bit[None, at:]
            for limb in range(self.n_limbs):
                mine = np.where(power // LIMB == limb, count << (power % LIMB), 0) if self.n_limbs > 1 else count << power
                self.limbs[limb, i, i:] += np.add.reduceat(mine.sum(axis=0), self.first[i:] - at)
        self.rows += len(y)

    def take(self) -> pa.RecordBatch:
        """The sums so far as rows (i, j >= i, limb, v); the sums start anew."""
        i, j = np.triu_indices(len(self.widths))
        parts = [(i, j, np.full(len(i), k), self.limbs[k, i, j]) for k in range(self.n_limbs)]
        out = pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*parts)], ["i", "j", "limb", "v"])
        self.limbs[:] = 0
        self.rows = 0
        return out


def _blocks(x: np.ndarray, dims: int) -> Iterator[np.ndarray]:
    step = max(64, BLOCK_ENTRIES // dims // 64 * 64)
    for at in range(0, len(x), step):
        yield x[at:at + step]


def scatter(vectors: DataFrame, lows: list[int], highs: list[int]) -> dict[tuple[int, int], int]:
    """Exact sums of products of 1 (index 0) and x - low (indexes from 1) over all usable vectors."""
    dims, low = len(lows), np.array(lows, np.int64)
    widths = [1] + [max(1, (h - l).bit_length()) for l, h in zip(lows, highs)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Scatter(widths)
        for b in batches:
            for _, x in quantised(b.column(0), dims)[1]:
                for part in _blocks(x, dims):
                    sums.add(np.concatenate((np.ones((len(part), 1), np.int64), part - low), axis=1))
            if sums.rows >= FLUSH_ROWS:
                yield sums.take()
        if sums.rows:
            yield sums.take()

    parts = vectors.mapInArrow(run, "i bigint, j bigint, limb bigint, v bigint")
    out: dict[tuple[int, int], int] = {}
    for r in parts.groupBy("i", "j", "limb").agg(F.sum(F.col("v").cast("decimal(20,0)")).alias("v")).collect():
        at = (r["i"], r["j"])
        out[at] = out.get(at, 0) + (int(r["v"]) << (LIMB * r["limb"]))
    return out


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fit on every usable row of ``vectors`` (its one column holds the vectors); None without rows."""
    ship_package(vectors.sparkSession)
    dims, lows, highs = _ranges(vectors)
    if not dims:
        return None
    prod = scatter(vectors, lows, highs)
    n, sums = prod[0, 0], [prod[0, i + 1] for i in range(dims)]
    cov = np.empty((dims, dims))
    spread = 0
    for i in range(dims):
        for j in range(i, dims):
            centred = n * prod[i + 1, j + 1] - sums[i] * sums[j]  # n^2 times the covariance, an integer
            cov[i, j] = cov[j, i] = centred / (n * n)
            spread += centred if i == j else 0
    values, axes = np.linalg.eigh(cov)
    order = np.argsort(-values, kind="stable")[:components]
    trace = spread / (n * n)
    kept = np.where(values[order] > NO_SPREAD * trace, values[order], 0.0)
    return Whitening(n, lows, highs, [s + n * l for s, l in zip(sums, lows)], axes[:, order], kept, trace)


def _project(model: Whitening, x: np.ndarray) -> np.ndarray:
    """Whitened coordinates (NaN for components without spread)."""
    whole = np.array([s // model.n for s in model.sums], np.int64)
    rest = np.array([(s % model.n) / model.n for s in model.sums])
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(model.eigenvalues > 0, ((x - whole) - rest) @ model.components / np.sqrt(model.eigenvalues), np.nan)


def _deviation(model: Whitening, x: np.ndarray) -> pa.Array:
    """Exact sum over dimensions of (n x - S)^2; Python's integers where 64 bits are too few."""
    n = model.n
    reach = max(max(abs(n * l - s), abs(n * h - s)) for l, h, s in zip(model.lows, model.highs, model.sums))
    if len(model.sums) * reach * reach < 1 << 62 and max(map(abs, model.sums)) < 1 << 62:
        d = n * x - np.array(model.sums, np.int64)
        return pa.array((d * d).sum(axis=1)).cast(pa.decimal128(38, 0))
    d = n * x.astype(object) - np.array(model.sums, object)
    return pa.array([str(v) for v in (d * d).sum(axis=1)], pa.string()).cast(pa.decimal128(38, 0))


def whiten(vectors: DataFrame, model: Whitening, key: str = "vec_id", value: str = "embedding") -> DataFrame:
    """(key, whitened array<double>, deviation decimal(38,0)) of every usable row."""
    ship_package(vectors.sparkSession)
    frame = vectors.select(key, value)
    k = len(model.eigenvalues)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, found = quantised(b.column(1), len(model.sums))
            for _, x in found:
                w = pa.array(_project(model, x).ravel(), from_pandas=True)  # NaN becomes null
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(at)), pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * k), w),
                     _deviation(model, x)], [key, "whitened", "deviation"])

    kind = frame.schema[key].dataType.simpleString()
    return frame.mapInArrow(run, f"{key} {kind}, whitened array<double>, deviation decimal(38,0)")


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened vectors minus the identity."""
    ship_package(vectors.sparkSession)
    live = np.flatnonzero(model.eigenvalues > 0)
    k = len(live)
    if not k:
        return 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, scat = 0, np.zeros(k), np.zeros((k, k))
        for b in batches:
            for _, x in quantised(b.column(0), len(model.sums))[1]:
                w = _project(model, x)[:, live]
                m, gap = w.mean(axis=0), w.mean(axis=0) - mean
                scat += (w - m).T @ (w - m) + np.outer(gap, gap) * (n * len(w) / (n + len(w)))
                mean = mean + gap * (len(w) / (n + len(w)))
                n += len(w)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([mean.tolist()]), pa.array([scat.ravel().tolist()])], ["n", "m", "s"])

    parts = stage(vectors.mapInArrow(run, "n bigint, m array<double>, s array<double>"), "whiten_moments")
    mean = parts.agg(*[(F.sum(F.col("n") * F.col("m")[i]) / F.sum("n")).alias(f"m{i}") for i in range(k)]).first()
    gap = [F.col("m")[i] - mean[i] for i in range(k)]
    cov = parts.agg(*[(F.sum(F.col("s")[i * k + j] + F.col("n") * gap[i] * gap[j]) / F.sum("n")).alias(f"c{i}_{j}")
                      for i in range(k) for j in range(i, k)]).first()
    drop_staged(parts)
    return max(abs(cov[f"c{i}_{j}"] - (i == j)) for i in range(k) for j in range(i, k))
