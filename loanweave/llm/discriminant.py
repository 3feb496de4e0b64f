"""Quality classifier: a regularised quadratic discriminant.

A text becomes a vector of transformed statistics (lengths, shares of symbols,
capitals, separators, repeated words and lines, ...).  Each class, junk (0) and
good (1), is a normal density whose covariance is shrunk toward the pooled one and
then toward a multiple of the identity.  The log-odds of a text are the prior's
plus the difference of the two log-densities: Mahalanobis distances through the
Cholesky factors of the covariances, which are factored once and kept with the
model.  Both shrinkages and a scale of the log-odds are those of least held-out
log loss over four folds of the learning rows.

Scale: the texts are read once, into a staged row of integers per document.
Labels meet these narrow rows in one shuffle; equal statistics of one label count
once, combined before the shuffle, so that copies of a text weigh as one and sit in one fold.
Moments are sums of integers, hence exact and alike for every partitioning.  The
driver gets sums per fold and class and one loss per setting, never rows.

Defined results: a null or empty text has statistics of zero; a label beside a
null doc_id, or null itself, teaches nothing; repeated and contradicting labels all
count; repeated rows give repeated results.  With labels of one class every score
is that label, without labels 0.5; an empty table gives no rows.  Very long texts
are read whole.  Other columns of either table are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanweave.llm.common import byte_slices, drop_staged, mix64, ship_package, span_hashes, stage, text_bytes, word_spans

THRESHOLD = 0.3
FOLDS = 4
#: Statistics are kept as integers of this many units each.
UNITS = 4096
#: Settings compared: shrinkage toward the pooled covariance, toward the identity, scale of the log-odds.
TOWARD_POOLED = (0.0, 0.1, 0.3, 0.6)
TOWARD_IDENTITY = (0.001, 0.01, 0.1)
SCALES = (1.0, 0.5, 0.25)

STATISTICS = ("words", "word_length", "line_words", "symbols", "digits", "capitals", "lone_marks", "marks",
              "distinct", "in_place", "repeated", "dup_lines", "short_words", "length_spread")


def _flag(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_SYMBOL, _DIGIT = _flag(b"#*$%&|<>"), _flag(b"0123456789")
_UPPER = _flag(bytes(range(65, 91)))
_LETTER = _flag(bytes([*range(65, 91), *range(97, 123), *range(0x80, 0x100)]))
_SPACE = _flag(bytes([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]))
_HEAD = ~_flag(bytes(range(0x80, 0xC0)))  # first byte of a character


def statistics(column: pa.Array) -> np.ndarray:
    """(texts, STATISTICS) doubles of a column of texts."""
    data, starts = text_bytes(column)
    n = len(column)
    ws, we = word_spans(data)
    doc = np.searchsorted(starts, ws, side="right") - 1
    head = np.concatenate(([0], np.cumsum(_HEAD[data], dtype=np.int64)))

    def per_text(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return total[starts[1:]] - total[starts[:-1]]

    def per_word(values: np.ndarray) -> np.ndarray:
        return np.bincount(doc, weights=values, minlength=n)

    def distinct(keys: np.ndarray, of: np.ndarray) -> np.ndarray:
        own = mix64(keys + of.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
        return np.bincount(of[np.unique(own, return_index=True)[1]], minlength=n)

    size = (head[we] - head[ws]).astype(float)
    lettered = np.concatenate(([0], np.cumsum(_LETTER[data], dtype=np.int64)))
    h = span_hashes(data, ws, we)
    words = np.bincount(doc, minlength=n)
    some, two = np.maximum(words, 1), np.maximum(words - 1, 1)
    next_in = doc[1:] == doc[:-1]
    after = np.flatnonzero(next_in & (h[1:] == h[:-1]))
    pairs = np.flatnonzero(next_in)
    gram = mix64(h[pairs] * np.uint64(0x9E3779B97F4A7C15) + h[pairs + 1])
    chars = np.maximum(per_word(size), 1)
    ends = np.flatnonzero(data == 10)
    begins = np.concatenate(([0], ends[:-1] + 1))
    spaces = np.concatenate(([0], np.cumsum(_SPACE[data], dtype=np.int64)))
    full = ends - begins > spaces[ends] - spaces[begins]
    line_of = np.searchsorted(starts, begins[full], side="right") - 1
    lines = np.bincount(line_of, minlength=n)
    some_lines = np.maximum(lines, 1)
    letters = np.maximum(per_text(_LETTER[data] & _HEAD[data]), 1)
    mean = per_word(size) / some
    columns = {
        "words": np.log1p(words), "word_length": np.log1p(mean), "line_words": np.log1p(words / some_lines),
        "symbols": np.log1p(20 * per_text(_SYMBOL[data]) / chars), "digits": np.log1p(20 * per_text(_DIGIT[data]) / chars),
        "capitals": np.log1p(10 * per_text(_UPPER[data]) / letters),
        "lone_marks": np.log1p(20 * per_word(lettered[we] == lettered[ws]) / some),
        "marks": np.log1p(20 * per_text(~_SPACE[data] & ~_LETTER[data]) / chars),
        "distinct": distinct(h, doc) / some,
        "in_place": np.log1p(20 * np.bincount(doc[after], minlength=n) / two),
        "repeated": 1 - distinct(gram, doc[pairs]) / two * (words > 1),
        "dup_lines": np.log1p(20 * (lines - distinct(span_hashes(data, begins[full], ends[full]), line_of)) / some_lines),
        "short_words": per_word(size <= 3) / some,
        "length_spread": np.log1p(np.sqrt(np.maximum(per_word(size * size) / some - mean * mean, 0))),
    }
    return np.stack([columns[k] for k in STATISTICS], axis=1)


def held_out(doc_id: Column) -> Column:
    """The rows that nothing is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def text_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, x array<bigint>): every text's statistics in UNITS."""
    frame = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    p = len(STATISTICS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in byte_slices(b, 1):
                x = np.rint(statistics(part.column(1)) * UNITS).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(pa.array(np.arange(part.num_rows + 1, dtype=np.int32) * p), pa.array(x.ravel()))],
                    ["doc_id", "x"])

    return frame.mapInArrow(run, f"doc_id {frame.schema['doc_id'].dataType.simpleString()}, x array<bigint>")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), len(STATISTICS))


@dataclass(frozen=True)
class Normal:
    """A class density: ``mean``, the inverse of the covariance's Cholesky factor, its log determinant."""
    mean: np.ndarray
    inverse_factor: np.ndarray
    log_det: float

    def log_density(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) @ self.inverse_factor.T
        return -0.5 * ((z * z).sum(axis=1) + self.log_det)


@dataclass(frozen=True)
class Discriminant:
    """``classes``: densities of 0 and 1, or None; ``constant``: the score without both."""
    center: np.ndarray
    spread: np.ndarray
    classes: tuple[Normal, Normal] | None
    prior: float
    scale: float
    constant: float = 0.5

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        z = (x / UNITS - self.center) / self.spread
        return self.scale * (self.classes[1].log_density(z) - self.classes[0].log_density(z) + self.prior)

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.classes is None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.log_odds(x), -700, 700)))


def _moments(rows: DataFrame) -> dict[tuple[int, int], tuple[int, list, list]]:
    """(fold, label) -> (rows, sums, sums of products as a flat upper triangle), all exact."""
    p = len(STATISTICS)
    i, j = np.triu_indices(p + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple, np.ndarray] = {}
        for b in batches:
            fold, label = b.column(0).to_numpy(), b.column(1).to_numpy()
            x = np.concatenate((np.ones((b.num_rows, 1), np.int64), _matrix(b.column(2))), axis=1)
            for f, c in {(int(f), int(c)) for f, c in zip(fold, label)}:
                mine = x[(fold == f) & (label == c)]
                total[f, c] = total.get((f, c), 0) + (mine.T @ mine)
        for (f, c), m in total.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), v, np.int64)) for v in (f, c)] + [
                pa.array(np.arange(len(i))), pa.array(m[i, j])], ["fold", "label", "at", "v"])

    parts = rows.mapInArrow(run, "fold bigint, label bigint, at bigint, v bigint")
    out: dict = {}
    for r in parts.groupBy("fold", "label", "at").agg(F.sum(F.col("v").cast("decimal(20,0)")).alias("v")).collect():
        out.setdefault((r["fold"], r["label"]), [0] * len(i))[r["at"]] = int(r["v"])
    return out


def _add(parts: list[list[int]]) -> list[int]:
    return [sum(v) for v in zip(*parts)]


def _mean_cov(flat: list[int]) -> tuple[float, np.ndarray, np.ndarray]:
    """Rows, mean and covariance in units of one, centred as integers."""
    p = len(STATISTICS)
    m = [[0] * (p + 1) for _ in range(p + 1)]
    for v, a, b in zip(flat, *np.triu_indices(p + 1)):
        m[a][b] = m[b][a] = v
    n = m[0][0]
    cov = np.array([[(n * m[a + 1][b + 1] - m[0][a + 1] * m[0][b + 1]) / (n * n * UNITS * UNITS) for b in range(p)] for a in range(p)])
    return n, np.array([m[0][a + 1] / (n * UNITS) for a in range(p)]), cov


def discriminant(moments: dict[int, list[int]], toward_pooled: float, toward_identity: float, scale: float) -> Discriminant:
    """The model of the class moments under one setting of the regularisation."""
    p = len(STATISTICS)
    live = {c: _mean_cov(m) for c, m in moments.items() if m and m[0] > 0}
    if len(live) < 2:
        return Discriminant(np.zeros(p), np.ones(p), None, 0.0, 1.0, float(next(iter(live), 0.5)))
    n, center, cov = _mean_cov(_add([moments[0], moments[1]]))
    spread = np.sqrt(np.maximum(np.diag(cov), 1e-6))
    both = [(c[0], (c[1] - center) / spread, c[2] / np.outer(spread, spread)) for c in (live[0], live[1])]
    pooled = sum(c[0] * c[2] for c in both) / n
    classes = []
    for _, mean, own in both:
        mixed = (1 - toward_pooled) * own + toward_pooled * pooled
        size = max(np.trace(mixed) / p, 1e-3)
        mixed = (1 - toward_identity) * mixed + toward_identity * size * np.eye(p)
        factor = np.linalg.cholesky(mixed)
        classes.append(Normal(mean, np.linalg.inv(factor), 2 * float(np.log(np.diag(factor)).sum())))
    return Discriminant(center, spread, (classes[0], classes[1]), math.log(both[1][0] / both[0][0]), scale)


def learn(stats: DataFrame, labels: DataFrame) -> Discriminant:
    """Fit on the rows of ``stats`` (of :func:`text_statistics`) that ``labels.quality`` marks."""
    ship_package(stats.sparkSession)
    marked = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select(
        F.col("doc_id").alias("l_doc"), F.col("quality").cast("long").alias("label"))
    fold = F.pmod(F.xxhash64("x"), F.lit(FOLDS))
    rows = stage(stats.join(marked, F.col("doc_id") == F.col("l_doc")).groupBy("label", "x").agg(F.count("*").alias("copies"))
                 .select(fold.cast("long").alias("fold"), "label", "x"), "discriminant_rows")
    moments = _moments(rows)

    def without(f: int | None) -> dict[int, list[int]]:
        return {c: _add([m for (g, k), m in moments.items() if k == c and g != f]) for c in (0, 1)}

    grid = [(a, b, s) for a in TOWARD_POOLED for b in TOWARD_IDENTITY for s in SCALES]
    models = [[discriminant(without(f), *setting) for setting in grid] for f in range(FOLDS)]

    def losses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(grid))
        for b in batches:
            folds, label, x = b.column(0).to_numpy(), b.column(1).to_numpy(), _matrix(b.column(2))
            for f in np.unique(folds):
                mine = folds == f
                for k, model in enumerate(models[f]):
                    right = np.where(label[mine] == 1, model.score(x[mine]), 1 - model.score(x[mine]))
                    total[k] -= np.log(np.maximum(right, 1e-9)).sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(grid))), pa.array(np.rint(total * 1e6).astype(np.int64))], ["at", "loss"])

    found = rows.mapInArrow(losses, "at bigint, loss bigint").groupBy("at").agg(F.sum("loss").alias("loss")).collect()
    drop_staged(rows)
    best = min(found, key=lambda r: (r["loss"], r["at"]))["at"] if found else 0
    return discriminant(without(None), *grid[best])


def score(stats: DataFrame, model: Discriminant) -> DataFrame:
    """(doc_id, score) of every row of ``stats``."""
    ship_package(stats.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(_matrix(b.column(1))))], ["doc_id", "score"])

    return stats.select("doc_id", "x").mapInArrow(run, f"doc_id {stats.schema['doc_id'].dataType.simpleString()}, score double")
