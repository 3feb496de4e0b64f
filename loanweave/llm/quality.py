"""Robust multivariate outliers: a minimum covariance determinant (MCD)
estimate per language and source rejects documents by Mahalanobis distance.

One pass over the texts takes counts (words, symbols, repeated lines, words in
repeated 5-word windows, ...).  A transformed vector of them is compared with
the MCD location and scatter of its (lang, source) group.  An estimate has several
starts: medians with absolute deviations, and small hashed subsets of the group.  Each
start is improved by concentration steps, which keep in each group the
``SUBSET`` share of rows nearest by the last estimate and take their mean and
covariance, until no determinant changes any more; the start of least
determinant wins, and its scatter is scaled by the median distance.

Groups of any size have an estimate of their own, shrunk toward that of their
language, and those of languages toward that of all rows, with the weight of ``PRIOR_ROWS``
rows.  A feature's variance is at least its floor's, so that a feature that is constant in
a group does not reject on noise.

Scale: the counts are staged once; a step is one quantile sketch and one sum of
moments per group and start, both combined before the shuffle, so a hot source sends one
row per task.  All rows enter every step.  The estimates, a few rows per group,
are staged and joined to the rows as Spark chooses.

Defined results: a null or empty text has no words and fails the base rule; a
null language or source is a group of its own; repeated rows give repeated
results; other columns of the input are not read; an empty table gives no rows;
very long texts are read whole.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanweave.llm.common import (
    byte_slices, drop_staged, map_batches, mix64, ship_package, span_hashes, stage, text_bytes, word_spans,
)

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
#: Share of a group's rows that a concentration step keeps.
SUBSET = 0.75
#: Covariance of the nearest 75 % of a seven-dimensional normal sample, undone while steps run.
SUBSET_SPREAD = 1.33
MAX_STEPS = 8
#: Hashed subsets that starts beyond the first are taken from, and rows of one (in expectation).
SUBSETS, SUBSET_ROWS = 2, 28
SETTLED = 1e-3  # change of a log determinant that ends the steps
#: Rows that the estimate above a group counts as.
PRIOR_ROWS = 60
#: Squared distances above this are outliers.  Chi-square with seven degrees of freedom
#: exceeds 34 once in 90,000 rows; shares of repeated lines, marks and digits have heavier tails.
CUTOFF = 50.0
CHI2_MEDIAN = 6.346  # of seven degrees of freedom
FEATURES = ("f_word_len", "f_symbols", "f_dup_lines", "f_repeats", "f_line_len", "f_other", "f_in_place")
#: Least standard deviation of each feature: below it a spread is noise.
FLOOR = (0.1, 0.2, 0.5, 0.27, 0.45, 0.3, 0.2)

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_LETTER = np.zeros(256, bool)
_LETTER[list(range(65, 91)) + list(range(97, 123)) + list(range(0x80, 0x100))] = True
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_other", "n_in_place")


def _repeat_counts(h: np.ndarray, n_docs: int, doc_of: np.ndarray) -> np.ndarray:
    out = np.zeros(n_docs, np.int64)
    n = len(h) - WINDOW + 1
    if n <= 0:
        return out
    gram = np.zeros(n, np.uint64)
    for k in range(WINDOW):
        gram = mix64(gram * np.uint64(0x9E3779B97F4A7C15) + h[k:n + k])
    at = np.flatnonzero(doc_of[:n] == doc_of[WINDOW - 1:])
    if not len(at):
        return out
    key = mix64(gram[at] + doc_of[at].astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(len(h) + 1, np.int64)
    np.add.at(cover, at[twice], 1)
    np.add.at(cover, at[twice] + WINDOW, -1)
    hit = np.cumsum(cover[:-1]) > 0
    return np.bincount(doc_of[hit], minlength=n_docs)


def _dup_lines(data: np.ndarray, starts: np.ndarray, spaces_before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n_docs = len(starts) - 1
    ends = np.flatnonzero(data == 10)  # the byte that sets texts apart ends each one's last line
    begins = np.concatenate(([0], ends[:-1] + 1))
    full = (ends - begins) > (spaces_before[ends] - spaces_before[begins])
    begins, ends = begins[full], ends[full]
    doc = np.searchsorted(starts, begins, side="right") - 1
    lines = np.bincount(doc, minlength=n_docs)
    key = np.unique(mix64(span_hashes(data, begins, ends) + doc.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)),
                    return_index=True)[1]
    return lines - np.bincount(doc[key], minlength=n_docs), lines


def count_texts(column: pa.Array) -> dict[str, np.ndarray]:
    """The counts of every text of a batch."""
    data, starts = text_bytes(column)
    n_docs = len(column)
    ws, we = word_spans(data)
    doc_of = np.searchsorted(starts, ws, side="right") - 1

    def per_doc(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return total[starts[1:]] - total[starts[:-1]]

    space = _SPACE[data]
    dup, lines = _dup_lines(data, starts, np.concatenate(([0], np.cumsum(space, dtype=np.int64))))
    head = (data & 0xC0) != 0x80
    h = span_hashes(data, ws, we)
    again = np.flatnonzero((h[1:] == h[:-1]) & (doc_of[1:] == doc_of[:-1])) + 1
    return {"n_words": np.bincount(doc_of, minlength=n_docs), "word_chars": per_doc(head & ~space),
            "n_symbols": per_doc(_SYMBOL[data]), "n_dup_lines": dup,
            "n_repeat_words": _repeat_counts(h, n_docs, doc_of), "n_lines": lines,
            "n_other": per_doc(~space & ~_LETTER[data]), "n_in_place": np.bincount(doc_of[again], minlength=n_docs)}


def text_counts(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, source, counts...) of every text."""
    frame = docs.select("doc_id", F.col("lang").cast("string").alias("lang"),
                        F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text"))

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        parts = []
        for part in byte_slices(b, 3):
            c = count_texts(part.column(3))
            parts.append(pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2),
                                                     *(pa.array(c[k], pa.int64()) for k in COUNTS)],
                                                    ["doc_id", "lang", "source", *COUNTS]))
        return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]

    id_type = frame.schema["doc_id"].dataType.simpleString()
    return map_batches(frame, run, f"doc_id {id_type}, lang string, source string, "
                       + ", ".join(f"{k} bigint" for k in COUNTS))


#: Lines, words and characters without any finding that every text is taken to have besides
#: its own, so that one finding in a very short text is no large share.
BLANK_LINES, BLANK_WORDS, BLANK_CHARS = 3, 10, 60


def _features() -> dict:
    words, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    share = {"f_symbols": F.col("n_symbols") / (chars + BLANK_CHARS), "f_dup_lines": F.col("n_dup_lines") / (F.col("n_lines") + BLANK_LINES),
             "f_repeats": F.col("n_repeat_words") / (words + BLANK_WORDS), "f_other": F.col("n_other") / (chars + BLANK_CHARS),
             "f_in_place": F.col("n_in_place") / (words + BLANK_WORDS)}
    return {"f_word_len": F.log(chars / words), "f_line_len": F.log(words / F.greatest("n_lines", F.lit(1)))} | {
        k: F.log1p(20 * v) for k, v in share.items()}


def _estimates(moments: DataFrame) -> DataFrame:
    """(grp, start, n, mean, cov, inverse, log_det) from the moments of each group's subset, its
    size and, where there is one, the estimate above it (``t_mean``, ``t_cov``)."""
    p = len(FEATURES)

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = b.to_pydict()
        out: list[list] = [[], [], [], []]
        for k in range(b.num_rows):
            n = rows["m"][k]
            mu = np.array([rows[f"s{i}"][k] for i in range(p)]) / n
            cov = np.empty((p, p))
            for i in range(p):
                for j in range(i + 1):
                    cov[i, j] = cov[j, i] = rows[f"s{i}_{j}"][k] / n - mu[i] * mu[j]
            cov *= SUBSET_SPREAD
            if rows["t_mean"][k] is not None:
                own = rows["n"][k] / (rows["n"][k] + PRIOR_ROWS)
                mu = own * mu + (1 - own) * np.array(rows["t_mean"][k])
                cov = own * cov + (1 - own) * np.array(rows["t_cov"][k]).reshape(p, p)
            cov = _floored(cov)
            for at, v in zip(out, (mu.tolist(), cov.ravel().tolist(), np.linalg.inv(cov).ravel().tolist(), float(np.linalg.slogdet(cov)[1]))):
                at.append(v)
        lists = pa.list_(pa.float64())
        return pa.RecordBatch.from_arrays(
            [b.column("grp"), b.column("start"), b.column("n"), *(pa.array(v, lists) for v in out[:3]), pa.array(out[3], pa.float64())],
            ["grp", "start", "n", "mean", "cov", "inverse", "log_det"])

    return map_batches(moments, run, "grp string, start int, n bigint, mean array<double>, cov array<double>, "
                                     "inverse array<double>, log_det double")


def _floored(cov: np.ndarray) -> np.ndarray:
    """The covariance with no variance under its feature's floor."""
    return cov + np.diag(np.maximum(np.square(FLOOR) - np.diag(cov), 0) + 1e-9)


def _with_distance(df: DataFrame) -> DataFrame:
    """``df`` with column ``d2``: the squared distance by ``mean`` and the symmetric ``inverse``.
    The differences are columns of their own, so that each is taken once."""
    p = len(FEATURES)
    gaps = df.withColumns({f"_gap{i}": F.col(f) - F.col("mean")[i] for i, f in enumerate(FEATURES)})
    terms = [(1 if i == j else 2) * F.col("inverse")[i * p + j] * F.col(f"_gap{i}") * F.col(f"_gap{j}") for i in range(p) for j in range(i, p)]
    return gaps.withColumn("d2", reduce(lambda a, b: a + b, terms)).drop(*[f"_gap{i}" for i in range(p)])


def _moments() -> list:
    p, x = len(FEATURES), [F.col(f) for f in FEATURES]
    return [F.count("*").alias("m"), *[F.sum(x[i]).alias(f"s{i}") for i in range(p)],
            *[F.sum(x[i] * x[j]).alias(f"s{i}_{j}") for i in range(p) for j in range(i + 1)]]


def fit_mcd(rows: DataFrame, above: DataFrame | None = None) -> DataFrame:
    """(grp, n, mean, cov, inverse, log_det) of each group of ``rows`` (grp plus FEATURES).
    ``above``: (grp, t_mean, t_cov), the estimate that each group's is shrunk toward."""
    p = len(FEATURES)
    sizes = rows.groupBy("grp").agg(F.count("*").alias("n"), *[F.percentile_approx(
        f, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 2000).alias(f"q_{f}") for f in FEATURES])
    none = F.lit(None).cast("array<double>")
    sizes = sizes.withColumns({"t_mean": none, "t_cov": none}) if above is None else sizes.join(above, "grp", "left")
    sizes = stage(sizes, "mcd_sizes")
    known = sizes.select("grp", "n", "t_mean", "t_cov")
    spread = [F.greatest((F.col(f"q_{f}")[2] - F.col(f"q_{f}")[0]) / 1.349, F.lit(s)) for f, s in zip(FEATURES, FLOOR)]

    def diagonal(v):
        return F.array(*[v[i] if i == j else F.lit(0.0) for i in range(p) for j in range(p)])

    medians = sizes.select("grp", F.lit(0).alias("start"), "n", F.array(*[F.col(f"q_{f}")[1] for f in FEATURES]).alias("mean"),
                           diagonal([x * x for x in spread]).alias("cov"), diagonal([1 / (x * x) for x in spread]).alias("inverse"),
                           F.lit(float("inf")).alias("log_det"))
    drawn = [rows.join(known, "grp").where(
        (F.xxhash64(*FEATURES, F.lit(k)) / 2.0**64 + 0.5) < SUBSET_ROWS / F.col("n"))
        .groupBy("grp").agg(*_moments()).withColumn("start", F.lit(k)) for k in range(1, SUBSETS + 1)]
    est = stage(medians.unionByName(_estimates(reduce(DataFrame.unionByName, drawn).join(known, "grp"))), "mcd")
    for _ in range(MAX_STEPS):
        at = _with_distance(rows.join(est.select("grp", "start", "mean", "inverse"), "grp")).select("grp", "start", *FEATURES, "d2")
        near = stage(at.groupBy("grp", "start").agg(F.percentile_approx("d2", SUBSET, 2000).alias("reach")), "mcd_reach")
        moments = at.join(near, ["grp", "start"]).where("d2 <= reach").groupBy("grp", "start").agg(*_moments())
        new = stage(_estimates(moments.join(known, "grp")), "mcd")
        change = new.select("grp", "start", "log_det").join(est.select("grp", "start", F.col("log_det").alias("was")), ["grp", "start"]).agg(
            F.max(F.abs(F.col("log_det") - F.col("was")))).first()[0]
        drop_staged(est)
        drop_staged(near)
        est = new
        if change is None or change <= SETTLED:
            break
    best = est.groupBy("grp").agg(F.min_by(F.struct("n", "mean", "cov", "inverse", "log_det"), F.struct("log_det", "start")).alias("b")).select("grp", "b.*")
    best = stage(best, "mcd_best")
    # The median distance tells by how much the subset understates the spread.
    middle = _with_distance(rows.join(best.select("grp", "mean", "inverse"), "grp")).groupBy("grp").agg(
        F.percentile_approx("d2", 0.5, 2000).alias("d50"))
    wide = best.join(middle, "grp").withColumn("by", F.greatest(
        (F.col("n") * F.col("d50") / CHI2_MEDIAN + PRIOR_ROWS) / (F.col("n") + PRIOR_ROWS), F.lit(0.5)))
    out = stage(wide.select("grp", "n", "mean", F.transform("cov", lambda v: v * F.col("by")).alias("cov"),
                            F.transform("inverse", lambda v: v / F.col("by")).alias("inverse"), "log_det"), "mcd_fit")
    for old in (sizes, est, best):
        drop_staged(old)
    return out


def score_quality(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """(doc_id, counts..., base_failed, distance, kept)."""
    ship_package(docs.sparkSession)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    said = lambda *c: F.to_json(F.struct(*[F.coalesce(F.col(x), F.lit("\u0000")).alias(x) for x in c]))
    counts = stage(text_counts(docs).withColumn("base_failed", failed).withColumn("g3", said("lang", "source"))
                   .withColumn("g2", said("lang")), "quality_counts")
    feats = counts.where("not base_failed").select("g3", "g2", *[v.alias(k) for k, v in _features().items()])

    def level(group) -> DataFrame:
        return feats.select(group.alias("grp"), *FEATURES)

    def target(est: DataFrame, links: DataFrame) -> DataFrame:
        return links.join(est.select(F.col("grp").alias("up"), F.col("mean").alias("t_mean"), F.col("cov").alias("t_cov")), "up").drop("up")

    every = fit_mcd(level(F.lit("all")))
    langs = feats.select(F.col("g2").alias("grp"), F.lit("all").alias("up")).distinct()
    by_lang = fit_mcd(level(F.col("g2")), target(every, langs))
    sources = feats.select(F.col("g3").alias("grp"), F.col("g2").alias("up")).distinct()
    params = fit_mcd(level(F.col("g3")), target(by_lang, sources)).select(F.col("grp").alias("c3"), "mean", "inverse")
    scored = counts.join(params, F.col("g3") == F.col("c3"), "left")
    for k, v in _features().items():
        scored = scored.withColumn(k, v)
    d2 = F.when(~F.col("base_failed"), F.col("d2"))
    return _with_distance(scored).select("doc_id", *COUNTS, "base_failed", d2.alias("distance"),
                         (~F.col("base_failed") & (F.coalesce(d2, F.lit(0.0)) <= cutoff)).alias("kept"))
