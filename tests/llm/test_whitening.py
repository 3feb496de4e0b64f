"""Bit-sliced scatter and whitening against plain integer and numpy arithmetic."""

import math
import random

import duckdb
import numpy as np
import pytest

from loanweave.llm import queries, whitening

SF = "/root/testdata/sf0.001"


def plain(vectors, k=8):
    """(n, S, deviation per vector, eigenvalues, whitened up to sign) by Python integers and numpy."""
    x = [[math.floor(1024 * float(c)) + 100000 for c in v] for v in vectors]
    n, dims = len(x), len(x[0])
    s = [sum(r[i] for r in x) for i in range(dims)]
    cov = np.array([[float(n * sum(r[i] * r[j] for r in x) - s[i] * s[j]) / (n * n) for j in range(dims)] for i in range(dims)])
    e, axes = np.linalg.eigh(cov)
    e, axes = e[::-1][:k], axes[:, ::-1][:, :k]
    dev = [sum((n * c - t) ** 2 for c, t in zip(r, s)) for r in x]
    with np.errstate(all="ignore"):
        white = (np.array(x, float) - np.array([t / n for t in s])) @ axes / np.sqrt(e)
    return n, dev, e, np.trace(cov), white


def test_scatter_is_exact_for_wide_ranges():
    rnd = np.random.default_rng(5)
    for widths in ([1, 3, 11], [1, 17, 40, 62], [1, 1]):
        y = np.stack([rnd.integers(0, 1 << w, 333) for w in widths], axis=1)
        y[:, 0] = 1
        sums = whitening.Scatter(widths)
        sums.add(y[:100])
        sums.add(y[100:])
        got = {}
        for r in sums.take().to_pylist():
            got[r["i"], r["j"]] = got.get((r["i"], r["j"]), 0) + (r["v"] << (32 * r["limb"]))
        rows = [[int(v) for v in r] for r in y]
        assert got == {(i, j): sum(r[i] * r[j] for r in rows) for i in range(len(widths)) for j in range(i, len(widths))}


def test_query_equals_plain_arithmetic(spark):
    got = queries.QUERIES["op11_embedding_whitening"](spark, SF).collect()
    rows = duckdb.connect().execute(f"select vec_id, embedding from '{SF}/embeddings.parquet'").fetchall()
    n, dev, e, trace, white = plain([r[1] for r in rows])
    at = {r[0]: i for i, r in enumerate(rows)}
    assert len(got) == 8 * len(rows) and {r["component"] for r in got} == set(range(1, 9))
    sign = {}
    for r in got:
        i, c = at[r["vec_id"]], r["component"] - 1
        assert (r["n"], r["deviation"]) == (n, dev[i])
        assert r["explained"] == pytest.approx(e[c] / trace, rel=1e-9)
        assert r["identity_error"] < 1e-9
        if abs(white[i, c]) > 1e-3:
            sign.setdefault(c, math.copysign(1, r["whitened"] * white[i, c]))
            assert r["whitened"] == pytest.approx(sign[c] * white[i, c], rel=1e-6)


def test_unusable_rows_large_entries_and_no_spread(spark):
    rnd = random.Random(3)
    good = [[rnd.uniform(-3, 3), rnd.choice([-4.0e5, 7.0e5]), 1.0] for _ in range(70)]
    rows = [(i, v) for i, v in enumerate(good)] + [
        (100, None), (101, []), (102, [1.0, None, 2.0]), (103, [1.0, float("nan"), 2.0]),
        (104, [float("inf"), 0.0, 1.0]), (105, [1.0, 2.0]), (106, [1e300, 0.0, 0.0]), (None, good[0]), (0, good[0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    model = whitening.fit(frame.select("embedding"))
    used = good + [good[0], good[0]]
    n, dev, e, trace, white = plain(used)
    assert model.n == n == 72 and model.eigenvalues[2] == 0.0
    got = whitening.whiten(frame, model).collect()
    assert sorted((r["vec_id"] is None, r["vec_id"]) for r in got if r["vec_id"] is not None) == [
        (False, i) for i in sorted([0, *range(70)])]
    for r in got:
        i = r["vec_id"] or 0
        assert int(r["deviation"]) == dev[i]  # beyond 64 bits here
        assert r["whitened"][2] is None
        assert np.allclose(np.abs(r["whitened"][:2]), np.abs(white[i, :2]), rtol=1e-6, atol=1e-9)
    assert whitening.identity_error(frame.select("embedding"), model) < 1e-6


def test_empty_and_single(spark, tmp_path):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    none.write.parquet(str(tmp_path / "a" / "embeddings.parquet"))
    out = queries.QUERIES["op11_embedding_whitening"](spark, str(tmp_path / "a"))
    assert out.collect() == [] and out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    spark.createDataFrame([(1, [0.5, 2.0], 1)], none.schema).write.parquet(str(tmp_path / "b" / "embeddings.parquet"))
    one = queries.QUERIES["op11_embedding_whitening"](spark, str(tmp_path / "b")).collect()
    assert [(r["component"], r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one] == [
        (1, 1, 0, None, 0.0, 0.0), (2, 1, 0, None, 0.0, 0.0)]
