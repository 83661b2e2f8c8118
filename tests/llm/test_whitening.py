"""Whitening against a dense eigendecomposition of exact integers."""

import math
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortlens.llm import whitening
from cohortlens.llm.common import table


@given(st.integers(1, 9), st.integers(1, 20), st.integers(0, 2**32 - 1), st.sampled_from([1.0, 1e-9, 1e6]))
@settings(max_examples=200, deadline=None)
def test_updates(width, rows, seed, scale):
    draw = np.random.default_rng(seed)
    # Few different entries, so that zero rows, equal rows and equal eigenvalues come up.
    data = draw.integers(-2, 3, (rows, width)) * draw.choice([1.0, scale], width)
    values, vectors = np.zeros(width), np.eye(width)
    for row in data:
        values, vectors = whitening.rank_one(values, vectors, row)
    scatter = data.T @ data
    size = max(float(np.abs(scatter).max()), 1e-300)
    assert np.abs(vectors.T @ vectors - np.eye(width)).max() < 1e-12
    assert np.abs(vectors * values @ vectors.T - scatter).max() < 1e-12 * size * width
    assert (np.diff(values) >= 0).all()


def test_roots_lie_between_poles():
    poles = np.array([0.0, 1.0, 1.0 + 1e-12, 5.0])
    weights = np.array([1e-20, 0.5, 1e-3, 2.0])
    origin, x = whitening.secular_roots(poles, weights)
    roots = poles[origin] + x
    assert (roots[:-1] >= poles[:-1]).all() and (roots[:-1] <= poles[1:]).all()
    assert poles[-1] < roots[-1] <= poles[-1] + weights.sum()


def scaled(vector):
    """The integers of a usable vector, else None."""
    if vector is None or any(c is None or not math.isfinite(c) for c in vector):
        return None
    return tuple(math.floor(64 * c) + 1_000_000 for c in vector)


def check(rows, found, components=16):
    kept = [(key, scaled(v)) for key, v in rows if scaled(v) is not None]
    fit = np.array(sorted({x for _, x in kept}), object)
    n, sums = len(fit), fit.sum(axis=0)
    covariance = [[Fraction(int(sum((n * fit[:, i] - sums[i]) * (n * fit[:, j] - sums[j]))), n**3) for j in range(fit.shape[1])] for i in range(fit.shape[1])]
    dense = np.array(covariance, float)
    values, axes = np.linalg.eigh(dense)
    values, axes = values[::-1], axes[:, ::-1]
    k = min(components, int((values > 1e-12 * values[0]).sum()))
    assert len(found) == k * len(kept)
    by_row = {}
    for r in found:
        by_row.setdefault(r["vec_id"], {}).setdefault(r["component"], []).append(r)
    for key, x in kept:
        parts = by_row[key]
        assert sorted(parts) == list(range(1, k + 1))
        for c, lines in parts.items():
            for r in lines:
                assert r["n"] == n
                assert r["explained"] == pytest.approx(values[c - 1] / np.trace(dense), rel=1e-9)
                assert r["identity_error"] < 1e-9
        if sum(key == other for other, _ in kept) == 1:
            expected = sum((n * int(a) - int(s)) ** 2 for a, s in zip(x, sums, strict=True))
            assert {r["deviation"] for lines in parts.values() for r in lines} == {expected}
            centred = (n * np.array(x, object) - sums) / n
            for c, lines in parts.items():
                value = abs(float(centred.astype(float) @ axes[:, c - 1])) / math.sqrt(values[c - 1])
                assert abs(lines[0]["whitened"]) == pytest.approx(value, abs=1e-8)
    # One sign for all rows of a component.
    for c in range(1, k + 1):
        one = {key: parts[c][0]["whitened"] for key, parts in by_row.items()}
        first = max(one, key=lambda key: abs(one[key]))
        x = dict(kept)[first]
        sign = np.sign(float((n * np.array(x, object) - sums).astype(float) @ axes[:, c - 1]) * one[first])
        for key, x in kept:
            assert one[key] == pytest.approx(sign * float(((n * np.array(x, object) - sums) / n).astype(float) @ axes[:, c - 1]) / math.sqrt(values[c - 1]), abs=1e-7)


def test_rows(spark):
    draw = np.random.default_rng(3)
    data = (draw.normal(size=(400, 6)) * [3, 1, 0.5, 0.2, 2, 0.1]).round(3).tolist()
    rows = [(i, v) for i, v in enumerate(data)]
    rows += [(1000 + i, data[0]) for i in range(300)]  # copies count once in the fit
    rows += [(2000, None), (2001, [None] * 6), (2002, data[1][:5] + [None]), (2003, data[2][:5] + [float("nan")]), (2004, data[2][:5] + [float("inf")])]
    rows += [(5, data[5])]
    docs = spark.createDataFrame([(k, v, 1) for k, v in rows], "vec_id long, embedding array<double>, n int").repartition(7)
    check(rows, whitening.whiten(docs).collect())
    check(rows, whitening.whiten(docs, components=2).collect(), 2)


def test_flat_and_empty(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, None), (2, [])], schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).collect() == []
    line = [(i, [float(i), 2.0 * i, 0.0]) for i in range(5)] + [(9, [1.0]), (None, [3.0, 6.0, 0.0]), (10, [3e38, 0.0, 0.0])]
    found = whitening.whiten(spark.createDataFrame(line, schema)).collect()
    assert {r["component"] for r in found} == {1} and len(found) == 6
    assert [r["explained"] for r in found] == pytest.approx([1.0] * 6)


def test_deviation_beyond_a_long():
    x = np.array([[2**39, 0], [1, 1]])
    found = whitening.deviations(x, 2**20, np.array([0, 0]))
    assert found == [None, 2 * 2**40]


def test_whole_table(spark, small):
    embeddings = table(spark, small, "embeddings")
    rows = [(r["vec_id"], r["embedding"]) for r in embeddings.collect()]
    check(rows, whitening.whiten(embeddings).collect())
