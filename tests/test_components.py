"""Covariances and components against numpy, and a grid that is interrupted."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from cohortlens.operators import clusters as CL
from cohortlens.operators import features as FE
from cohortlens.sources.scratch import fresh_path


def _vectors(spark, data, parts=3):
    rows = [(i, Vectors.dense(v)) for i, v in enumerate(data.tolist())] + [(-1, None)]
    return spark.createDataFrame(rows, ["id", "scaled"]).repartition(parts)


@pytest.fixture(scope="module")
def data():
    return np.random.default_rng(4).normal(size=(60, 4)) * [1, 5, 0.1, 2] + [0, 1e5, 3, 0]


def test_covariance(spark, data):
    cells = FE.covariance(_vectors(spark, data), "scaled").collect()
    found = np.zeros((4, 4))
    for c in cells:
        found[c.a - 1, c.b - 1] = c.covariance
    assert len(cells) == 16 and found == pytest.approx(np.cov(data.T), rel=1e-9, abs=1e-9)


def test_facts_tell_wrong_components(spark, data):
    df = _vectors(spark, data).where("scaled is not null")
    model = FE.fit_pca(df, 4)
    assert tuple(FE.component_facts(df, model).first()) == (4, True, True, True, True)
    other = _vectors(spark, data[:, ::-1] * [1, 1, 7, 1]).where("scaled is not null")
    _, orthonormal, diagonal, _, shares = FE.component_facts(other, model).first()
    assert orthonormal and not diagonal and not shares


def test_components_that_are_lacking(spark, data):
    model = FE.fit_pca(_vectors(spark, data).where("scaled is not null"), 9)
    rows = FE.explained_variance(spark, model, 6).orderBy("component").collect()
    assert [r.component for r in rows] == [1, 2, 3, 4, 5, 6]
    assert [r.share is None for r in rows] == [False] * 4 + [True] * 2
    assert rows[3].cumulative == pytest.approx(1.0)


def test_grid_goes_on(spark, data, monkeypatch):
    df = _vectors(spark, data).where("scaled is not null")
    path = fresh_path(spark, "grid")
    fits = []
    real = CL.fit

    def counted(rows, algorithm, k, features):
        fits.append((algorithm, k))
        return real(rows, algorithm, k, features)

    monkeypatch.setattr(CL, "fit", counted)
    first = CL.grid({"all": lambda: df}, "id", [2], [2, 3], ["kmeans"], 2, results=path).collect()
    assert len(fits) == 2 and len(first) == 2
    whole = CL.grid({"all": lambda: df}, "id", [2, 3, 9], [2, 3, 4], ["kmeans", "bisecting"], 2, results=path)
    assert len(fits) == 2 + 12 - 2
    lines = {tuple(r[:4]): r for r in whole.collect()}
    assert len(lines) == 18 and sum(r.error is not None for r in lines.values()) == 6
    for r in first:
        assert lines[tuple(r[:4])] == r
    again = CL.grid({"all": lambda: df}, "id", [2, 3], [2, 3, 4], ["kmeans", "bisecting"], 2, results=path)
    assert len(fits) == 12 and again.count() == 12
    alone = CL.grid({"all": lambda: df}, "id", [2, 3], [2, 3, 4], ["kmeans", "bisecting"], 2)
    key = lambda r: tuple(r[:4])
    for a, b in zip(sorted(again.collect(), key=key), sorted(alone.collect(), key=key), strict=True):
        assert a[:4] == b[:4] and a.silhouette == pytest.approx(b.silhouette, rel=1e-9)
