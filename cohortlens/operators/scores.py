"""Scores of fitted clusterings, from their final centres and in two passes for any number of them.

A fit's own summary tells the cost before its last step moved the centres. Here each row is
assigned by the finished model, and what is reported belongs to the centres that are returned.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Scores:
    """What holds of one model on one set of rows."""

    silhouette: float | None
    cost: float
    sizes: list[int]
    converged: bool | None


def converged(model) -> bool | None:
    """Whether the fit ended before its last allowed step; None where the model does not tell."""
    summary = model.summary if model.hasSummary else None
    steps = getattr(summary, "numIter", None)
    return None if steps is None else steps < model.getMaxIter()


def labelled(df: DataFrame, models: Mapping[str, object], features: str) -> DataFrame:
    """The points as ``point``, with one column of clusters per model."""
    for name, model in models.items():
        df = model.transform(df, {model.predictionCol: name})
    return df.select(vector_to_array(F.col(features)).alias("point"), *models)


def _points(batch: pa.RecordBatch) -> np.ndarray:
    lists = batch.column(0)
    return lists.flatten().to_numpy().reshape(len(lists), -1)


def cluster_table(points: np.ndarray, own: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Per cluster the sums of one, squared length, squared distance and coordinates."""
    lengths = np.square(points).sum(axis=1)
    apart = np.square(points - centres[own]).sum(axis=1)
    cells = np.column_stack([np.ones(len(own)), lengths, apart, points])
    return (own[:, None] == np.arange(len(centres))).astype(float).T @ cells


def silhouette_sum(points: np.ndarray, own: np.ndarray, table: np.ndarray) -> float:
    """Sum of the points' scores; a point's mean squared distance to a cluster follows from the
    cluster's sums, so no points are paired."""
    lengths, every = np.square(points).sum(axis=1)[:, None], np.arange(len(points))
    n, sums, totals = table[:, 0], table[:, 1], table[:, 3:]
    with np.errstate(divide="ignore", invalid="ignore"):
        mean = lengths + (sums - 2 * points @ totals.T) / n
        inner = mean[every, own] * n[own] / (n[own] - 1)
        mean[every, own] = np.inf
        mean[:, n == 0] = np.inf
        outer = mean.min(axis=1)
        larger = np.maximum(inner, outer)
        score = np.where((n[own] == 1) | (larger == 0), 0.0, (outer - inner) / larger)
    return float(score.sum())


def silhouette_sums(points: np.ndarray, hot: np.ndarray, table: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The same sums for many models, whose clusters are the lines between two of ``ends``.

    ``hot`` tells which rows belong to a cluster; ``table`` has its sums of one, squared length
    and coordinates.
    """
    n, squares, totals = table[:, 0], table[:, 1], table[:, 2:]
    with np.errstate(divide="ignore", invalid="ignore"):
        mean = (-2 / n)[:, None] * totals @ points.T
        mean += np.square(points).sum(axis=1)
        mean += (squares / n)[:, None]
        mean[n == 0] = 0.0
        factor = np.where(n > 1, n / (n - 1), 0.0)
        score = []
        for at, end in zip(ends, ends[1:], strict=False):
            apart, own = mean[at:end], hot[at:end]
            inner = (own * factor[at:end, None] * apart).sum(axis=0)
            apart[own] = np.inf
            apart[n[at:end] == 0] = np.inf
            outer = apart.min(axis=0)
            larger = np.maximum(inner, outer)
            none = (larger == 0) | own[n[at:end] == 1].any(axis=0)
            score.append(np.where(none, 0.0, (outer - inner) / larger).sum())
    return np.array(score)


def cluster_sums(rows: DataFrame, centres: Mapping[str, np.ndarray]) -> DataFrame:
    """Per model and cluster: ``sums`` of one, squared length, squared distance and coordinates.

    Added up inside each task; one row per task and cluster is shuffled.
    """
    names = list(centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {name: np.zeros((len(c), 3 + c.shape[1])) for name, c in centres.items()}
        for batch in batches:
            if not batch.num_rows:
                continue
            points = _points(batch)
            for at, name in enumerate(names, start=1):
                totals[name] += cluster_table(points, batch.column(at).to_numpy(), centres[name])
        found = [(n, i, row) for n, table in totals.items() for i, row in enumerate(table) if row[0]]
        columns = list(zip(*found, strict=True)) or [(), (), ()]
        kinds = pa.string(), pa.int32(), pa.list_(pa.float64())
        arrays = [pa.array(list(c), kind) for c, kind in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, names=["model", "cluster", "sums"])

    parts = rows.mapInArrow(run, "model string, cluster int, sums array<double>")
    cells = parts.select("model", "cluster", F.posexplode("sums").alias("place", "value"))
    summed = cells.groupBy("model", "cluster", "place").agg(F.sum("value").alias("value"))
    ordered = F.array_sort(F.collect_list(F.struct("place", "value")))
    return summed.groupBy("model", "cluster").agg(F.transform(ordered, lambda c: c["value"]).alias("sums"))


def _silhouette_sums(rows: DataFrame, tables: Mapping[str, np.ndarray]) -> DataFrame:
    """Sum of the rows' scores per model."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = dict.fromkeys(tables, 0.0)
        for batch in batches:
            if not batch.num_rows:
                continue
            points = _points(batch)
            for at, (name, table) in enumerate(tables.items(), start=1):
                found[name] += silhouette_sum(points, batch.column(at).to_numpy(), table)
        arrays = [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.float64())]
        yield pa.RecordBatch.from_arrays(arrays, names=["model", "score"])

    return rows.mapInArrow(run, "model string, score double").groupBy("model").agg(F.sum("score").alias("score"))


def model_scores(df: DataFrame, models: Mapping[str, object], features: str) -> dict[str, Scores]:
    """Silhouette, cost and cluster sizes of every model on ``df``, which is read twice.

    The silhouette has squared Euclidean distances and is None below two clusters. Clusters
    without rows have size 0. The driver gets one row of sums per model and cluster.
    """
    if not models:
        return {}
    centres = {name: np.array([list(c) for c in model.clusterCenters()], float) for name, model in models.items()}
    rows = labelled(df, models, features)
    tables = {name: np.zeros((len(c), 3 + c.shape[1])) for name, c in centres.items()}
    for row in cluster_sums(rows, centres).collect():
        tables[row["model"]][row["cluster"]] = row["sums"]
    several = {name: t for name, t in tables.items() if (t[:, 0] > 0).sum() > 1}
    scored = rows.select("point", *several)
    sums = {r["model"]: r["score"] for r in _silhouette_sums(scored, several).collect()} if several else {}
    return {
        name: Scores(
            sums[name] / float(table[:, 0].sum()) if name in sums else None,
            float(table[:, 2].sum()),
            [int(n) for n in table[:, 0]],
            converged(models[name]),
        )
        for name, table in tables.items()
    }
