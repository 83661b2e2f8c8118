"""From mixed columns to scaled and reduced feature vectors."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    PCA,
    MinMaxScaler,
    OneHotEncoder,
    PCAModel,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
    VectorSlicer,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.functions.columns import struct_rows
from cohortlens.operators.profile import category_counts
from cohortlens.operators.ranks import running_totals
from cohortlens.operators.rows import distinct_names
from cohortlens.sources.scratch import written

# Spark's covariance of a wider vector would not fit one machine, and PCA refuses it.
MAX_WIDTH = 65_535


# ---------------------------------------------------------------- category index
def label_index(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Index of every label per column: 0 for the most frequent, ties by label.

    Works for any number of labels; the labels stay on the cluster.
    """
    counts = written(category_counts(df, names).where("value is not null"), "labels")
    ranked = running_totals(counts, [F.desc("n"), F.asc("value")], None, ["variable"])
    return ranked.select("variable", "value", "n", (F.col("running") - 1).alias("index"))


def index_by_join(
    df: DataFrame, names: Sequence[str], labels: DataFrame | None = None
) -> DataFrame:
    """Add ``<name>_idx`` to each row; NULL and unknown labels get the index after the last.

    Labels are joined on, so neither driver nor broadcast has to hold them. Those of another
    table may be given. A label shared by many rows makes a large join partition, which Spark
    splits at run time.
    """
    if labels is None:
        labels = written(label_index(df, names), "label-index")
    for name in names:
        own = labels.where(F.col("variable") == name)
        size = own.agg(F.count(F.lit(1)).alias("size"))
        own = own.select(
            F.col("value").alias("_label"), F.col("index").cast("double").alias("_index")
        )
        text = F.col(name).cast("string")
        df = (
            df.join(own, text == F.col("_label"), "left")
            .withColumn(f"{name}_idx", F.coalesce("_index", size.scalar().cast("double")))
            .drop("_label", "_index")
        )
    return df


# ---------------------------------------------------------------- assembling
def _scaler(kind: str, source: str, out: str):
    if kind == "minmax":
        return MinMaxScaler(inputCol=source, outputCol=out)
    if kind == "standard":
        return StandardScaler(inputCol=source, outputCol=out, withStd=True, withMean=False)
    raise ValueError(f"unknown scaler {kind!r}")


def assembler(names: Sequence[str], out: str = "features", invalid: str = "skip") -> VectorAssembler:
    """Columns to one vector; rows with NULL are skipped or, with ``error``, refused."""
    return VectorAssembler(inputCols=list(names), outputCol=out, handleInvalid=invalid)


def feature_stages(
    one_hot: Sequence[str],
    index_only: Sequence[str],
    numeric: Sequence[str],
    scaler: str | None = "minmax",
    invalid: str = "skip",
    indexed: Sequence[str] = (),
) -> list:
    """Stages: index, one-hot, assemble, scale. ``indexed`` columns already have ``_idx``."""
    one_hot, index_only = distinct_names(one_hot), distinct_names(index_only)
    to_index = [n for n in distinct_names(one_hot, index_only) if n not in indexed]
    stages = []
    if to_index:
        stages.append(
            StringIndexer(
                inputCols=to_index,
                outputCols=[f"{n}_idx" for n in to_index],
                handleInvalid="keep",
            )
        )
    if one_hot:
        stages.append(
            OneHotEncoder(
                inputCols=[f"{n}_idx" for n in one_hot],
                outputCols=[f"{n}_ohe" for n in one_hot],
            )
        )
    inputs = [f"{n}_ohe" for n in one_hot] + [f"{n}_idx" for n in index_only] + list(numeric)
    stages.append(assembler(inputs, "raw_features", invalid))
    if scaler:
        stages.append(_scaler(scaler, "raw_features", "scaled"))
    return stages


@dataclass
class FittedFeatures:
    """Fitted feature stages: a label table for the index-only columns and a fitted pipeline.

    The labels stay on the cluster, so there may be any number of them.
    """

    coded: list[str]
    labels: DataFrame | None
    model: PipelineModel

    def transform(self, df: DataFrame) -> DataFrame:
        if self.coded:
            df = index_by_join(df, self.coded, self.labels)
        return self.model.transform(df)


def fit_features(
    df: DataFrame,
    one_hot: Sequence[str] = (),
    index_only: Sequence[str] = (),
    numeric: Sequence[str] = (),
    scaler: str | None = "minmax",
    invalid: str = "skip",
) -> tuple[FittedFeatures, DataFrame]:
    """Fit the feature stages and return them with the transformed rows.

    Index-only columns are indexed by a join with their label table; one-hot columns by an
    indexer, whose labels are as many as the slots of the vectors. Each estimator reads ``df``
    again: write a costly view to a table first.
    """
    coded = [n for n in distinct_names(index_only) if n not in one_hot]
    labels = written(label_index(df, coded), "label-index") if coded else None
    indexed = index_by_join(df, coded, labels) if coded else df
    stages = feature_stages(one_hot, index_only, numeric, scaler, invalid, coded)
    fitted = FittedFeatures(coded, labels, Pipeline(stages=stages).fit(indexed))
    return fitted, fitted.model.transform(indexed)


def assembled(
    df: DataFrame, key: str, one_hot: Sequence[str] = (), index_only: Sequence[str] = (),
    numeric: Sequence[str] = (), invalid: str = "skip",
) -> DataFrame:
    """Key and unscaled vector of each row, as a table.

    What follows reads the rows several times: scalers, components and layout. Without the
    table each of them joins the labels and assembles the vectors again.
    """
    _, ready = fit_features(df, one_hot, index_only, numeric, None, invalid)
    return written(ready.select(key, "raw_features"), "assembled")


def scaled(df: DataFrame, kind: str, source: str = "raw_features", out: str = "scaled") -> DataFrame:
    """Vectors scaled by a scaler fitted on them."""
    return _scaler(kind, source, out).fit(df).transform(df)


def with_stage(fitted: FittedFeatures, stage, df: DataFrame) -> FittedFeatures:
    """Fitted stages with one more, fitted on their own output."""
    more = stage.fit(fitted.transform(df))
    return replace(fitted, model=PipelineModel(stages=[fitted.model, more]))


def vector_size(df: DataFrame, column: str) -> int:
    """Length of a vector column, from its metadata or else from one row."""
    known = df.schema[column].metadata.get("ml_attr", {}).get("num_attrs")
    if known is not None:
        return known
    row = df.select(column).where(F.col(column).isNotNull()).first()
    return len(row[0]) if row else 0


# ---------------------------------------------------------------- reduction
def fit_pca(df: DataFrame, k: int, source: str = "scaled", out: str = "pca") -> PCAModel:
    """Principal components; ``k`` is lowered to the number of features when larger.

    Vectors wider than ``MAX_WIDTH`` are refused before anything is computed.
    """
    width = vector_size(df, source)
    if width > MAX_WIDTH:
        raise ValueError(f"{width} features are too many for components; index some columns only")
    k = min(k, width)
    return PCA(k=k, inputCol=source, outputCol=out).fit(df)


def leading(df: DataFrame, source: str, out: str, k: int) -> DataFrame:
    """The first ``k`` elements of a vector: a smaller PCA without a second fit."""
    return VectorSlicer(inputCol=source, outputCol=out, indices=list(range(k))).transform(df)


def explained_variance(spark: SparkSession, model: PCAModel, asked: int | None = None) -> DataFrame:
    """Share of variance per component with its running total.

    Components up to ``asked`` that the features do not have are listed with NULL.
    """
    shares = [(i, float(v)) for i, v in enumerate(model.explainedVariance.toArray(), start=1)]
    found = cumulative(spark.createDataFrame(shares, "component int, share double"))
    lacking = range(len(shares) + 1, (asked or 0) + 1)
    if not lacking:
        return found
    empty = spark.createDataFrame([(i, None, None) for i in lacking], found.schema)
    return found.union(empty)


def covariance(df: DataFrame, column: str) -> DataFrame:
    """Covariances (divisor n - 1) of a vector column: one row per pair of places, from 1.

    Centred by the means first. Products are added up inside each task, so a task shuffles one
    row per pair, whatever the number of rows. Rows without a vector do not count.
    """
    known = df.where(F.col(column).isNotNull()).select(vector_to_array(F.col(column)).alias("point"))
    first = df.where(F.col(column).isNotNull()).agg(
        F.count(F.lit(1)).alias("n"), vector_to_array(Summarizer.mean(F.col(column))).alias("means")
    ).first()
    means = np.array(first["means"] or [], float)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(means), len(means)))
        for batch in batches:
            if batch.num_rows:
                apart = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1) - means
                total += apart.T @ apart
        places = np.arange(1, len(means) + 1, dtype=np.int32)
        columns = [np.repeat(places, len(means)), np.tile(places, len(means)), total.ravel()]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["a", "b", "value"])

    summed = known.mapInArrow(run, "a int, b int, value double").groupBy("a", "b").agg(F.sum("value").alias("value"))
    divisor = F.lit(first["n"] - 1)
    return summed.select("a", "b", F.when(divisor > 0, F.col("value") / divisor).alias("covariance"))


def component_facts(df: DataFrame, model: PCAModel, tolerance: float = 1e-8) -> DataFrame:
    """One row: whether the components are what they are called.

    They must be orthonormal and diagonalise the covariances of the source column, their
    variances must fall, and the shares must be those variances over the whole variance.
    """
    cells = covariance(df, model.getInputCol()).collect()  # as many as pairs of features
    axes = model.pc.toArray()
    matrix = np.zeros((len(axes), len(axes)))
    for cell in cells:
        matrix[cell["a"] - 1, cell["b"] - 1] = cell["covariance"]
    whole = float(np.trace(matrix))
    turned = axes.T @ matrix @ axes
    variances = np.diag(turned)
    shares = model.explainedVariance.toArray()
    near = lambda found, wanted: bool(np.abs(found - wanted).max() <= tolerance)
    facts = (
        len(shares),
        near(axes.T @ axes, np.eye(axes.shape[1])),
        near((turned - np.diag(variances)) / whole, 0.0),
        bool((np.diff(variances) <= tolerance * whole).all()),
        near(shares, variances / whole),
    )
    return df.sparkSession.createDataFrame(
        [facts],
        "components int, orthonormal boolean, diagonal boolean, falling boolean, shares_are_variances boolean",
    )


def cumulative(shares: DataFrame, order: str = "component", value: str = "share") -> DataFrame:
    """Running total over ranked shares, of any number."""
    summed = running_totals(shares, [F.col(order)], value)
    return summed.withColumnRenamed("running", "cumulative")


def components_for(
    cumulated: DataFrame, target: float = 0.85, order: str = "component"
) -> DataFrame:
    """First component whose running total reaches ``target``, else the last one."""
    reached = F.min(F.when(F.col("cumulative") >= target, F.col(order)))
    return cumulated.agg(F.coalesce(reached, F.max(order)).alias("components"))


def active_slots(df: DataFrame, key: str, names: Sequence[str]) -> DataFrame:
    """Indexed columns in long form: the one-hot slot each row sets per column."""
    cells = struct_rows(
        [{"variable": F.lit(n), "slot": F.col(f"{n}_idx").cast("int")} for n in names]
    )
    return df.select(key, F.inline(cells))
