"""Fitting, scoring, comparing and searching clusterings."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from cohortlens.functions import columns as C
from cohortlens.functions.columns import struct_rows
from cohortlens.functions.fixed import SILHOUETTE_TARGET
from cohortlens.operators import features as FE
from cohortlens.operators.fits import Leading, Model, block_scores, blocks_of, fit_together, points_of
from cohortlens.operators.rows import hash_sample
from cohortlens.operators.scores import Scores
from cohortlens.sources.scratch import cached, checkpointed
from cohortlens.sources.tables import broadcast_if_small, to_driver

ALGORITHMS = {"kmeans": KMeans, "bisecting": BisectingKMeans}
SEED = 42
MAX_BROADCAST_CLUSTERS = 1_000
MAX_SETTINGS = 100_000
LAYOUT_PARTITIONS = 16
LAYOUT_ROWS = 20_000
PARALLEL_FITS = 4
# What the copies of the points may take together, and what a copy takes beside the numbers.
START_BYTES = 8 << 30
POINT_BYTES = 100
SWEEP_SCHEMA = (
    "features string, k_pca int, algorithm string, k int, silhouette double, cost double, "
    "seconds double, error string"
)
SWEEP_COLUMNS = [part.split()[0] for part in SWEEP_SCHEMA.split(", ")]


@dataclass
class Clustering:
    """A fitted model with its rows and scores."""

    algorithm: str
    k: int
    model: object
    rows: DataFrame
    scores: Scores
    features: str

    @property
    def silhouette(self) -> float | None:
        return self.scores.silhouette


# ---------------------------------------------------------------- layout and fits
def stable_layout(
    df: DataFrame, key: str, columns: Sequence[str], partitions: int | None = None
) -> DataFrame:
    """Fix the partitions and row order the fits see, and cut the lineage.

    The starting centres depend on where rows lie. Hashing and sorting by the key
    gives the same layout whatever came before, as long as ``partitions`` is the same.
    Without it there are as many as the session's shuffles have, but few rows are dealt to
    fewer partitions (``LAYOUT_ROWS``): a fit's jobs are many, and each starts a task for every one.
    """
    number = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def lay(rows: DataFrame, parts: int) -> DataFrame:
        return checkpointed(rows.select(key, *columns).repartition(parts, key).sortWithinPartitions(key))

    laid = lay(df, number)
    if partitions or number <= LAYOUT_PARTITIONS:
        return laid
    enough = max(LAYOUT_PARTITIONS, -(-laid.count() // LAYOUT_ROWS))
    return laid if enough >= number else lay(laid, enough)


def fit(
    df: DataFrame | Leading, algorithm: str, k: int, features: str = "pca", prediction: str = "prediction",
    seed: int = SEED,
):
    """A model of its own. Of points that other fits are asked of too it is asked, and made with theirs."""
    if isinstance(df, Leading):
        return df.ask(algorithm, k)
    return ALGORITHMS[algorithm](
        featuresCol=features, predictionCol=prediction, k=k, seed=seed
    ).fit(df)


def starting_centres(df: DataFrame, algorithm: str, k: int, features: str = "pca", seed: int = SEED) -> np.ndarray | None:
    """The centres k-means begins with; a bisecting fit has none, its settings are checked.

    Finding them reads the points several times. The row solver holds them as vectors for
    that, unless the frame it is given is held itself: so it gets a selection of it.
    """
    fitter = ALGORITHMS[algorithm](featuresCol=features, k=k, seed=seed)
    if algorithm == "bisecting":
        if k < 2:
            raise ValueError(f"{k} clusters asked of a bisecting fit, which has two or more")
        return None
    started = fitter.setSolver("row").setMaxIter(0).fit(df.select(features))
    return np.array([list(c) for c in started.clusterCenters()], float)


def silhouette(df: DataFrame, features: str = "pca", prediction: str = "prediction") -> float | None:
    """Mean silhouette with squared Euclidean distance; None for fewer than two clusters."""
    evaluator = ClusteringEvaluator(
        featuresCol=features, predictionCol=prediction, metricName="silhouette"
    )
    try:
        return evaluator.evaluate(df)
    except Exception as problem:
        if "Number of clusters must be greater than one" in str(problem):
            return None
        raise


def fit_and_score(df: DataFrame, algorithm: str, k: int, features: str = "pca") -> Clustering:
    return fit_and_score_together(df, [algorithm], k, features)[0]


def fit_and_score_together(
    df: DataFrame, algorithms: Sequence[str], k: int, features: str = "pca"
) -> list[Clustering]:
    """One clustering per algorithm, fitted and scored in the same passes."""
    found = fitted_settings(df, algorithms, [k], features)
    for line, clustering in found:
        if clustering is None:
            raise ValueError(line.error)
    return [clustering for _, clustering in found]


# ---------------------------------------------------------------- deterministic parts
def centroids(df: DataFrame, features: str, prediction: str = "prediction") -> DataFrame:
    """Mean vector and size of each cluster."""
    return df.groupBy(prediction).agg(
        F.count(F.lit(1)).alias("n"),
        vector_to_array(Summarizer.mean(F.col(features))).alias("centre"),
    )


def model_centres(spark: SparkSession, model, axes: int = 2) -> DataFrame:
    """The leading coordinates of a model's centres, one row per cluster."""
    rows = [
        (i, *[float(v) for v in centre[:axes]]) for i, centre in enumerate(model.clusterCenters())
    ]
    names = ", ".join(f"axis_{i + 1} double" for i in range(axes))
    return spark.createDataFrame(rows, f"prediction int, {names}")


def assign(
    df: DataFrame, centres: Sequence[tuple[int, Sequence[float]]], features: str,
    out: str = "prediction",
) -> DataFrame:
    """Nearest of some given centres by squared distance; ties go to the lowest id."""
    point = vector_to_array(F.col(features))
    options = [
        F.struct(
            C.squared_distance(point, F.lit([float(v) for v in centre])).alias("distance"),
            F.lit(number).alias("id"),
        )
        for number, centre in centres
    ]
    nearest = F.array_min(F.array(*options))
    return df.withColumn("_nearest", nearest).select(
        *df.columns,
        F.col("_nearest.id").alias(out),
        F.col("_nearest.distance").alias("distance"),
    )


def cost(df: DataFrame, features: str, prediction: str = "prediction") -> DataFrame:
    """Sum of squared distances of the rows to the mean of their cluster.

    The means are broadcast once they are known to be few; beyond that they are joined.
    """
    means = broadcast_if_small(centroids(df, features, prediction), MAX_BROADCAST_CLUSTERS)
    joined = df.select(prediction, features).join(means, prediction)
    distance = C.squared_distance(vector_to_array(F.col(features)), F.col("centre"))
    return joined.agg(F.sum(distance).alias("cost"))


def silhouettes(
    df: DataFrame, features: str, labelings: Sequence[str]
) -> DataFrame:
    """Silhouette of several given labelings of the same rows; NULL below two clusters.

    All labelings share two passes: sizes, vector sums and squared lengths per labeling and
    cluster, then the mean score. A row's mean squared distance to a cluster follows from
    these sums, so no pair of rows is formed.
    """
    cells = struct_rows(
        [{"labeling": F.lit(n), "cluster": F.col(n).cast("string")} for n in labelings]
    )
    point = vector_to_array(F.col(features))
    squares = F.aggregate(point, F.lit(0.0), lambda s, v: s + v * v)
    rows = df.select(point.alias("point"), features, squares.alias("length"), F.inline(cells))
    rows = rows.where("cluster is not null")
    sums = rows.groupBy("labeling", "cluster").agg(
        F.count(F.lit(1)).alias("n"),
        vector_to_array(Summarizer.sum(F.col(features))).alias("total"),
        F.sum("length").alias("lengths"),
    )
    sides = sums.groupBy("labeling").agg(
        F.collect_list(F.struct("cluster", "n", "total", "lengths")).alias("clusters")
    )

    def mean_distance(c: Column) -> Column:
        products = F.zip_with("point", c["total"], lambda x, y: x * y)
        dot = F.aggregate(products, F.lit(0.0), lambda s, v: s + v)
        return F.col("length") + (c["lengths"] - 2 * dot) / c["n"]

    own = F.filter("clusters", lambda c: c["cluster"] == F.col("cluster"))[0]
    others = F.filter("clusters", lambda c: c["cluster"] != F.col("cluster"))
    a = mean_distance(own) * own["n"] / (own["n"] - 1)
    b = F.array_min(F.transform(others, mean_distance))
    measured = rows.join(broadcast_if_small(sides, MAX_BROADCAST_CLUSTERS), "labeling").select(
        "labeling", own["n"].alias("n"), F.size("clusters").alias("k"), a.alias("a"), b.alias("b")
    )
    larger = F.greatest("a", "b")
    score = F.when((F.col("n") == 1) | (larger == 0), 0.0).otherwise((F.col("b") - F.col("a")) / larger)
    scores = measured.groupBy("labeling").agg(F.avg(F.when(F.col("k") > 1, score)).alias("silhouette"))
    names = df.sparkSession.createDataFrame([(n,) for n in labelings], "labeling string")
    return names.join(F.broadcast(scores), "labeling", "left")


# ---------------------------------------------------------------- sweeps
def sweep(
    df: DataFrame,
    algorithms: Sequence[str] = ("kmeans", "bisecting"),
    ks: Iterable[int] = range(2, 9),
    features: str = "pca",
    label: str = "",
    k_pca: int | None = None,
    parallelism: int = PARALLEL_FITS,
) -> DataFrame:
    """Fit every algorithm for every k on held rows, and list silhouette and cost.

    A few fits run side by side: each is a series of short jobs, and one alone leaves
    executors idle between them. Many rows keep them busy alone.
    A fit that fails is listed with its error and does not end the sweep. Scores belong to
    the final centres, see ``model_scores``.
    """
    found = [line for line, _ in fitted_settings(df, algorithms, ks, features, label, k_pca, parallelism)]
    return df.sparkSession.createDataFrame(found, SWEEP_SCHEMA)


def fitted_settings(
    df: DataFrame,
    algorithms: Sequence[str],
    ks: Iterable[int],
    features: str = "pca",
    label: str = "",
    k_pca: int | None = None,
    parallelism: int = PARALLEL_FITS,
) -> list[tuple[Row, Clustering | None]]:
    """The lines of a sweep, each with its clustering; None where the fit failed.

    Starting centres are found a few fits at a time, of many rows one fit at a time: each holds
    a copy of the points, and together they may take ``START_BYTES``. From there on all fits
    advance and are scored together, see ``fits``. The seconds of a line are those of its start
    and its share of the common passes.
    """
    settings = [(algorithm, k) for algorithm in algorithms for k in ks]
    errors: dict[tuple[str, int], str] = {}
    seconds = dict.fromkeys(settings, 0.0)
    models: dict[tuple[str, int], Model] = {}
    scores: dict[tuple[str, int], Scores] = {}

    def start(held: DataFrame, setting: tuple[str, int]) -> np.ndarray | None:
        started = time.perf_counter()
        try:
            return starting_centres(held, *setting, features)
        except Exception as problem:
            errors[setting] = str(problem)
            return None
        finally:
            seconds[setting] = time.perf_counter() - started

    with cached(df) as held:
        copy = held.count() * (8 * FE.vector_size(held, features) + POINT_BYTES)
        side_by_side = min(parallelism, START_BYTES // max(copy, 1))
        run = inheritable_thread_target(df.sparkSession)(lambda setting: start(held, setting))
        with ThreadPool(max(1, min(side_by_side, len(settings)))) as pool:
            starts = dict(zip(settings, pool.map(run, settings, chunksize=1), strict=True))
        open_ = [setting for setting in settings if setting not in errors]
        started = time.perf_counter()
        try:
            if open_:
                with blocks_of(held, features) as blocks:
                    free = {s: starts[s] for s in open_ if s[0] == "kmeans"}
                    halved = {s: s[1] for s in open_ if s[0] == "bisecting"}
                    models = fit_together(blocks, free, halved, SEED, features, held.rdd.getNumPartitions())
                    scores = block_scores(blocks, models)
        except Exception as problem:
            models, scores = {}, {}
            errors |= {setting: str(problem) for setting in open_}
        for setting in open_:
            seconds[setting] += (time.perf_counter() - started) / len(open_)
    line = Row(*SWEEP_COLUMNS)
    out = []
    for setting in settings:
        (algorithm, k), own, model = setting, scores.get(setting), models.get(setting)
        clustering = own and Clustering(algorithm, k, model, model.transform(df), own, features)
        score, cost = (own.silhouette, own.cost) if own else (None, None)
        out.append((line(label, k_pca, algorithm, k, score, cost, seconds[setting], errors.get(setting)), clustering))
    return out


def fitted_sizes(
    laid: DataFrame, source: str, settings: Sequence[tuple[int, str, int]], label: str = ""
) -> list[Row]:
    """The lines of fits on leading elements of a vector: their number, algorithm and k.

    The points are held once. Starting centres of all sizes are found in the same passes, and
    from there on all fits advance and are scored together, see ``fits``. The seconds of a line
    are its share of that.
    """
    errors: dict[tuple[int, str, int], str] = {}
    scores: dict[tuple[int, str, int], Scores] = {}
    started = time.perf_counter()
    try:
        with points_of(laid, source, SEED) as points:
            for size, algorithm, k in settings:
                try:
                    fit(points.leading(size), algorithm, k, source)
                except Exception as problem:
                    errors[size, algorithm, k] = str(problem)
            _, scores = points.fitted()
    except Exception as problem:
        errors = {setting: str(problem) for setting in settings} | errors
    seconds = (time.perf_counter() - started) / max(len(settings), 1)
    line = Row(*SWEEP_COLUMNS)
    out = []
    for setting in settings:
        own = scores.get(setting)
        score, cost = (own.silhouette, own.cost) if own else (None, None)
        out.append(line(label, *setting, score, cost, seconds, errors.get(setting)))
    return out


def best_setting(
    results: DataFrame, by: Sequence[str] = (), setting: str = "k", score: str = "silhouette"
) -> DataFrame:
    """Setting with the highest score; among equals the smallest setting."""
    scored = results.where(F.col(score).isNotNull())
    return scored.groupBy(*by).agg(
        F.max_by(setting, F.struct(F.col(score), -F.col(setting))).alias(f"best_{setting}"),
        F.max(score).alias(f"best_{score}"),
    )


def top_settings(results: DataFrame, rows: int = 10, score: str = "silhouette") -> DataFrame:
    ties = [c for c in ("features", "k_pca", "algorithm", "k") if c in results.columns]
    return results.orderBy(F.desc_nulls_last(score), *ties).limit(rows)


def score_matrix(
    results: DataFrame, ks: Sequence[int], row: str = "k_pca", column: str = "k",
    score: str = "silhouette",
) -> DataFrame:
    """Scores with one line per ``row`` and one column per k."""
    wide = results.groupBy(row).pivot(column, list(ks)).agg(F.first(score))
    return wide.withColumnsRenamed({str(k): f"k_{k}" for k in ks})


def verdict(
    results: DataFrame, score: str = "silhouette", target: float = SILHOUETTE_TARGET
) -> DataFrame:
    return results.withColumn(
        "meets_target", F.coalesce(F.col(score) >= target, F.lit(False))
    )


def comparison(parts: Sequence[Clustering]) -> DataFrame:
    """One line per fitted model: k, silhouette, cost, and the size of each cluster."""
    records = [
        (p.algorithm, p.k, p.silhouette, p.scores.cost, p.scores.sizes) for p in parts
    ]
    return parts[0].rows.sparkSession.createDataFrame(
        records,
        "algorithm string, k int, silhouette double, cost double, sizes array<bigint>",
    )


def compare_labelings(df: DataFrame, features: str, labelings: Sequence[str]) -> DataFrame:
    """The same comparison for given labelings of one set of rows."""
    scores = silhouettes(df, features, labelings)
    lines = []
    for name in labelings:
        counts = df.groupBy(name).agg(F.count(F.lit(1)).alias("n"))
        sizes = counts.agg(
            F.count(F.lit(1)).alias("k"),
            F.transform(F.array_sort(F.collect_list(F.struct(name, "n"))), lambda c: c["n"]).alias("sizes"),
        )
        lines.append(
            sizes.select(
                F.lit(name).alias("labeling"),
                "k",
                cost(df, features, name).scalar().alias("cost"),
                "sizes",
            )
        )
    found = reduce(DataFrame.union, lines).join(F.broadcast(scores), "labeling")
    return found.select("labeling", "k", "silhouette", "cost", "sizes")


# ---------------------------------------------------------------- choosing
def choose(
    df: DataFrame,
    key: str,
    scaled: str = "scaled",
    k_pca: int = 3,
    ks: Sequence[int] = tuple(range(2, 9)),
    target: float = SILHOUETTE_TARGET,
    fallback_k_pca: int = 15,
    preferred: str = "kmeans",
    partitions: int | None = None,
) -> tuple[Clustering, DataFrame]:
    """Sweep both algorithms, and retry with more components when both miss ``target``.

    The best fit of the ``preferred`` algorithm is chosen, unless the retry beats every
    first score; then its best fit is, of either algorithm. One component fit serves
    both rounds. Returns the chosen clustering and the table of everything tried.
    """
    spark = df.sparkSession
    widest = FE.fit_pca(df, max(k_pca, fallback_k_pca), scaled, "_components")
    laid = stable_layout(widest.transform(df), key, ["_components"], partitions)
    available = len(widest.explainedVariance)

    def round_of(components: int) -> list[tuple[Row, Clustering | None]]:
        reduced = FE.leading(laid, "_components", "pca", components).select(key, "pca")
        return fitted_settings(reduced, tuple(ALGORITHMS), ks, "pca", "reduced", components)

    def best(parts: list[tuple[Row, Clustering | None]]) -> Clustering | None:
        scored = [part for _, part in parts if part and part.silhouette is not None]
        rank = lambda p: (-p.silhouette, p.algorithm != preferred, p.k)
        return min(scored, key=rank, default=None)

    tried = round_of(min(k_pca, available))
    highest = best(tried)
    winner = best([part for part in tried if part[0].algorithm == preferred]) or highest
    wider = min(fallback_k_pca, available)
    if (highest is None or highest.silhouette < target) and wider > k_pca:
        again = round_of(wider)
        tried += again
        retry = best(again)
        if retry and (highest is None or retry.silhouette > highest.silhouette):
            winner = retry
    if winner is None:
        raise ValueError("no clustering could be fitted")
    return winner, spark.createDataFrame([line for line, _ in tried], SWEEP_SCHEMA)


# ---------------------------------------------------------------- grids
def scaler_comparison(
    sets: dict[str, Callable[[], DataFrame]], key: str, k_pca: int = 10,
    ks: Iterable[int] = range(2, 6), partitions: int | None = None,
) -> DataFrame:
    return grid(sets, key, [k_pca], ks, ["kmeans"], partitions)


def listed_settings(spark: SparkSession, path: str) -> list[Row]:
    """The lines an earlier grid left at ``path``; none where there is no table yet."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return []
    return to_driver(spark.read.schema(SWEEP_SCHEMA).parquet(path), MAX_SETTINGS)


def grid(
    sets: dict[str, Callable[[], DataFrame]],
    key: str,
    k_pcas: Sequence[int],
    ks: Iterable[int],
    algorithms: Sequence[str] = ("kmeans", "bisecting"),
    partitions: int | None = None,
    scaled: str = "scaled",
    results: str | None = None,
) -> DataFrame:
    """Every feature set with every number of components, k and algorithm.

    Components are fitted once per set, at the largest size; smaller sizes are its
    leading elements. Sizes beyond the number of features are listed as skipped. All fits of
    a set advance together.

    With ``results``, the lines of each set are appended to a table there as soon as they are
    known, and settings that the table lists already are not fitted
    again: a grid that was interrupted goes on where it stopped. Lines with an error are tried
    again. The result is what was asked for, also if the table holds more.
    """
    ks, spark = list(ks), SparkSession.active()
    known: dict[tuple, Row] = {}
    if results:
        known = {tuple(r[:4]): r for r in listed_settings(spark, results) if r.error is None}
    found: list[Row] = []

    def add(lines: list[Row]) -> None:
        found.extend(lines)
        if results and lines:
            spark.createDataFrame(lines, SWEEP_SCHEMA).coalesce(1).write.mode("append").parquet(results)

    for label, build in sets.items():
        open_ = {k_pca: [(a, k) for a in algorithms for k in ks if (label, k_pca, a, k) not in known] for k_pca in k_pcas}
        found += [known[line] for k_pca in k_pcas for a in algorithms for k in ks if (line := (label, k_pca, a, k)) in known]
        if not any(open_.values()):
            continue
        df = build()
        width = FE.vector_size(df, scaled)
        possible = [k for k in k_pcas if k <= width and open_[k]]
        for k_pca in k_pcas:
            if k_pca > width:
                reason = f"{k_pca} components asked of {width} features"
                found += [Row(label, k_pca, a, k, None, None, 0.0, reason) for a, k in open_[k_pca]]
        if not possible:
            continue
        model = FE.fit_pca(df, max(possible), scaled, "_components")
        laid = stable_layout(model.transform(df), key, ["_components"], partitions)
        add(fitted_sizes(laid, "_components", [(k_pca, a, k) for k_pca in possible for a, k in open_[k_pca]], label))
    return spark.createDataFrame(found, SWEEP_SCHEMA)


# ---------------------------------------------------------------- projections
def projection(
    df: DataFrame, key: str, features: str, axes: Sequence[int], fraction: float,
    prediction: str = "prediction", seed: int = SEED,
) -> DataFrame:
    """A keyed sample of chosen coordinates with the cluster, for plotting.

    Axes count from 1; the coordinates are named ``pc1``, ``pc2`` and so on.
    """
    return hash_sample(df, key, fraction, seed).select(
        key,
        *[C.element(features, axis - 1).alias(f"pc{axis}") for axis in axes],
        prediction,
    )
