"""Fits, scores, sweeps, grids and their result tables."""

from __future__ import annotations

from functools import cache, reduce

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.operators import clusters as CL
from cohortlens.operators import features as FE
from cohortlens.operators.scores import model_scores
from cohortlens.queries import registry
from cohortlens.queries import sql as S
from cohortlens.queries.features import filled, measured
from cohortlens.queries.repairs import sample_sql
from cohortlens.sources.encounters import CATEGORICAL, DIAGNOSES, NUMERIC
from cohortlens.functions.fixed import SILHOUETTE_TARGET
from cohortlens.sources.scratch import fresh_path
from cohortlens.sources.tables import read_csv, read_table, to_driver, write_csv, write_json

add = registry.add


def vectors(spark, folder):
    """Embeddings as ML vectors, with the given label as cluster."""
    return read_table(spark, folder, "embeddings").select(
        "vec_id", array_to_vector("embedding").alias("pca"), F.col("label").alias("prediction")
    )


def laid_vectors(spark, folder):
    return CL.stable_layout(vectors(spark, folder), "vec_id", ["pca"])


CODES = ["medical_specialty", *DIAGNOSES]


def prepared(spark, folder):
    """The repaired columns all feature sets are made of, written once."""
    return filled(spark, folder, [*CATEGORICAL, *CODES, *NUMERIC])


def mixed_vectors(rows):
    return FE.assembled(rows, "encounter_id", CATEGORICAL, CODES, NUMERIC)


def mixed_features(vectors, scaler: str):
    return FE.scaled(vectors, scaler).select("encounter_id", "scaled")


def numeric_features(rows):
    _, ready = FE.fit_features(rows, numeric=NUMERIC)
    return ready.select("encounter_id", "scaled")


def scored(df):
    """Scores rounded, timings left out: they differ from run to run."""
    return df.withColumns(
        {"silhouette": F.round("silhouette", 6), "cost": F.round("cost", 4)}
    ).drop("seconds")


# ---------------------------------------------------------------- fits
def _fit_query(spark, folder, algorithm: str, k: int):
    laid = laid_vectors(spark, folder)
    model = CL.fit(laid, algorithm, k)
    return model.transform(laid).select("vec_id", "prediction")


@add("cl1_kmeans")
def kmeans(spark, folder):
    return _fit_query(spark, folder, "kmeans", 4)


@add("cl2_bisecting_kmeans")
def bisecting(spark, folder):
    return _fit_query(spark, folder, "bisecting", 4)


def _points(run: str, cluster: str, length: str = "64", source: str = "embeddings") -> str:
    return (
        f"SELECT {run} AS run, vec_id AS id, {cluster} AS cl, "
        f"list_transform(embedding[1:{length}], lambda x: CAST(x AS DOUBLE)) AS vec FROM {source}"
    )


@add(
    "cl3_silhouette",
    f"WITH {S.silhouette_tables(_points('1', 'label'))} "
    "SELECT 'prediction' AS labeling, round(silhouette, 9) AS silhouette FROM scores",
)
def silhouette(spark, folder):
    scores = CL.silhouettes(vectors(spark, folder), "pca", ["prediction"])
    return scores.withColumn("silhouette", F.round("silhouette", 9))


LONG = (
    "long AS (SELECT vec_id, label, unnest(range(1, 65)) AS axis, "
    "CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings), "
    "means AS (SELECT label, axis, avg(v) AS m FROM long GROUP BY ALL)"
)


@add(
    "cl4_cluster_cost",
    f"WITH {LONG} SELECT round(sum((v - m) * (v - m)), 6) AS cost FROM long JOIN means "
    "ON means.label = long.label AND means.axis = long.axis",
)
def cluster_cost(spark, folder):
    return CL.cost(vectors(spark, folder), "pca").withColumn("cost", F.round("cost", 6))


@add(
    "cl5_centroids",
    f"WITH {LONG} SELECT label AS prediction, (SELECT count(*) FROM embeddings e "
    "WHERE e.label = means.label) AS n, round(max(CASE WHEN axis = 1 THEN m END), 9) AS axis_1, "
    "round(max(CASE WHEN axis = 2 THEN m END), 9) AS axis_2 FROM means GROUP BY label",
)
def centroids(spark, folder):
    return CL.centroids(vectors(spark, folder), "pca").select(
        "prediction", "n",
        F.round(F.col("centre")[0], 9).alias("axis_1"),
        F.round(F.col("centre")[1], 9).alias("axis_2"),
    )


@add("cl5_model_centres")
def model_centres(spark, folder):
    model = CL.fit(laid_vectors(spark, folder), "kmeans", 4)
    centres = CL.model_centres(spark, model)
    return centres.withColumns({n: F.round(n, 6) for n in ("axis_1", "axis_2")})


@add(
    "cl1_assign_to_centres",
    f"WITH {LONG}, d AS (SELECT l.vec_id, m.label, sum((l.v - m.m) * (l.v - m.m)) AS d FROM long l "
    "JOIN means m ON m.axis = l.axis GROUP BY ALL), r AS (SELECT *, row_number() OVER "
    "(PARTITION BY vec_id ORDER BY d, label) AS place FROM d) "
    "SELECT vec_id, label AS prediction, round(d, 6) AS distance FROM r WHERE place = 1",
)
def assign_to_centres(spark, folder):
    points = vectors(spark, folder)
    means = to_driver(CL.centroids(points, "pca"), 1_000)
    centres = [(row.prediction, row.centre) for row in means]
    return CL.assign(points.drop("prediction"), centres, "pca").select(
        "vec_id", "prediction", F.round("distance", 6).alias("distance")
    )


# ---------------------------------------------------------------- sweeps
@add("cl6_sweep_kmeans")
def sweep_kmeans(spark, folder):
    return scored(CL.sweep(laid_vectors(spark, folder), ["kmeans"], range(2, 9)))


@add("cl7_sweep_bisecting")
def sweep_bisecting(spark, folder):
    return scored(CL.sweep(laid_vectors(spark, folder), ["bisecting"], range(2, 9)))


@add("cl8_fixed_k")
def fixed_k(spark, folder):
    ready = mixed_features(mixed_vectors(prepared(spark, folder)), "standard")
    reduced = FE.fit_pca(ready, 10).transform(ready)
    laid = CL.stable_layout(reduced, "encounter_id", ["pca"])
    parts = CL.fit_and_score_together(laid, ("kmeans", "bisecting"), 3)
    return CL.comparison(parts).select(
        "algorithm", "k", F.round("silhouette", 6).alias("silhouette"),
        F.round("cost", 3).alias("cost"), F.array_join(F.col("sizes").cast("array<string>"), " ").alias("sizes"),
    )


def _feature_sets(spark, folder, *names: str) -> dict:
    """The named sets; those that differ in the scaler only share their vectors."""
    rows = prepared(spark, folder)
    mixed = cache(lambda: mixed_vectors(rows))
    every = {
        "minmax": lambda: mixed_features(mixed(), "minmax"),
        "standard": lambda: mixed_features(mixed(), "standard"),
        "numeric": lambda: numeric_features(rows),
    }
    return {name: every[name] for name in names}


@add("cl9_scaler_comparison")
def scaler_comparison(spark, folder):
    sets = _feature_sets(spark, folder, "minmax", "standard")
    return scored(CL.scaler_comparison(sets, "encounter_id", 10, range(2, 6)))


@add("cl10_numeric_baseline")
def numeric_baseline(spark, folder):
    laid = CL.stable_layout(numeric_features(measured(spark, folder)), "encounter_id", ["scaled"])
    return scored(CL.sweep(laid, ["kmeans"], range(2, 6), "scaled", "numeric"))


@add("cl11_scaler_grid")
def scaler_grid(spark, folder):
    sets = _feature_sets(spark, folder, "minmax", "standard")
    return scored(
        CL.grid(sets, "encounter_id", [5, 10, 15, 20], range(2, 7), ["kmeans"])
    )


@add("cl12_feature_set_grid")
def feature_set_grid(spark, folder):
    sets = _feature_sets(spark, folder, "minmax", "standard", "numeric")
    found = CL.grid(sets, "encounter_id", [5, 10, 15, 20], range(2, 8))
    return scored(found)


@add("cl13_fallback")
def fallback(spark, folder):
    ready = mixed_features(mixed_vectors(prepared(spark, folder)), "minmax")
    chosen, tried = CL.choose(ready, "encounter_id")
    return scored(tried).withColumn(
        "chosen",
        (F.col("algorithm") == chosen.algorithm)
        & (F.col("k") == chosen.k)
        & (F.col("k_pca") == FE.vector_size(chosen.rows, "pca")),
    )


@add(
    "cl14_projection_sample",
    "SELECT vec_id, CAST(embedding[2] AS DOUBLE) AS pc2, CAST(embedding[3] AS DOUBLE) AS pc3, "
    f"label AS prediction FROM embeddings WHERE {sample_sql('vec_id', 0.5)}",
)
def projection_sample(spark, folder):
    return CL.projection(vectors(spark, folder), "vec_id", "pca", [2, 3], 0.5)


# ---------------------------------------------------------------- result tables
# A sweep both engines can do: for each k the label modulo k is the cluster, and the
# first 8, 16 or 64 axes are the features.
LENGTHS, KS = (8, 16, 64), range(2, 9)


def labeled_sweep(spark, folder):
    labeled = vectors(spark, folder).withColumns(
        {f"k{k}": (F.col("prediction") % k).cast("int") for k in KS}
    )
    parts = []
    for length in LENGTHS:
        short = FE.leading(labeled, "pca", "short", length)
        scores = CL.silhouettes(short, "short", [f"k{k}" for k in KS])
        parts.append(
            scores.select(
                F.lit(length).alias("k_pca"),
                F.substring("labeling", 2, 3).cast("int").alias("k"),
                F.round("silhouette", 9).alias("silhouette"),
            )
        )
    return reduce(DataFrame.union, parts)


SWEEP_SQL = (
    "WITH "
    + S.silhouette_tables(
        _points(
            "len * 100 + k", "label % k", "len",
            f"embeddings, (SELECT unnest({list(LENGTHS)}) AS len), "
            f"(SELECT unnest({list(KS)}) AS k)",
        )
    )
    + ", results AS (SELECT CAST(run // 100 AS INTEGER) AS k_pca, CAST(run % 100 AS INTEGER) AS k, "
    "round(silhouette, 9) AS silhouette FROM scores) "
)


@add(
    "ag21_best_setting",
    SWEEP_SQL + "SELECT k_pca, arg_max(k, (silhouette, -k)) AS best_k, "
    "max(silhouette) AS best_silhouette FROM results GROUP BY k_pca",
)
def best_setting(spark, folder):
    return CL.best_setting(labeled_sweep(spark, folder), ["k_pca"])


@add(
    "ag22_score_matrix",
    SWEEP_SQL + "SELECT k_pca, "
    + ", ".join(f"max(CASE WHEN k = {k} THEN silhouette END) AS k_{k}" for k in KS)
    + " FROM results GROUP BY k_pca",
)
def score_matrix(spark, folder):
    return CL.score_matrix(labeled_sweep(spark, folder), list(KS))


@add(
    "ag23_verdict",
    SWEEP_SQL + "SELECT k_pca, k, silhouette, silhouette >= 0.0 AS meets_target FROM results",
)
def verdict(spark, folder):
    return CL.verdict(labeled_sweep(spark, folder), target=0.0)


@add(
    "t3_top_settings",
    SWEEP_SQL + "SELECT k_pca, k, silhouette FROM results ORDER BY silhouette DESC, k_pca, k LIMIT 10",
)
def top_settings(spark, folder):
    return CL.top_settings(labeled_sweep(spark, folder), 10)


@add(
    "ag24_compare_labelings",
    "WITH "
    + S.silhouette_tables(
        _points("k", "label % k", "64", "embeddings, (SELECT unnest([3, 5]) AS k)")
    )
    + ", centre AS (SELECT run, cl, axis, avg(v) AS m FROM u GROUP BY ALL), "
    "costs AS (SELECT u.run, sum((v - m) * (v - m)) AS cost FROM u JOIN centre c ON c.run = u.run "
    "AND c.cl = u.cl AND c.axis = u.axis GROUP BY u.run), "
    "sizes AS (SELECT run, string_agg(CAST(n AS VARCHAR), ' ' ORDER BY cl) AS sizes, "
    "count(*) AS k FROM cluster_sums GROUP BY run) "
    "SELECT 'modulo_' || CAST(scores.run AS VARCHAR) AS labeling, sizes.k AS k, "
    "round(silhouette, 9) AS silhouette, round(cost, 6) AS cost, sizes "
    "FROM scores JOIN costs USING (run) JOIN sizes USING (run)",
)
def compare_labelings(spark, folder):
    labeled = vectors(spark, folder).withColumns(
        {f"modulo_{k}": (F.col("prediction") % k).cast("int") for k in (3, 5)}
    )
    found = CL.compare_labelings(labeled, "pca", ["modulo_3", "modulo_5"])
    return found.withColumns(
        {
            "silhouette": F.round("silhouette", 9),
            "cost": F.round("cost", 6),
            "sizes": F.array_join(F.col("sizes").cast("array<string>"), " "),
        }
    )


@add("ag24_model_comparison")
def model_comparison(spark, folder):
    laid = laid_vectors(spark, folder)
    parts = CL.fit_and_score_together(laid, ("kmeans", "bisecting"), 3)
    return CL.verdict(CL.comparison(parts)).select(
        "algorithm", "k", F.round("silhouette", 6).alias("silhouette"),
        F.round("cost", 4).alias("cost"), "meets_target",
    )



# ---------------------------------------------------------------- facts about fits
# What a fit finds has no SQL, but what must hold for any fit has: which settings are
# listed, how many rows are assigned, that scores and costs lie where they must.
def scores_in_bounds(found, rows, features: str):
    """Each listed setting with whether its score and cost can be right."""
    spread = vector_to_array(Summarizer.variance(F.col(features)))
    summed = F.aggregate(spread, F.lit(0.0), lambda a, v: a + v) * (F.count(F.lit(1)) - 1)
    total = rows.agg(summed.alias("ss")).scalar()
    score = F.col("silhouette")
    return found.select(
        *[c for c in ("features", "k_pca", "algorithm", "k") if c in found.columns],
        F.col("error").isNull().alias("fitted"),
        (score.isNull() | score.between(-1, 1)).alias("score_in_range"),
        (F.col("cost").isNull() | (F.col("cost") <= total * (1 + 1e-9))).alias("cost_within_total"),
    )


def _settings_sql(algorithm: str, ks: range) -> str:
    return (
        f"SELECT '' AS features, CAST(NULL AS INTEGER) AS k_pca, '{algorithm}' AS algorithm, "
        f"CAST(unnest(range({ks.start}, {ks.stop})) AS INTEGER) AS k, true AS fitted, "
        "true AS score_in_range, true AS cost_within_total"
    )


def _sweep_facts(spark, folder, algorithm: str, ks: range):
    laid = laid_vectors(spark, folder)
    return scores_in_bounds(CL.sweep(laid, [algorithm], ks), laid, "pca")


@add("cl6_sweep_kmeans_facts", _settings_sql("kmeans", range(2, 9)))
def sweep_kmeans_facts(spark, folder):
    return _sweep_facts(spark, folder, "kmeans", range(2, 9))


@add("cl7_sweep_bisecting_facts", _settings_sql("bisecting", range(2, 9)))
def sweep_bisecting_facts(spark, folder):
    return _sweep_facts(spark, folder, "bisecting", range(2, 9))


def _fit_facts(spark, folder, algorithm: str):
    """Rows, clusters, rows away from their nearest centre, and whether the cost adds up."""
    laid = laid_vectors(spark, folder).drop("prediction")
    model = CL.fit(laid, algorithm, 4)
    own = model.transform(laid).select("vec_id", F.col("prediction").alias("own"))
    centres = [(i, [float(v) for v in c]) for i, c in enumerate(model.clusterCenters())]
    both = CL.assign(laid, centres, "pca").join(own, "vec_id")
    cost = model_scores(laid, {"own": model}, "pca")["own"].cost
    return both.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("own").alias("clusters"),
        F.count_if(F.col("own") != F.col("prediction")).alias("misplaced"),
        (F.abs(F.sum("distance") - cost) <= 1e-6 * cost).alias("cost_adds_up"),
    )


@add(
    "cl1_kmeans_facts",
    "SELECT count(*) AS n_rows, CAST(4 AS BIGINT) AS clusters, CAST(0 AS BIGINT) AS misplaced, "
    "true AS cost_adds_up FROM embeddings",
)
def kmeans_facts(spark, folder):
    return _fit_facts(spark, folder, "kmeans")


@add(
    "cl2_bisecting_facts",
    "SELECT count(*) AS n_rows, CAST(4 AS BIGINT) AS clusters FROM embeddings",
)
def bisecting_facts(spark, folder):
    return _fit_facts(spark, folder, "bisecting").select("n_rows", "clusters")


COMPLETE = " AND ".join(f"{n} IS NOT NULL" for n in NUMERIC)


@add(
    "cl8_fixed_k_facts",
    S.on_encounters(
        "SELECT algorithm, 3 AS k, (SELECT count(*) FROM encounters WHERE " + COMPLETE + ") AS n_rows "
        "FROM (SELECT unnest(['kmeans', 'bisecting']) AS algorithm)"
    ),
)
def fixed_k_facts(spark, folder):
    """The cluster sizes add up to the rows without missing numbers."""
    sizes = F.aggregate(F.split("sizes", " ").cast("array<bigint>"), F.lit(0).cast("bigint"), lambda a, b: a + b)
    return fixed_k(spark, folder).select("algorithm", "k", sizes.alias("n_rows"))


def _grid_sql(sets: list[str], k_pcas: list[int], ks: range, algorithms: list[str]) -> str:
    return (
        f"SELECT features, CAST(k_pca AS INTEGER) AS k_pca, algorithm, CAST(k AS INTEGER) AS k, "
        f"features <> 'numeric' OR k_pca <= {len(NUMERIC)} AS fitted, true AS score_in_range "
        f"FROM (SELECT unnest({sets}) AS features), (SELECT unnest({k_pcas}) AS k_pca), "
        f"(SELECT unnest({algorithms}) AS algorithm), (SELECT unnest(range({ks.start}, {ks.stop})) AS k)"
    )


def _grid_facts(found):
    score = F.col("silhouette")
    return found.select(
        "features", "k_pca", "algorithm", "k", F.col("error").isNull().alias("fitted"),
        (score.isNull() | score.between(-1, 1)).alias("score_in_range"),
    )


@add("cl9_scaler_comparison_facts", _grid_sql(["minmax", "standard"], [10], range(2, 6), ["kmeans"]))
def scaler_comparison_facts(spark, folder):
    return _grid_facts(scaler_comparison(spark, folder))


@add("cl10_numeric_baseline_facts", _settings_sql("kmeans", range(2, 6)).replace("'' AS f", "'numeric' AS f"))
def numeric_baseline_facts(spark, folder):
    laid = CL.stable_layout(numeric_features(measured(spark, folder)), "encounter_id", ["scaled"])
    return scores_in_bounds(CL.sweep(laid, ["kmeans"], range(2, 6), "scaled", "numeric"), laid, "scaled")


@add("cl12_grid_facts", _grid_sql(["numeric"], [5, 10], range(2, 5), ["kmeans", "bisecting"]))
def grid_facts(spark, folder):
    """A grid with sizes beyond the number of features, which are listed as not fitted."""
    sets = _feature_sets(spark, folder, "numeric")
    return _grid_facts(CL.grid(sets, "encounter_id", [5, 10], range(2, 5)))


@add(
    "cl13_fallback_facts",
    "SELECT CAST(3 AS INTEGER) AS k_pca, algorithm, CAST(k AS INTEGER) AS k, true AS score_in_range "
    "FROM (SELECT unnest(['kmeans', 'bisecting']) AS algorithm), (SELECT unnest(range(2, 9)) AS k)",
)
def fallback_facts(spark, folder):
    """The first round always lists both algorithms with every k."""
    return _grid_facts(fallback(spark, folder).where("k_pca = 3")).drop("features", "fitted")


# ---------------------------------------------------------------- the results of a real grid
def _small_grid(spark, folder):
    """Twelve fits on the numeric columns, as a table that each line was appended to."""
    sets = _feature_sets(spark, folder, "numeric")
    path = fresh_path(spark, "grid-results")
    CL.grid(sets, "encounter_id", [2, 3], range(2, 5), results=path)
    return spark.read.schema(CL.SWEEP_SCHEMA).parquet(path)


@add("ag22_grid_matrix")
def grid_matrix(spark, folder):
    """The scores of a grid, one line per algorithm and number of components."""
    lines = _small_grid(spark, folder)
    named = lines.withColumn("run", F.concat_ws(" ", "algorithm", "k_pca"))
    matrix = CL.score_matrix(named, range(2, 5), "run")
    return matrix.withColumns({c: F.round(c, 6) for c in matrix.columns if c != "run"})


def _chain_sql() -> str:
    return (
        "SELECT features, CAST(k_pca AS INTEGER) AS k_pca, algorithm, CAST(3 AS BIGINT) AS settings, "
        "true AS best_is_highest, true AS same_in_matrix, true AS same_in_csv, true AS verdict_fits, "
        "true AS top_falls, true AS json_is_best FROM (SELECT 'numeric' AS features), "
        "(SELECT unnest([2, 3]) AS k_pca), (SELECT unnest(['kmeans', 'bisecting']) AS algorithm)"
    )


@add("ag21_grid_chain_facts", _chain_sql())
def grid_chain_facts(spark, folder):
    """A grid's table through best settings, matrix, verdict, top list, CSV and JSON.

    Each step's result is compared with the lines it came from.
    """
    lines = _small_grid(spark, folder)
    by = ["features", "k_pca", "algorithm"]
    best = CL.best_setting(lines, by).withColumnsRenamed({"best_k": "own_k", "best_silhouette": "own_score"})
    # Sorted lines as CSV, and read again.
    csv, json = fresh_path(spark, "grid-csv"), fresh_path(spark, "grid-best")
    ranked = CL.top_settings(CL.verdict(lines), CL.MAX_SETTINGS)
    write_csv(ranked.coalesce(1), csv)
    again = read_csv(spark, csv, ranked.schema).select(*by, "k", F.col("silhouette").alias("csv_score"), "meets_target")
    # The best line as JSON, and read again.
    write_json(CL.top_settings(lines, 1), json)
    first = spark.read.schema(CL.SWEEP_SCHEMA).json(json).select(*by, "k").withColumn("from_json", F.lit(True))
    matrix = CL.score_matrix(lines.withColumn("run", F.concat_ws(" ", *by)), range(2, 5), "run")
    cells = matrix.unpivot("run", [f"k_{k}" for k in range(2, 5)], "column", "cell").select(
        "run", F.substring_index("column", "_", -1).cast("int").alias("k"), "cell"
    )
    highest = lines.agg(F.max("silhouette")).scalar()
    top = to_driver(CL.top_settings(lines, 10).select("silhouette"))
    falls = all(a.silhouette >= b.silhouette for a, b in zip(top, top[1:], strict=False))
    joined = (
        lines.join(best, by)
        .join(again, [*by, "k"])
        .join(first, [*by, "k"], "left")
        .withColumn("run", F.concat_ws(" ", *by))
        .join(cells, ["run", "k"])
    )
    score = F.col("silhouette")
    return joined.groupBy(*by).agg(
        F.count(F.lit(1)).alias("settings"),
        (F.bool_and(score <= F.col("own_score")) & F.bool_or((F.col("k") == F.col("own_k")) & (score == F.col("own_score")))).alias("best_is_highest"),
        F.bool_and(score == F.col("cell")).alias("same_in_matrix"),
        F.bool_and(score == F.col("csv_score")).alias("same_in_csv"),
        F.bool_and(F.col("meets_target") == (score >= SILHOUETTE_TARGET)).alias("verdict_fits"),
        F.lit(falls).alias("top_falls"),
        F.bool_and(F.col("from_json").isNull() | (score == highest)).alias("json_is_best"),
    )
