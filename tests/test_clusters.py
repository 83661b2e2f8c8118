"""Features and clusterings: goldens, properties, failure cases."""

import pytest
from pyspark.ml.feature import PCA, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Row
from pyspark.sql import functions as F

from cohortlens.operators import clusters as CL
from cohortlens.operators import features as FE
from cohortlens.operators import interpret as IN
from cohortlens.operators import rows as R
from cohortlens.queries.clusterings import vectors
from cohortlens.sources.encounters import CATEGORICAL, DIAGNOSES, NUMERIC, encounters


@pytest.fixture(scope="module")
def filled(spark, small):
    return R.fill_unknown(encounters(spark, small), [*CATEGORICAL, *DIAGNOSES]).cache()


@pytest.fixture(scope="module")
def ready(filled):
    _, df = FE.fit_features(filled, CATEGORICAL, DIAGNOSES, NUMERIC)
    return df.select("encounter_id", "scaled").cache()


def test_index_ties_and_null(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "x string")
    labels = {r["value"]: r["index"] for r in FE.label_index(df, ["x"]).collect()}
    assert labels == {"c": 0, "a": 1, "b": 2}
    joined = {r.x: r.x_idx for r in FE.index_by_join(df, ["x"]).collect()}
    assert joined == {"c": 0.0, "a": 1.0, "b": 2.0, None: 3.0}


def test_fitted_features_transform_new_rows(filled):
    """Index-only columns go through a join, on new rows and with one more stage, too."""
    fitted, first = FE.fit_features(filled, (), DIAGNOSES, NUMERIC)
    indexer = StringIndexer(
        inputCols=DIAGNOSES, outputCols=[f"{n}_own" for n in DIAGNOSES], handleInvalid="keep"
    )
    own = indexer.fit(filled).transform(first)
    for name in DIAGNOSES:
        assert own.where(F.col(f"{name}_own") != F.col(f"{name}_idx")).count() == 0
    again = fitted.transform(filled.limit(50).withColumn("diag_1", F.lit("never seen")))
    last = first.agg(F.max("diag_1_idx")).first()[0]
    assert {r.diag_1_idx for r in again.select("diag_1_idx").collect()} == {last + 1}
    longer = FE.with_stage(fitted, PCA(k=2, inputCol="scaled", outputCol="pca"), filled)
    assert FE.vector_size(longer.transform(filled), "pca") == 2


def test_too_wide_vectors_are_refused(ready, monkeypatch):
    monkeypatch.setattr(FE, "MAX_WIDTH", 3)
    with pytest.raises(ValueError, match="too many"):
        FE.fit_pca(ready, 2)


def test_scalers_on_constant_columns(spark):
    df = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0)], "x double, y double")
    for kind, expected in (("minmax", 0.5), ("standard", 0.0)):
        _, done = FE.fit_features(df, numeric=["x", "y"], scaler=kind)
        assert {r.scaled[1] for r in done.collect()} == {expected}


def test_strict_assembler_refuses_nulls(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "x double")
    assert FE.assembler(["x"], "v", "skip").transform(df).count() == 1
    with pytest.raises(Exception, match="null"):
        FE.assembler(["x"], "v", "error").transform(df).collect()


def test_scaled_values_lie_between_0_and_1(ready):
    values = ready.select(F.explode(vector_to_array("scaled")))
    low, high = values.agg(F.min("col"), F.max("col")).first()
    assert low >= 0 and high <= 1


def test_more_components_than_features(ready):
    size = FE.vector_size(ready, "scaled")
    model = FE.fit_pca(ready, size + 50)
    shares = FE.explained_variance(ready.sparkSession, model).orderBy("component").collect()
    assert len(shares) == size
    sums = [r.cumulative for r in shares]
    assert sums == sorted(sums) and sums[-1] == pytest.approx(1)


def test_leading_elements_are_the_smaller_pca(ready):
    wide = FE.leading(FE.fit_pca(ready, 8).transform(ready), "pca", "few", 3)
    narrow = FE.fit_pca(ready, 3, out="three").transform(wide)
    for row in narrow.select("few", "three").limit(50).collect():
        assert row.few.toArray() == pytest.approx(row.three.toArray(), abs=1e-9)


def test_layout_makes_fits_independent_of_partitions(spark, small):
    costs = {
        algorithm: {
            round(
                CL.fit(
                    CL.stable_layout(vectors(spark, small).repartition(n), "vec_id", ["pca"], 4),
                    algorithm, 4,
                ).summary.trainingCost, 6,
            )
            for n in (1, 3, 8)
        }
        for algorithm in ("kmeans", "bisecting")
    }
    assert all(len(found) == 1 for found in costs.values())


def test_fit_assigns_to_its_nearest_centre(spark, small):
    laid = CL.stable_layout(vectors(spark, small).drop("prediction"), "vec_id", ["pca"], 4)
    model = CL.fit(laid, "kmeans", 4)
    centres = list(enumerate(model.clusterCenters()))
    own = model.transform(laid).select("vec_id", F.col("prediction").alias("own"))
    both = CL.assign(laid, centres, "pca").join(own, "vec_id")
    assert both.where("own <> prediction").count() == 0
    total = both.agg(F.sum("distance")).first()[0]
    assert total == pytest.approx(model.summary.trainingCost, rel=1e-9)


def _points(spark, rows):
    return spark.createDataFrame(
        [(i, Vectors.dense(v), c) for i, (v, c) in enumerate(rows)], ["id", "pca", "prediction"]
    )


def test_silhouette_edge_cases(spark):
    one = _points(spark, [([0.0, 1.0], 0), ([1.0, 0.0], 0)])
    assert CL.silhouette(one) is None
    apart = _points(spark, [([0.0, 0.0], 0), ([0.0, 0.1], 0), ([9.0, 9.0], 1), ([9.0, 9.1], 1)])
    assert 0.99 < CL.silhouette(apart) <= 1
    lonely = _points(spark, [([0.0, 0.0], 0), ([0.0, 0.1], 0), ([9.0, 9.0], 1)])
    assert CL.silhouette(lonely) == pytest.approx(2 / 3, abs=1e-3)


def test_sweep_lists_failures(spark):
    same = _points(spark, [([1.0, 1.0], 0)] * 5)
    rows = CL.sweep(same, ["kmeans"], [2, 1]).collect()
    assert [r.silhouette for r in rows] == [None, None]
    assert rows[1].error is not None


def test_sweep_on_another_feature_column(spark, small):
    df = vectors(spark, small).withColumnRenamed("pca", "other").drop("prediction")
    rows = CL.sweep(df, ["kmeans"], [2, 3], "other").collect()
    assert all(-1 <= r.silhouette <= 1 and r.error is None for r in rows)


def test_best_setting_takes_the_first_maximum(spark):
    df = spark.createDataFrame(
        [(2, 0.5), (3, 0.7), (4, 0.7), (5, None)], "k int, silhouette double"
    )
    assert CL.best_setting(df).first().asDict() == {"best_k": 3, "best_silhouette": 0.7}
    flags = [r.meets_target for r in CL.verdict(df).orderBy("k").collect()]
    assert flags == [False, True, True, False]


def test_grid_skips_what_cannot_be_fitted(spark, filled):
    _, few = FE.fit_features(filled, numeric=NUMERIC)
    rows = CL.grid({"numeric": lambda: few}, "encounter_id", [2, 10], [2], ["kmeans"], 4).collect()
    assert {(r.k_pca, r.error is None) for r in rows} == {(2, True), (10, False)}


def test_choice_and_retry(ready, monkeypatch):
    kept, tried = CL.choose(ready, "encounter_id", ks=(2, 3), target=-1.0, partitions=4)
    rows = tried.collect()
    assert {r.k_pca for r in rows} == {3} and kept.algorithm == "kmeans"
    assert kept.silhouette == pytest.approx(
        max(r.silhouette for r in rows if r.algorithm == "kmeans"), abs=1e-9
    )
    assert kept.rows.count() == ready.count()

    def scores(first: float, retry: float):
        def fake(df, algorithms, ks, features, label, k_pca):
            score = {3: first, 15: retry}[k_pca]
            found = []
            for a in algorithms:
                for k in ks:
                    own = score + 0.01 * (a == "bisecting")
                    line = (label, k_pca, a, k, own, 1.0, 0.0, None)
                    part = CL.Clustering(a, k, None, df, CL.Scores(own, 1.0, [], None), features)
                    found.append((Row(*CL.SWEEP_COLUMNS)(*line), part))
            return found
        return fake

    for first, retry, expected in [
        (0.7, 0.9, ("kmeans", 3)),      # target met: no second round
        (0.3, 0.5, ("bisecting", 15)),  # second round better
        (0.5, 0.3, ("kmeans", 3)),      # second round worse
    ]:
        monkeypatch.setattr(CL, "fitted_settings", scores(first, retry))
        chosen, tried = CL.choose(ready, "encounter_id", ks=(2,), partitions=4)
        assert (chosen.algorithm, FE.vector_size(chosen.rows, "pca")) == expected
        assert {r.k_pca for r in tried.collect()} == ({3} if first >= 0.6 else {3, 15})


# ---------------------------------------------------------------- names
def test_rank_of_ties(spark):
    df = spark.createDataFrame([(0, 3.0), (1, 3.0), (2, 1.0)], "prediction int, score double")
    ranks = [r.place for r in IN.average_rank(df, "score", "place").orderBy("prediction").collect()]
    assert ranks == [1, 1, 3]


PROFILE = "prediction int, stay double, drugs double, labs double, inpatient double, emergency double"


def test_every_cluster_has_one_name_of_its_own(spark):
    rows = [(i, 4.0, 10.0, 40.0, 0.1, 0.1) for i in range(3)]
    rows += [(3, 9.0, 20.0, 60.0, 2.0, 2.0), (4, 1.0, 1.0, 1.0, 0.0, 0.0)]
    named = IN.named_by_level(spark.createDataFrame(rows, PROFILE))
    names = [r.name for r in named.orderBy("prediction").collect()]
    assert len(set(names)) == 5
    assert names[1] == f"{names[0]} (subgrupo 2)" and names[2] == f"{names[0]} (subgrupo 3)"
    assert names[3].startswith("Pacientes Recurrentes")


def test_all_clusters_alike(spark):
    rows = [(i, 4.0, 10.0, 40.0, 0.1, 0.1) for i in range(2)]
    names = [r.name for r in IN.named_by_level(spark.createDataFrame(rows, PROFILE)).collect()]
    assert all(n.startswith("Pacientes con Ajuste") for n in names)


def test_one_cluster_has_a_name(spark):
    one = spark.createDataFrame([(0, 4.0, 10.0, 40.0, 0.1, 0.1)], PROFILE)
    first, second = IN.recurrence_score("inpatient", "emergency"), IN.intensity_score("stay", "drugs", "labs")
    assert IN.named_by_score(one, first, second).first().name.startswith("Pacientes recurrentes")
    assert IN.named_open_ended(one, first, second).count() == 1
