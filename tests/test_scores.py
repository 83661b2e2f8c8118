"""Scores of models against the evaluator, distances row by row, and edge cases."""

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import Window
from pyspark.sql import functions as F

from cohortlens.operators import clusters as CL
from cohortlens.operators.scores import model_scores
from cohortlens.queries.clusterings import vectors


@pytest.mark.parametrize("partitions", [1, 3, 16, 64])
def test_cost_belongs_to_the_final_centres(spark, small, partitions):
    laid = CL.stable_layout(vectors(spark, small).drop("prediction"), "vec_id", ["pca"], partitions)
    models = {f"{a}_{k}": CL.fit(laid, a, k) for a in ("kmeans", "bisecting") for k in (2, 5)}
    # So few steps that the last one still moves the centres.
    models["short"] = CL.KMeans(featuresCol="pca", k=6, seed=1, maxIter=2).fit(laid)
    found = model_scores(laid, models, "pca")
    for name, model in models.items():
        rows = model.transform(laid)
        own = dict(enumerate(model.clusterCenters()))
        lines = [(r.pca.toArray(), r.prediction) for r in rows.select("pca", "prediction").collect()]
        assert found[name].cost == pytest.approx(sum(float(((x - own[c]) ** 2).sum()) for x, c in lines), rel=1e-9)
        assert found[name].sizes == [sum(c == i for _, c in lines) for i in own]
        assert found[name].silhouette == pytest.approx(CL.silhouette(rows), rel=1e-9)
    assert found["short"].converged is False
    assert found["short"].cost != pytest.approx(models["short"].summary.trainingCost, rel=1e-9)


def test_one_cluster_and_lonely_rows(spark):
    points = [[0.0, 0.0], [0.0, 0.1], [9.0, 9.0]]
    df = spark.createDataFrame([(i, Vectors.dense(v)) for i, v in enumerate(points)], ["id", "pca"])
    same = df.withColumn("pca", F.first("pca").over(Window.partitionBy(F.lit(1)).orderBy("id")))
    models = {"one": CL.fit(same, "kmeans", 2), "two": CL.fit(df, "kmeans", 2)}
    alone = model_scores(same, {"one": models["one"]}, "pca")["one"]
    assert alone.silhouette is None and alone.sizes == [3] and alone.cost == 0
    found = model_scores(df.repartition(5), models, "pca")
    assert found["two"].silhouette == pytest.approx(2 / 3, abs=1e-3)
    assert sorted(found["two"].sizes) == [1, 2] and found["two"].cost == pytest.approx(0.005)
    assert model_scores(df, {}, "pca") == {}


def test_sweep_lists_failed_fits(spark):
    df = spark.createDataFrame([(i, Vectors.dense([float(i), 1.0])) for i in range(9)], ["id", "pca"])
    lines = CL.sweep(df, ["kmeans"], [1, 2, 3]).orderBy("k").collect()
    assert lines[0].error and lines[0].cost is None and lines[0].silhouette is None
    assert [r.error for r in lines[1:]] == [None, None] and lines[1].cost > lines[2].cost


def test_chosen_model_is_one_of_the_fits_tried(spark, small):
    laid = vectors(spark, small).withColumnRenamed("pca", "scaled").select("vec_id", "scaled")
    chosen, tried = CL.choose(laid, "vec_id", k_pca=3, ks=(2, 3), target=-1.0, partitions=3)
    line = tried.where((F.col("algorithm") == chosen.algorithm) & (F.col("k") == chosen.k)).first()
    assert line.silhouette == chosen.silhouette and line.cost == chosen.scores.cost
    assert chosen.rows.count() == sum(chosen.scores.sizes)
