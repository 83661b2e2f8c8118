"""Fits made together against Spark's own, one by one."""

import threading

import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F

from cohortlens.operators import clusters as CL
from cohortlens.operators import features as FE
from cohortlens.operators import fits
from cohortlens.operators.scores import model_scores
from cohortlens.sources.scratch import cached, checkpointed


def _laid(spark, partitions, rows=400, width=6):
    near = [F.round(F.rand(7 + i) + (F.col("id") * (i + 3)) % 5, 6) for i in range(width)]
    points = spark.range(rows).select("id", F.array(*near).alias("v")).collect()
    df = spark.createDataFrame([(r.id, Vectors.dense(r.v)) for r in points], ["id", "pca"])
    return CL.stable_layout(df, "id", ["pca"], partitions)


@pytest.mark.parametrize("partitions", [3, 16])
def test_fits_made_together_are_those_of_spark(spark, partitions):
    laid = _laid(spark, partitions)
    found = CL.fitted_settings(laid, ("kmeans", "bisecting"), (2, 3, 5, 6))
    models = {f"{a}_{k}": CL.fit(laid, a, k) for a in ("kmeans", "bisecting") for k in (2, 3, 5, 6)}
    alone = model_scores(laid, models, "pca")
    for line, own in found:
        wanted = alone[f"{line.algorithm}_{line.k}"]
        assert own.scores.sizes == wanted.sizes
        assert line.cost == pytest.approx(wanted.cost, rel=1e-9)
        assert line.silhouette == pytest.approx(wanted.silhouette, rel=1e-9)
        both = models[f"{line.algorithm}_{line.k}"].transform(laid).select("id", F.col("prediction").alias("p"))
        assert both.join(own.rows, "id").where("p <> prediction").count() == 0


def test_passes_do_not_grow_with_the_number_of_fits(spark, monkeypatch):
    """One by one, seven bisecting fits made 17 levels of 20 steps, and k-means its own on top."""
    passes, add_up = [], fits.add_up
    monkeypatch.setattr(fits, "add_up", lambda *a: passes.append(1) or add_up(*a))
    found = CL.fitted_settings(_laid(spark, 4), ("kmeans", "bisecting"), range(2, 9))
    assert all(own is not None for _, own in found)
    assert len(passes) <= 3 * fits.MAX_STEPS + 3


def test_copies_and_missing_vectors(spark):
    same = spark.createDataFrame([(i, Vectors.dense([1.0, 2.0])) for i in range(9)], ["id", "pca"])
    line, own = CL.fitted_settings(same, ["bisecting"], [3])[0]
    assert line.error is None and sum(own.scores.sizes) == 9 and line.silhouette is None
    broken = spark.createDataFrame([(1, Vectors.dense([1.0, float("nan")]))], ["id", "pca"])
    assert all(line.error and own is None for line, own in CL.fitted_settings(broken, ("kmeans", "bisecting"), [2]))
    empty = same.where("id < 0")
    assert all(line.error and own is None for line, own in CL.fitted_settings(empty, ("kmeans", "bisecting"), [2]))


def test_few_rows_are_laid_in_few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 200)
        assert _laid(spark, None).rdd.getNumPartitions() == CL.LAYOUT_PARTITIONS
        assert _laid(spark, 40).rdd.getNumPartitions() == 40
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_starting_centres_hold_their_points(spark):
    """With the solver that Spark chooses for dense vectors every row was made four times."""
    made = spark.sparkContext.accumulator(0)

    def count(vector):
        made.add(1)
        return vector

    laid = _laid(spark, 4)
    fitter = CL.KMeans(featuresCol="pca", k=5, seed=CL.SEED, maxIter=0)
    wanted = [list(c) for c in fitter.fit(laid).clusterCenters()]
    seen = laid.withColumn("pca", F.udf(count, VectorUDT())("pca"))
    assert CL.starting_centres(seen, "kmeans", 5).tolist() == wanted
    assert made.value <= 3 * laid.count()
    with cached(laid) as held:
        held.count()
        assert CL.starting_centres(held, "kmeans", 5).tolist() == wanted


@pytest.mark.parametrize("copies, most", [(0.5, 1), (2.5, 2)])
def test_many_rows_are_started_one_fit_at_a_time(spark, monkeypatch, copies, most):
    """Side by side each start held its own copy of the points, and none stayed in memory."""
    now, seen, find, lock = [], [], CL.starting_centres, threading.Lock()

    def start(*args):
        with lock:
            now.append(1)
            seen.append(len(now))
        try:
            return find(*args)
        finally:
            with lock:
                now.pop()

    laid = _laid(spark, 4)
    wanted = [line[:6] for line, _ in CL.fitted_settings(laid, ["kmeans"], (2, 3, 5))]
    monkeypatch.setattr(CL, "START_BYTES", int(copies * 400 * (8 * 6 + CL.POINT_BYTES)))
    monkeypatch.setattr(CL, "starting_centres", start)
    assert [line[:6] for line, _ in CL.fitted_settings(laid, ["kmeans"], (2, 3, 5))] == wanted
    assert max(seen) <= most


def test_numbers_drawn_are_those_of_spark(spark):
    random = spark._jvm.org.apache.spark.util.random.XORShiftRandom
    for seed in (42, -7, 1 << 40):
        drawn = random(seed)
        wanted = [drawn.nextDouble() for _ in range(150)]
        assert fits.draws(seed, 0, 150).tolist() == wanted
        assert fits.draws(seed, 131, 19).tolist() == wanted[131:]
        assert fits.first_seed(seed) == random(seed).nextInt()


def test_starting_centres_of_all_sizes_are_those_of_spark(spark, monkeypatch):
    monkeypatch.setattr(fits, "BLOCK_ROWS", 64)
    few = [(i, Vectors.dense([i % 3, 1.0, 0.0])) for i in range(50)]
    for laid, sizes in ((_laid(spark, 3), (2, 6)), (CL.stable_layout(spark.createDataFrame(few, ["id", "pca"]), "id", ["pca"], 70), (1, 3))):
        asked, seed = {size: [2, 3, 7] for size in sizes}, fits.first_seed(CL.SEED)
        with fits.points_of(laid, "pca", CL.SEED) as points:
            found = fits.starting_centres_together(points.blocks, points._first(seed), asked, seed, points._settle)
        for size in sizes:
            reduced = FE.leading(laid, "pca", "x", size).select("x")
            for k in asked[size]:
                assert found[size, k].tolist() == CL.starting_centres(reduced, "kmeans", k, "x").tolist()


def test_a_grid_makes_the_fits_of_all_sizes_together(spark, monkeypatch):
    """Each number of components was a sweep: its points were held, started and passed over again."""
    laid = _laid(spark, 4)
    passes, add_up = [], fits.add_up
    monkeypatch.setattr(fits, "add_up", lambda *a: passes.append(1) or add_up(*a))
    monkeypatch.setattr(CL, "stable_layout", lambda df, *a: checkpointed(df.select("id", "_components")))
    found = CL.grid({"all": lambda: laid}, "id", [2, 4, 5], range(2, 6), partitions=4, scaled="pca").collect()
    assert len(found) == 24 and len(passes) <= 3 * fits.MAX_STEPS + 6
    turned = FE.fit_pca(laid, 5, "pca", "_components").transform(laid)
    for size in (2, 4, 5):
        alone = CL.sweep(FE.leading(turned, "_components", "x", size), ks=range(2, 6), features="x").collect()
        own = [line for line in found if line.k_pca == size]
        for a, b in zip(own, alone, strict=True):
            assert (a.algorithm, a.k, a.error) == (b.algorithm, b.k, None)
            assert a.cost == pytest.approx(b.cost, rel=1e-9) and a.silhouette == pytest.approx(b.silhouette, rel=1e-9)


def test_scores_far_from_the_origin(spark):
    far = [(i, Vectors.dense([1e6 + i % 2 * 8 + i / 100, -1e6 + i % 5])) for i in range(40)]
    laid = CL.stable_layout(spark.createDataFrame(far, ["id", "pca"]), "id", ["pca"], 2)
    near = [(i, Vectors.dense([v[0] - 1e6, v[1] + 1e6])) for i, v in far]
    moved = CL.stable_layout(spark.createDataFrame(near, ["id", "pca"]), "id", ["pca"], 2)
    (a, _), (b, _) = (CL.fitted_settings(rows, ["kmeans"], [2])[0] for rows in (laid, moved))
    assert a.cost == pytest.approx(b.cost, rel=1e-8) and a.silhouette == pytest.approx(b.silhouette, rel=1e-8)


def test_blocks_tell_where_their_rows_lie(spark, monkeypatch):
    """They are views on the bytes that are held; each pass made copies of them before."""
    monkeypatch.setattr(fits, "BLOCK_ROWS", 7)
    laid = _laid(spark, 20)
    wanted = {}
    for part, row in laid.select(F.spark_partition_id(), "pca").collect():
        wanted.setdefault(part, []).append(row.toArray().tolist())
    with fits.blocks_of(laid, "pca") as blocks:
        assert blocks.getNumPartitions() < 20
        found, copied = blocks.collect(), blocks.map(lambda b: b.points.flags.owndata).collect()
    for part, before, points in found:
        assert points.tolist() == wanted[part][before : before + 7]
    assert sum(len(b.points) for b in found) == 400 and not any(copied)
