"""Physical plans: what must and must not appear in them."""

import pytest
from pyspark.sql import functions as F

from cohortlens.operators import clusters as CL
from cohortlens.operators import profile as P
from cohortlens.operators import rows as R
from cohortlens.operators import text as TX
from cohortlens.queries import load
from cohortlens.sources.encounters import encounters
from cohortlens.sources.tables import broadcast_if_small, read_table, to_driver

# Queries whose building already runs long fits.
OWN = load().queries
FITTED = {n for n in OWN if n.startswith("cl")} | {
    "in4_named_report_fitted", "ag24_model_comparison"
}
PLANNED = sorted(set(OWN) - FITTED)


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.mark.parametrize("name", PLANNED)
def test_no_pairing_of_all_rows_and_no_python(name, spark, small):
    text = plan(OWN[name](spark, small))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    if name != "u3_custom_rule":
        assert "EvalPython" not in text and "MapInPandas" not in text


def test_unused_columns_are_left_out_before_writing(spark, small):
    from cohortlens.queries.features import filled

    assert filled(spark, small, ["race", "age"]).columns == ["encounter_id", "race", "age"]


def test_unused_item_columns_skip_the_item_join(spark, small):
    text = plan(encounters(spark, small).select("race", "gender"))
    assert "lineitem" not in text and "part.parquet" not in text


def test_columns_and_filters_reach_the_scan(spark, small):
    items = read_table(spark, small, "lineitem")
    text = plan(R.keep_values(items, "l_returnflag", ["R"]).select("l_orderkey"))
    assert "ReadSchema: struct<l_orderkey:bigint,l_returnflag:string>" in text
    assert "In(l_returnflag, [R])" in text or "EqualTo(l_returnflag,R)" in text


def test_copies_are_dropped_before_the_shuffle(spark, small):
    orders = read_table(spark, small, "orders")
    text = plan(R.keep_lowest_key(orders, ["o_orderstatus"], "o_orderkey"))
    assert "partial_min_by" in text and "Window" not in text


def test_cleaning_is_computed_once(spark):
    df = spark.createDataFrame([(1, "x")], "id int, text string")
    text = plan(TX.clean_text(df, "text", "clean", drop_blank=True))
    # In the tree and the details of one projection: not in a filter as well.
    assert "Filter" not in text


def test_histogram_does_not_shuffle_values(spark, small):
    items = read_table(spark, small, "lineitem")
    text = plan(P.histogram(items, ["l_quantity"], 10))
    assert "partial_count" in text


def test_side_is_broadcast_only_when_small(spark):
    few = spark.range(10).toDF("k")
    wide = spark.range(1000).toDF("k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        small_join = plan(wide.join(broadcast_if_small(few, 100), "k"))
        large_join = plan(wide.join(broadcast_if_small(few, 5), "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in small_join and "SortMergeJoin" in large_join


def test_driver_refuses_large_results(spark):
    with pytest.raises(ValueError, match="more than 5 rows"):
        to_driver(spark.range(6), 5)
    assert len(to_driver(spark.range(5), 5)) == 5


def test_hot_key_join_and_cost_path_without_broadcast(spark, small, monkeypatch):
    """The join path taken beyond the broadcast bound gives the same cost."""
    from cohortlens.queries.clusterings import vectors

    df = vectors(spark, small)
    expected = CL.cost(df, "pca").first().cost
    monkeypatch.setattr(CL, "MAX_BROADCAST_CLUSTERS", 2)
    assert CL.cost(df, "pca").first().cost == pytest.approx(expected, rel=1e-12)


def test_hash_sample_is_stable(spark, small):
    orders = read_table(spark, small, "orders")
    a = {r[0] for r in R.hash_sample(orders, "o_orderkey", 0.3).select("o_orderkey").collect()}
    b = R.hash_sample(orders.repartition(7), "o_orderkey", 0.3).select("o_orderkey").collect()
    assert a == {r[0] for r in b}
    assert 0.2 < len(a) / orders.count() < 0.4
    assert R.hash_sample(orders, "o_orderkey", 1.0).count() == orders.count()


def test_replace_and_attach_keep_all_rows(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    right = spark.createDataFrame([(1, "z")], "k int, v string")
    done = R.replace_from(left, right, "k", "v")
    assert sorted(r.v for r in done.collect()) == ["b", "c", "z"]
    assert done.where(F.col("k").isNull()).count() == 1


def test_intermediates_can_be_removed(spark, monkeypatch, tmp_path):
    from cohortlens.sources import scratch

    monkeypatch.setitem(scratch._local_roots, spark.sparkContext.applicationId, str(tmp_path / "own"))
    assert scratch.written(spark.range(3)).count() == 3
    assert scratch.remove_written(spark) and not (tmp_path / "own").exists()
    assert not scratch.remove_written(spark)
