"""Running totals and quantiles: both paths, hot groups, NULLs, misses."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortlens.operators import profile as P
from cohortlens.operators import ranks as K


@pytest.fixture(scope="module")
def skewed(spark):
    """One group holds most rows and one value of it is very frequent; some keys are NULL."""
    rng = np.random.default_rng(3)
    n = 6000
    frame = pd.DataFrame(
        {
            "g": rng.choice(["hot", "b", "c", None], n, p=[0.7, 0.15, 0.1, 0.05]),
            "x": np.where(rng.random(n) < 0.35, 5.0, rng.normal(5, 3, n)),
            "y": rng.integers(0, 40, n).astype(float),
        }
    )
    frame.loc[rng.random(n) < 0.02, "x"] = np.nan
    return frame, spark.createDataFrame(frame).withColumn("x", F.nanvl("x", F.lit(None)))


def test_both_running_totals_agree(skewed):
    _, df = skewed
    counts = K.value_counts(df, ["x", "y"], ["g"])
    keys = ["g", "variable"]
    whole = K.running_totals(counts, ["value"], "n", keys)
    split = K.running_totals(counts, ["value"], "n", keys, single_task_rows=50)
    assert whole.exceptAll(split).count() == 0 and split.exceptAll(whole).count() == 0
    assert whole.count() == counts.count()


def test_positions_without_group(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"))
    for limit in (10, 10_000):
        done = K.running_totals(df, [F.desc("v")], None, (), limit)
        assert done.where(F.col("running") != 1000 - F.col("v")).count() == 0


def _expected(frame, share):
    return frame.groupby("g", dropna=False)[["x", "y"]].quantile(share)


@pytest.mark.parametrize("single_task_rows", [20, 1_000_000])
def test_quantiles_equal_numpy(skewed, single_task_rows):
    frame, df = skewed
    shares = {"a": 0.1, "m": 0.5, "z": 0.99}
    rows = K.exact_quantiles(
        df, ["x", "y"], shares, ["g"], single_task_rows=single_task_rows
    ).collect()
    assert len(rows) == 8
    for row in rows:
        part = frame[frame.g.isna() if row.g is None else frame.g == row.g][row.variable].dropna()
        for name, share in shares.items():
            assert row[name] == pytest.approx(np.quantile(part, share), abs=1e-12)
        assert row.n_known == len(part)


def test_many_groups_are_joined_without_broadcast(skewed, monkeypatch):
    _, df = skewed
    few = K.exact_quantiles(df, ["x", "y"], P.QUARTILES, ["g"])
    original = K.broadcast_if_small
    monkeypatch.setattr(K, "broadcast_if_small", lambda side: original(side, 1))
    many = K.exact_quantiles(df, ["x", "y"], P.QUARTILES, ["g"])
    assert few.exceptAll(many).count() == 0 and many.count() == few.count()


def test_a_missed_bracket_is_made_good(skewed, monkeypatch):
    frame, df = skewed
    original = K.brackets

    def wrong(*args, **kwargs):
        low = F.transform("low", lambda v: v + 1.0)
        return original(*args, **kwargs).withColumn("low", low).withColumn(
            "high", F.transform("high", lambda v: v + 1.0)
        )

    monkeypatch.setattr(K, "brackets", wrong)
    row = K.exact_quantiles(df, ["x"], {"m": 0.25}).first()
    assert row.m == pytest.approx(frame.x.dropna().quantile(0.25), abs=1e-12)


def test_brackets_pass_on_few_values(spark):
    """On many distinct values only a sliver is counted exactly."""
    df = spark.range(200_000).select((F.col("id") * 1.5).alias("x"))
    bounds = K.brackets(df, ["x"], [0.25, 0.5, 0.75])
    kept = K._bracketed_counts(df, ["x"], bounds, [], 3).count()
    assert kept < 2_000
    row = K.exact_quantiles(df, ["x"], P.QUARTILES).first()
    assert (row.q25, row.q50, row.q75) == tuple(np.quantile(np.arange(200_000) * 1.5, [0.25, 0.5, 0.75]))


def test_a_column_without_values_keeps_its_row(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None)], "x double, y double")
    rows = {r.variable: r for r in P.numeric_summary(df, ["x", "y"]).collect()}
    assert rows["y"].n_known == 0 and rows["y"].q50 is None
    assert (rows["x"].q25, rows["x"].q50, rows["x"].maximum) == (1.0, 1.0, 2.0)


def test_summary_equals_sparks_own(spark, small):
    items = spark.read.parquet(f"{small}/lineitem.parquet")
    own = {r["summary"]: r for r in items.select("l_quantity", "l_tax").summary().collect()}
    for row in P.numeric_summary(items, ["l_quantity", "l_tax"]).collect():
        for label, name in [("mean", "mean"), ("stddev", "deviation"), ("min", "minimum"),
                            ("25%", "q25"), ("50%", "q50"), ("75%", "q75"), ("max", "maximum")]:
            assert row[name] == pytest.approx(float(own[label][row.variable]), rel=1e-12)


def test_box_equals_pandas(skewed):
    frame, df = skewed
    row = P.box_stats(df, ["x"]).first()
    x = frame.x.dropna()
    q25, q75 = x.quantile(0.25), x.quantile(0.75)
    fence = (x >= q25 - 1.5 * (q75 - q25)) & (x <= q75 + 1.5 * (q75 - q25))
    assert (row.low_whisker, row.high_whisker) == (x[fence].min(), x[fence].max())
    assert row.outliers == (~fence).sum()


def test_histogram_equals_numpy(skewed):
    frame, df = skewed
    rows = P.histogram(df, ["x"], 17).orderBy("bin").collect()
    counts, edges = np.histogram(frame.x.dropna(), 17)
    assert [r.n for r in rows] == counts.tolist()
    assert np.allclose([r.lower for r in rows], edges[:-1])
    assert sum(r.percent for r in rows) == pytest.approx(100)


def test_automatic_bins_follow_numpy(skewed):
    frame, df = skewed
    edges = np.histogram_bin_edges(frame.x.dropna(), "auto")
    assert P.automatic_bins(df, ["x"]) == {"x": len(edges) - 1}


def test_constant_column_in_histogram(spark):
    df = spark.createDataFrame([(3.0,)] * 4, "x double")
    rows = P.histogram(df, ["x"], 4).where("n > 0").collect()
    assert [(r.bin, r.n, r.percent) for r in rows] == [(2, 4, 100.0)]


def test_density_equals_its_formula(spark):
    values = np.array([0.0, 1.0, 1.0, 4.0, 9.0])
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    rows = P.density(df, ["x"], points=50).orderBy("point").collect()
    grid, width = np.linspace(0, 9, 50), values.std(ddof=1) * 5 ** (-1 / 5)
    z = (grid[:, None] - values) / width
    expected = np.exp(-0.5 * z**2).sum(1) / (5 * width * np.sqrt(2 * np.pi))
    assert np.allclose([r.density for r in rows], expected)
    far = P.density(df, ["x"], points=50, bandwidth=0.01).collect()
    assert len(far) == 50 and any(r.density == 0 for r in far)


def test_shares_sum_to_hundred_with_null_group(skewed):
    _, df = skewed
    shares = P.category_shares(df, ["g"])
    assert shares.where("value is null").count() == 1
    assert shares.agg(F.sum("percent")).first()[0] == pytest.approx(100)


ODD = "x double, y double, `a.b` double"


def test_profiles_of_odd_columns(spark):
    """No value, one value, infinite values, and a name with a dot."""
    inf = float("inf")
    df = spark.createDataFrame([(1.0, None, 2.0), (2.0, None, 2.0), (inf, None, 2.0)], ODD)
    for bins in (3, "auto"):
        rows = P.histogram(df, ["x", "y", "a.b"], bins).collect()
        assert sum(r.n for r in rows if r.variable == "x") == 2
        assert [(r.bin, r.n, r.percent) for r in rows if r.variable == "y"] == [(None, 0, None)]
        assert sum(r.n for r in rows if r.variable == "a.b") == 3
    assert P.histogram(df, ["y"], 4).count() == 1
    curves = P.density(df, ["x", "y", "a.b"], points=5).collect()
    assert [(r.point, r.density) for r in curves if r.variable == "y"] == [(None, None)]
    assert {(r.x, r.density) for r in curves if r.variable == "a.b"} == {(2.0, None)}
    assert all(r.density > 0 for r in curves if r.variable == "x")
    assert P.density(df, ["x"], points=1).count() == 1


def test_box_keeps_groups_without_values(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", None)], "g string, x double")
    rows = {r.g: r for r in P.box_stats(df, ["x"], ["g"]).collect()}
    assert rows["a"].q50 == 1.5 and rows["a"].outliers == 0
    assert rows["b"].n_known == 0 and rows["b"].q50 is None and rows["b"].low_whisker is None
