"""What the clusterings start from: facts per order, and vectors that several scalers share."""

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cohortlens.operators import features as FE
from cohortlens.queries import clusterings as Q
from cohortlens.sources.encounters import item_facts

ITEM = "l_orderkey long, l_partkey long, l_quantity double, l_tax double, l_returnflag string, l_linestatus string"
PART = "p_partkey long, p_brand string, p_type string, p_name string, p_size int"


def test_brands_are_counted_in_one_shuffle(spark, tmp_path):
    """Counted as distinct values, line items were shuffled by order and brand, then by order."""
    parts = [(1, "a", "t", "n", 1), (2, "b", "t", "n", 2), (3, None, "t", "n", 3), (4, "a", "u", "m", 4), (4, "c", "u", "m", None)]
    items = [(o, p, 1.0, 0.05, "R", "F") for o, p in [(1, 1), (1, 1), (1, 2), (1, 4), (2, 3), (3, 3), (3, 2), (None, 1), (4, None), (5, 9)]]
    spark.createDataFrame(parts, PART).write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame(items, ITEM).write.parquet(f"{tmp_path}/lineitem.parquet")
    facts = item_facts(spark, str(tmp_path))
    assert dict(facts.dtypes)["number_diagnoses"] == "bigint"
    found = {r.l_orderkey: (r.number_diagnoses, r.time_in_hospital) for r in facts.collect()}
    assert found == {None: (1, 1), 1: (3, 5), 2: (0, 1), 3: (1, 2)}
    plan = facts._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("hashpartitioning(l_orderkey") == 1
    assert "p_brand" not in "".join(line for line in plan.splitlines() if "hashpartitioning" in line)


def test_sets_that_differ_in_the_scaler_share_their_vectors(spark, monkeypatch):
    """Each set indexed and assembled the rows anew, in every pass over them."""
    rows = spark.createDataFrame(
        [(i, "xyz"[i % 3], None if i == 5 else f"c{i % 4}", float(i) if i != 7 else None) for i in range(40)],
        "encounter_id long, one string, code string, n double",
    )
    for name, value in (("CATEGORICAL", ["one"]), ("CODES", ["code"]), ("NUMERIC", ["n"])):
        monkeypatch.setattr(Q, name, value)
    monkeypatch.setattr(Q, "prepared", lambda *_: rows)
    made, fit = [], FE.fit_features
    monkeypatch.setattr(FE, "fit_features", lambda *a, **k: made.append(1) or fit(*a, **k))
    sets = Q._feature_sets(spark, "", "minmax", "standard")
    found = {name: build() for name, build in sets.items()}
    assert len(made) == 1
    for kind, df in found.items():
        _, alone = fit(rows, ["one"], ["code"], ["n"], kind)
        assert FE.vector_size(df, "scaled") == FE.vector_size(alone, "scaled")
        both = df.join(alone.select("encounter_id", F.col("scaled").alias("own")), "encounter_id")
        pairs = both.select(vector_to_array("scaled").alias("a"), vector_to_array("own").alias("b")).collect()
        assert len(pairs) == 39 == df.count()
        assert all(list(p.a) == pytest.approx(list(p.b), rel=1e-12) for p in pairs)
