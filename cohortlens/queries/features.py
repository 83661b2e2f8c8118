"""Indexing, encoding, assembling, scaling and reduction."""

from __future__ import annotations

from pyspark.ml.feature import PCA
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortlens.operators import features as FE
from cohortlens.operators import profile as P
from cohortlens.operators import rows as R
from cohortlens.queries import registry
from cohortlens.queries import sql as S
from cohortlens.sources.encounters import CATEGORICAL, DIAGNOSES, NUMERIC, encounters
from cohortlens.sources.scratch import written
from cohortlens.sources.tables import read_table

add = registry.add
CODED = [*CATEGORICAL, "medical_specialty", *DIAGNOSES]
PRICES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def filled(spark, folder, names):
    """The named columns of the repaired encounters as a table: the estimators read them
    several times. Columns nobody asked for, and the joins behind them, are left out first."""
    rows = encounters(spark, folder).select("encounter_id", *names)
    return written(R.fill_unknown(rows, [n for n in CODED if n in names]), "filled")


def measured(spark, folder):
    return written(encounters(spark, folder).select("encounter_id", *NUMERIC), "measured")


def _filled_sql() -> str:
    fills = ", ".join(
        f"CASE WHEN {n} = '?' OR {n} IS NULL THEN 'Unknown' ELSE {n} END AS {n}" for n in CODED
    )
    return f", filled AS (SELECT * REPLACE ({fills}) FROM encounters)"


def _labels_sql(names: list[str]) -> str:
    return (
        ", labels_of AS (SELECT variable, value, count(*) AS n, row_number() OVER "
        "(PARTITION BY variable ORDER BY count(*) DESC, value) - 1 AS index FROM ("
        + S.unpivoted("filled", names)
        + ") GROUP BY variable, value)"
    )


def _index_sql(names: list[str], out: str, cast: str) -> str:
    picks = ", ".join(f"CAST(l{i}.index AS {cast}) AS {n}{out}" for i, n in enumerate(names))
    joins = " ".join(
        f"JOIN labels_of l{i} ON l{i}.variable = '{n}' AND l{i}.value = f.{n}"
        for i, n in enumerate(names)
    )
    return S.on_encounters(
        f"SELECT f.encounter_id, {picks} FROM filled f {joins}", _filled_sql() + _labels_sql(names)
    )


def norm(vector: str) -> Column:
    squares = F.transform(vector_to_array(F.col(vector)), lambda v: v * v)
    return F.round(F.aggregate(squares, F.lit(0.0), lambda a, b: a + b), 8)


# ---------------------------------------------------------------- categories
@add(
    "fe1_label_index",
    S.on_encounters(
        "SELECT variable, value, n, index FROM labels_of", _filled_sql() + _labels_sql(CODED)
    ),
)
def label_index(spark, folder):
    return FE.label_index(filled(spark, folder, CODED), CODED)


@add("fe1_string_indexer", _index_sql(["race", "gender", "age"], "_idx", "DOUBLE"))
def string_indexer(spark, folder):
    _, ready = FE.fit_features(
        filled(spark, folder, ["race", "gender", "age"]), index_only=["race", "gender", "age"],
        scaler=None,
    )
    return ready.select("encounter_id", "race_idx", "gender_idx", "age_idx")


@add("fe2_one_hot", _index_sql(["race", "gender", "age"], "_slot", "BIGINT"))
def one_hot(spark, folder):
    names = ["race", "gender", "age"]
    _, ready = FE.fit_features(filled(spark, folder, names), names, scaler=None)
    slots = {
        f"{n}_slot": F.array_position(vector_to_array(F.col(f"{n}_ohe")), F.lit(1.0)) - 1
        for n in ("race", "gender", "age")
    }
    return ready.withColumns(slots).select("encounter_id", *slots)


@add("fe3_index_only", _index_sql(DIAGNOSES, "_idx", "DOUBLE"))
def index_only(spark, folder):
    _, ready = FE.fit_features(filled(spark, folder, DIAGNOSES), index_only=DIAGNOSES, scaler=None)
    return ready.select("encounter_id", *[f"{n}_idx" for n in DIAGNOSES])


@add("fe3_index_by_join", _index_sql(DIAGNOSES, "_idx", "DOUBLE"))
def index_by_join(spark, folder):
    return FE.index_by_join(filled(spark, folder, DIAGNOSES), DIAGNOSES).select(
        "encounter_id", *[f"{n}_idx" for n in DIAGNOSES]
    )


# ---------------------------------------------------------------- vectors
KNOWN = " AND ".join(f"{n} IS NOT NULL" for n in NUMERIC)


def _as_double(names: list[str]) -> str:
    return ", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in names)


def elements(df, vector: str, key: list[str], names: list[str], digits: int | None = None):
    """Vector elements as columns; columns of the same names are replaced."""
    values = {n: vector_to_array(F.col(vector))[i] for i, n in enumerate(names)}
    if digits is not None:
        values = {n: F.round(v, digits) for n, v in values.items()}
    return df.select(*key, *[v.alias(n) for n, v in values.items()])


@add(
    "fe4_assemble_skip",
    S.on_encounters(f"SELECT encounter_id, {_as_double(NUMERIC)} FROM encounters WHERE {KNOWN}"),
)
def assemble_skip(spark, folder):
    rows = FE.assembler(NUMERIC, "v", "skip").transform(encounters(spark, folder))
    return elements(rows, "v", ["encounter_id"], NUMERIC)


@add(
    "fe5_assemble_strict",
    S.on_encounters(f"SELECT encounter_id, {_as_double(NUMERIC)} FROM encounters WHERE {KNOWN}"),
)
def assemble_strict(spark, folder):
    complete = R.drop_incomplete(encounters(spark, folder), NUMERIC)
    rows = FE.assembler(NUMERIC, "v", "error").transform(complete)
    return elements(rows, "v", ["encounter_id"], NUMERIC)


def _minmax_sql(n: str, digits: int = 8) -> str:
    low, high = f"min({n}) OVER ()", f"max({n}) OVER ()"
    return (
        f"round(CASE WHEN {high} = {low} THEN 0.5 ELSE CAST({n} - {low} AS DOUBLE) / ({high} - {low}) "
        f"END, {digits}) AS {n}"
    )


@add(
    "fe6_numeric_only",
    S.on_encounters(
        f"SELECT encounter_id, {', '.join(_minmax_sql(n) for n in NUMERIC)} "
        f"FROM encounters WHERE {KNOWN}"
    ),
)
def numeric_only(spark, folder):
    _, ready = FE.fit_features(measured(spark, folder), numeric=NUMERIC)
    return elements(ready, "scaled", ["encounter_id"], NUMERIC, 8)


LINE = ["l_orderkey", "l_linenumber"]


@add(
    "fe7_minmax_scale",
    f"SELECT l_orderkey, l_linenumber, {', '.join(_minmax_sql(n) for n in PRICES)} FROM lineitem",
)
def minmax_scale(spark, folder):
    items = read_table(spark, folder, "lineitem").select(*LINE, *PRICES)
    _, ready = FE.fit_features(items, numeric=PRICES, scaler="minmax")
    return elements(ready, "scaled", LINE, PRICES, 8)


@add(
    "fe8_standard_scale",
    "SELECT l_orderkey, l_linenumber, "
    + ", ".join(f"round({n} / stddev_samp({n}) OVER (), 8) AS {n}" for n in PRICES)
    + " FROM lineitem",
)
def standard_scale(spark, folder):
    items = read_table(spark, folder, "lineitem").select(*LINE, *PRICES)
    _, ready = FE.fit_features(items, numeric=PRICES, scaler="standard")
    return elements(ready, "scaled", LINE, PRICES, 8)


# ---------------------------------------------------------------- reduction
SCALED_SQL = (
    f", scaled AS (SELECT encounter_id, {', '.join(_minmax_sql(n, 15) for n in NUMERIC)} "
    f"FROM encounters WHERE {KNOWN})"
)
SQUARES = " + ".join(f"{n} * {n}" for n in NUMERIC)


@add("fe9_pca_projection")
def pca_projection(spark, folder):
    _, ready = FE.fit_features(measured(spark, folder), numeric=NUMERIC)
    model = FE.fit_pca(ready, 3)
    return elements(model.transform(ready), "pca", ["encounter_id"], ["pc1", "pc2", "pc3"], 6)


@add(
    "fe9_pca_keeps_length",
    S.on_encounters(
        f"SELECT encounter_id, round({SQUARES}, 8) AS squared_length FROM scaled", SCALED_SQL
    ),
)
def pca_keeps_length(spark, folder):
    """All components together only turn the vectors, so lengths must stay."""
    _, ready = FE.fit_features(measured(spark, folder), numeric=NUMERIC)
    turned = FE.fit_pca(ready, len(NUMERIC)).transform(ready)
    return turned.select("encounter_id", norm("pca").alias("squared_length"))


@add("fe10_explained_variance")
def explained_variance(spark, folder):
    rows = filled(spark, folder, [*CATEGORICAL, *DIAGNOSES, *NUMERIC])
    _, ready = FE.fit_features(rows, CATEGORICAL, DIAGNOSES, NUMERIC)
    return FE.explained_variance(spark, FE.fit_pca(ready, 30), 30)


@add("fe10_explained_variance_standard")
def explained_variance_standard(spark, folder):
    """The same shares after scaling by deviations instead of extremes."""
    rows = filled(spark, folder, [*CATEGORICAL, *DIAGNOSES, *NUMERIC])
    _, ready = FE.fit_features(rows, CATEGORICAL, DIAGNOSES, NUMERIC, "standard")
    return FE.explained_variance(spark, FE.fit_pca(ready, 30), 30)


STANDARD_SQL = (
    f", standard AS (SELECT encounter_id, {', '.join(f'{n} / stddev_samp({n}) OVER () AS {n}' for n in NUMERIC)} "
    f"FROM encounters WHERE {KNOWN})"
)


def _covariance_sql(table: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS scaler, CAST({i} AS INTEGER) AS a, CAST({j} AS INTEGER) AS b, "
        f"round(covar_samp({x}, {y}), 8) AS covariance FROM {table}"
        for i, x in enumerate(NUMERIC, start=1)
        for j, y in enumerate(NUMERIC, start=1)
    )


@add(
    "fe9_covariances",
    S.on_encounters(f"{_covariance_sql('scaled')} UNION ALL {_covariance_sql('standard')}", SCALED_SQL + STANDARD_SQL),
)
def covariances(spark, folder):
    """The matrices whose components are taken, for both scalers."""
    rows = measured(spark, folder)
    found = []
    for scaler, kind in (("scaled", "minmax"), ("standard", "standard")):
        _, ready = FE.fit_features(rows, numeric=NUMERIC, scaler=kind)
        cells = FE.covariance(ready, "scaled")
        found.append(cells.select(F.lit(scaler).alias("scaler"), "a", "b", F.round("covariance", 8).alias("covariance")))
    return found[0].union(found[1])


def _component_facts(rows, scaler: str, categorical: list[str], k: int):
    _, ready = FE.fit_features(rows, categorical, numeric=NUMERIC, scaler=scaler)
    facts = FE.component_facts(ready, FE.fit_pca(ready, k))
    return facts.select(F.lit(scaler).alias("scaler"), "*")


def _component_facts_sql(components: str) -> str:
    return (
        f"SELECT unnest(['minmax', 'standard']) AS scaler, CAST({components} AS INTEGER) AS components, "
        "true AS orthonormal, true AS diagonal, true AS falling, true AS shares_are_variances"
    )


@add("fe9_pca_projection_facts", _component_facts_sql("3"))
def pca_projection_facts(spark, folder):
    """The leading three components of the numeric columns, for both scalers."""
    rows = measured(spark, folder)
    found = [_component_facts(rows, scaler, [], 3) for scaler in ("minmax", "standard")]
    return found[0].union(found[1])


@add("fe10_explained_variance_facts", _component_facts_sql("8"))
def explained_variance_facts(spark, folder):
    """Eight components of one-hot slots and numeric columns together, for both scalers."""
    rows = filled(spark, folder, [*CATEGORICAL, *NUMERIC])
    found = [_component_facts(rows, scaler, CATEGORICAL, 8) for scaler in ("minmax", "standard")]
    return found[0].union(found[1])


@add(
    "fe10_variance_concentration",
    S.on_encounters(
        f"SELECT CAST({len(NUMERIC)} AS BIGINT) AS components, round((SELECT sum(c * c) FROM ("
        + " UNION ALL ".join(
            f"SELECT covar_samp({a}, {b}) AS c FROM scaled" for a in NUMERIC for b in NUMERIC
        )
        + ")) / pow((SELECT "
        + " + ".join(f"var_samp({n})" for n in NUMERIC)
        + " FROM scaled), 2), 8) AS concentration",
        SCALED_SQL,
    ),
)
def variance_concentration(spark, folder):
    """Sum of squared shares: it equals that of the covariances over the squared trace."""
    _, ready = FE.fit_features(measured(spark, folder), numeric=NUMERIC)
    shares = FE.explained_variance(spark, FE.fit_pca(ready, len(NUMERIC)))
    return shares.agg(
        F.count(F.lit(1)).alias("components"),
        F.round(F.sum(F.col("share") * F.col("share")), 8).alias("concentration"),
    )


# The complete chain: one-hot slots are 0 or 1 and survive min-max scaling as they are.
CHAIN_SQL = S.on_encounters(
    f"SELECT encounter_id, round({len(CATEGORICAL)} + {SQUARES}, 8) AS squared_length FROM scaled",
    SCALED_SQL,
)


@add("fe11_fit_transform_chain", CHAIN_SQL)
def fit_transform_chain(spark, folder):
    rows = filled(spark, folder, [*CATEGORICAL, *NUMERIC])
    _, ready = FE.fit_features(rows, CATEGORICAL, (), NUMERIC)
    return ready.select("encounter_id", norm("scaled").alias("squared_length"))


@add("fe12_extend_fitted_chain", CHAIN_SQL)
def extend_fitted_chain(spark, folder):
    rows = filled(spark, folder, [*CATEGORICAL, *NUMERIC])
    model, ready = FE.fit_features(rows, CATEGORICAL, (), NUMERIC)
    size = FE.vector_size(ready, "scaled")
    longer = FE.with_stage(model, PCA(k=size, inputCol="scaled", outputCol="pca"), rows)
    return longer.transform(rows).select("encounter_id", norm("pca").alias("squared_length"))


# ---------------------------------------------------------------- running totals
SHARES_SQL = (
    "shares AS (SELECT row_number() OVER (ORDER BY count(*) DESC, p_type) AS component, "
    "p_type, count(*) * 1.0 / (SELECT count(*) FROM part) AS share FROM part GROUP BY p_type)"
)


def _type_shares(spark, folder):
    """Shares of part types, largest first, played as components; types are few."""
    shares = P.category_shares(read_table(spark, folder, "part"), ["p_type"])
    ranked = FE.label_index(read_table(spark, folder, "part"), ["p_type"])
    return shares.join(ranked.select("value", "index"), "value").select(
        (F.col("index") + 1).alias("component"),
        F.col("value").alias("p_type"),
        (F.col("percent") / 100).alias("share"),
    )


@add(
    "w2_cumulative_share",
    f"WITH {SHARES_SQL} SELECT component, p_type, round(share, 8) AS share, "
    "round(sum(share) OVER (ORDER BY component), 8) AS cumulative FROM shares",
)
def cumulative_share(spark, folder):
    done = FE.cumulative(_type_shares(spark, folder))
    return done.withColumns(
        {"share": F.round("share", 8), "cumulative": F.round("cumulative", 8)}
    )


@add(
    "w3_components_for_target",
    f"WITH {SHARES_SQL}, summed AS (SELECT component, sum(share) OVER (ORDER BY component) AS c "
    "FROM shares) SELECT coalesce(min(CASE WHEN c >= 0.83 THEN component END), max(component)) "
    "AS components FROM summed",
)
def components_for_target(spark, folder):
    return FE.components_for(FE.cumulative(_type_shares(spark, folder)), 0.83)
