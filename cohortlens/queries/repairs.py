"""Row and column repair, joins by key, set operations."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from cohortlens.functions import columns as C
from cohortlens.functions import text as X
from cohortlens.functions.fixed import NOISY_TEXT
from cohortlens.operators import profile as P
from cohortlens.operators import rows as R
from cohortlens.operators import text as TX
from cohortlens.queries import registry
from cohortlens.queries import sql as S
from cohortlens.sources.encounters import CATEGORICAL, DIAGNOSES, encounters
from cohortlens.sources.tables import read_table

add = registry.add
PARTS = ["medical_specialty", *DIAGNOSES]
COMPOSED = "concat_ws(' ', medical_specialty, diag_1, diag_2, diag_3)"


def composed(spark, folder):
    return R.compose_text(encounters(spark, folder), PARTS).select("encounter_id", "text")


def noisy_documents(spark, folder):
    documents = read_table(spark, folder, "documents").select("doc_id", "text")
    return R.override(documents, "doc_id", 0, "text", NOISY_TEXT)


# ---------------------------------------------------------------- columns and filters
@add("pf1_compose_text", S.on_encounters(f"SELECT encounter_id, {COMPOSED} AS text FROM encounters"))
def compose_text(spark, folder):
    return composed(spark, folder)


@add("pf2_override_by_key", S.on_noisy("SELECT doc_id, text FROM noisy"))
def override_by_key(spark, folder):
    return noisy_documents(spark, folder)


@add("pf3_point_filter", S.on_noisy("SELECT text FROM noisy WHERE doc_id = 0"))
def point_filter(spark, folder):
    return R.pick(noisy_documents(spark, folder), "doc_id", 0, "text")


@add("pf4_exclude_by_key", "SELECT doc_id, lang, source FROM documents WHERE doc_id <> 0")
def exclude_by_key(spark, folder):
    documents = read_table(spark, folder, "documents").select("doc_id", "lang", "source")
    return R.exclude(documents, "doc_id", 0)


@add(
    "pf5_drop_blank",
    S.on_encounters(
        f"SELECT encounter_id, {COMPOSED} AS text FROM encounters WHERE {COMPOSED} <> ''"
    ),
)
def drop_blank(spark, folder):
    return R.drop_blank(composed(spark, folder), "text")


@add(
    "pf6_drop_marker_words",
    S.on_encounters(
        "SELECT word, count(*) AS n FROM (SELECT unnest(string_split_regex(lower("
        "concat_ws(' ', race, age, insulin)), '\\s+')) AS word FROM encounters) "
        "WHERE word NOT IN ('', '?') GROUP BY word"
    ),
)
def drop_marker_words(spark, folder):
    text = R.compose_text(encounters(spark, folder), ["race", "age", "insulin"])
    words = R.drop_values(TX.explode_words(text, "text"), "word")
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@add(
    "pf7_min_word_length",
    "SELECT word, count(*) AS n FROM (SELECT unnest(string_split_regex(lower(text), '\\s+')) "
    "AS word FROM conversations) WHERE length(word) > 2 GROUP BY word",
)
def min_word_length(spark, folder):
    words = TX.explode_words(read_table(spark, folder, "conversations"), "text")
    return R.longer_than(words, "word", 2).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@add(
    "pf8_membership_filter",
    "SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem WHERE l_returnflag IN ('R', 'A')",
)
def membership_filter(spark, folder):
    items = read_table(spark, folder, "lineitem")
    return R.keep_values(items, "l_returnflag", ["R", "A"]).select(
        "l_orderkey", "l_linenumber", "l_returnflag"
    )


@add("pf9_sql_predicate", "SELECT vec_id, label FROM embeddings WHERE label = 0")
def sql_predicate(spark, folder):
    return R.where_sql(read_table(spark, folder, "embeddings").select("vec_id", "label"), "label = 0")


@add(
    "pf10_regex_predicate",
    S.on_encounters(
        f"SELECT encounter_id, {COMPOSED} AS text FROM encounters "
        f"WHERE regexp_matches({COMPOSED}, '#\\w+')"
    ),
)
def regex_predicate(spark, folder):
    return R.where_regex(composed(spark, folder), "text", r"#\w+")


@add("pf11_drop_columns", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def drop_columns(spark, folder):
    return R.drop_columns(
        read_table(spark, folder, "orders"), ["o_custkey", "o_orderdate", "o_orderpriority"]
    )


@add("pf12_rename_columns", "SELECT vec_id, label AS prediction FROM embeddings")
def rename_columns(spark, folder):
    return R.rename(
        read_table(spark, folder, "embeddings").select("vec_id", "label"), {"label": "prediction"}
    )


@add(
    "pf13_column_list",
    S.on_encounters(
        "SELECT encounter_id, patient_nbr, time_in_hospital, num_medications, num_lab_procedures "
        "FROM encounters"
    ),
)
def column_list(spark, folder):
    rows = encounters(spark, folder)
    return R.project(rows, P.columns_of_kind(rows, "numeric")[:5])


@add(
    "pf14_marker_to_null",
    S.on_encounters("SELECT encounter_id, nullif(race, '?') AS race, nullif(age, '?') AS age FROM encounters"),
)
def marker_to_null(spark, folder):
    return R.markers_to_null(encounters(spark, folder), ["race", "age"]).select(
        "encounter_id", "race", "age"
    )


FILLED = ["age", "race", *PARTS]


@add(
    "pf15_fill_unknown",
    S.on_encounters(
        "SELECT encounter_id, "
        + ", ".join(
            f"CASE WHEN {n} = '?' OR {n} IS NULL THEN 'Unknown' ELSE {n} END AS {n}" for n in FILLED
        )
        + " FROM encounters"
    ),
)
def fill_unknown(spark, folder):
    return R.fill_unknown(encounters(spark, folder), FILLED).select("encounter_id", *FILLED)


@add(
    "pf16_drop_incomplete",
    S.on_encounters(
        "SELECT encounter_id, nullif(age, '?') AS age, diag_1, num_medications FROM encounters "
        "WHERE nullif(age, '?') IS NOT NULL AND diag_1 IS NOT NULL AND num_medications IS NOT NULL"
    ),
)
def drop_incomplete(spark, folder):
    rows = R.markers_to_null(encounters(spark, folder), ["age"])
    names = ["age", "diag_1", "num_medications"]
    return R.drop_incomplete(rows.select("encounter_id", *names), names)


@add(
    "pf17_known_values",
    S.on_encounters("SELECT num_medications FROM encounters WHERE num_medications IS NOT NULL"),
)
def known_values(spark, folder):
    return R.known_values(encounters(spark, folder), "num_medications")


@add(
    "pf18_vector_elements",
    "SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS pc1, CAST(embedding[2] AS DOUBLE) AS pc2, "
    "CAST(embedding[3] AS DOUBLE) AS pc3 FROM embeddings",
)
def vector_elements(spark, folder):
    vectors = read_table(spark, folder, "embeddings").withColumn(
        "vector", array_to_vector("embedding")
    )
    return R.vector_elements(vectors, "vector", ["pc1", "pc2", "pc3"]).select(
        "vec_id", "pc1", "pc2", "pc3"
    )


def sample_sql(key: str, fraction: float, seed: int = 42) -> str:
    digest = f"substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, 8)"
    return f"{digest} < '{C.sample_threshold(fraction)}'"


@add(
    "pf19_hash_sample",
    f"SELECT o_orderkey, o_orderstatus FROM orders WHERE {sample_sql('o_orderkey', 0.3)}",
)
def hash_sample(spark, folder):
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return R.hash_sample(orders, "o_orderkey", 0.3, 42)


@add("pf20_first_rows", "SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 20")
def first_rows(spark, folder):
    return R.first_rows(read_table(spark, folder, "documents").select("doc_id", "text"), "doc_id", 20)


@add("pf21_shorten_text", "SELECT doc_id, substr(text, 1, 100) || '...' AS shown FROM documents")
def shorten_text(spark, folder):
    return read_table(spark, folder, "documents").select(
        "doc_id", C.shortened(F.col("text"), 100).alias("shown")
    )


# ---------------------------------------------------------------- joins and sets
@add(
    "j1_attach_by_key",
    "SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l "
    "ON l.doc_id = d.doc_id",
)
def attach_by_key(spark, folder):
    documents = read_table(spark, folder, "documents").select("doc_id", "lang")
    return R.attach(documents, read_table(spark, folder, "labels"), "doc_id")


@add(
    "j1_replace_by_key",
    "SELECT o.o_orderkey, coalesce(n.status, o.o_orderstatus) AS o_orderstatus FROM orders o "
    "LEFT JOIN (SELECT l_orderkey, max(l_returnflag) AS status FROM lineitem "
    "WHERE l_returnflag = 'R' GROUP BY l_orderkey) n ON n.l_orderkey = o.o_orderkey",
)
def replace_by_key(spark, folder):
    orders = read_table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    returned = (
        read_table(spark, folder, "lineitem")
        .where("l_returnflag = 'R'")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.max("l_returnflag").alias("o_orderstatus"))
    )
    return R.replace_from(orders, returned, "o_orderkey", "o_orderstatus").select(
        "o_orderkey", "o_orderstatus"
    )


@add(
    "so1_append_rows",
    "SELECT c_name AS name, c_acctbal AS balance FROM customer UNION ALL "
    "SELECT s_name, s_acctbal FROM supplier",
)
def append_rows(spark, folder):
    customers = read_table(spark, folder, "customer").select(
        F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")
    )
    suppliers = read_table(spark, folder, "supplier").select("s_name", "s_acctbal")
    return R.append(customers, suppliers)


CLEANED_DOCUMENTS = (
    ", cleaned AS (SELECT doc_id, lower(trim(regexp_replace(regexp_replace(text, "
    "'[^a-zA-Z\\s]', ' ', 'g'), '\\s+', ' ', 'g'))) AS clean FROM documents)"
)


@add(
    "so2_keep_lowest_key",
    S.on_noisy("SELECT min(doc_id) AS doc_id, clean FROM cleaned GROUP BY clean", CLEANED_DOCUMENTS),
)
def keep_lowest_key(spark, folder):
    clean = X.lower_trimmed(X.squeeze_blanks(X.blank_non_letters(F.col("text"))))
    documents = read_table(spark, folder, "documents").select("doc_id", clean.alias("clean"))
    return R.keep_lowest_key(documents, ["clean"], "doc_id")


@add("so3_distinct", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def distinct(spark, folder):
    return R.distinct_values(read_table(spark, folder, "orders"), "o_orderstatus", "o_orderpriority")


# ---------------------------------------------------------------- name lists
NAMES = R.distinct_names(CATEGORICAL, ["insulin", "metformin", "readmitted"])


@add(
    "fe13_distinct_names",
    S.on_encounters(
        "SELECT variable, value, count(*) AS n FROM ("
        + S.unpivoted("encounters", ["race", "gender", "age", "metformin", "insulin", "readmitted"])
        + ") GROUP BY variable, value"
    ),
)
def distinct_names(spark, folder):
    return P.category_counts(encounters(spark, folder), NAMES)

