"""Text cleaning, pattern reports, words and spelling."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortlens.functions import text as X
from cohortlens.functions.fixed import CONTRACTIONS, CONTRACTIONS_SHORT, EXTRA_STOP_WORDS, PATTERNS, TYPOS
from cohortlens.operators import spelling as SP
from cohortlens.operators import text as TX
from cohortlens.plans.analysis import found_corrections
from cohortlens.queries import registry
from cohortlens.queries import sql as S
from cohortlens.queries.repairs import noisy_documents
from cohortlens.queries.stopwords import ENGLISH
from cohortlens.sources.tables import read_table

add = registry.add


# ---------------------------------------------------------------- the steps in SQL
def gone(text: str, pattern: str, by: str = "") -> str:
    return f"regexp_replace({text}, {S.quoted(pattern)}, '{by}', 'g')"


def contractions_sql(text: str, rules: list[tuple[str, str]] = CONTRACTIONS) -> str:
    for short, full in rules:
        text = f"replace({text}, {S.quoted(short)}, '{full}')"
    return text


def typos_sql(text: str) -> str:
    for wrong, right in TYPOS.items():
        text = gone(text, rf"\b{wrong}\b", right)
    return text


STEPS_SQL = {
    "mentions": lambda t: gone(t, PATTERNS["mentions"]),
    "hashtags": lambda t: gone(t, PATTERNS["hashtags"]),
    "html_tags": lambda t: gone(t, PATTERNS["html_tags"]),
    "urls": lambda t: gone(t, PATTERNS["urls"]),
    "contractions": contractions_sql,
    "typos": typos_sql,
    "non_letters": lambda t: gone(t, PATTERNS["non_letters"], " "),
    "blanks": lambda t: gone(t, r"\s+", " "),
    "lower_case": lambda t: f"lower(trim({t}))",
}
# Each step as its own common table, so that no expression grows with the chain.
STEP_TABLES = "".join(
    f", s{i} AS (SELECT doc_id, {step('text')} AS text FROM {'noisy' if i == 1 else f's{i - 1}'})"
    for i, step in enumerate(STEPS_SQL.values(), start=1)
)
FINAL = f"s{len(STEPS_SQL)}"


def _step_query(name: str, step: str, function: X.Step, table: str = "noisy") -> None:
    @add(name, S.on_noisy(f"SELECT doc_id, {STEPS_SQL[step]('text')} AS text FROM {table}"))
    def one_step(spark, folder):
        return noisy_documents(spark, folder).withColumn("text", function(F.col("text")))


_step_query("tx1_strip_mentions", "mentions", X.strip_mentions)
_step_query("tx2_strip_hashtags", "hashtags", X.strip_hashtags)
_step_query("tx5_expand_contractions", "contractions", X.expand_contractions)
_step_query("tx6_correct_typos", "typos", X.correct_words)
_step_query("tx7_blank_non_letters", "non_letters", X.blank_non_letters)
_step_query("tx8_squeeze_blanks", "blanks", X.squeeze_blanks)
_step_query("tx9_lower_trim", "lower_case", X.lower_trimmed)


@add(
    "tx5_short_rules",
    S.on_noisy(f"SELECT doc_id, {contractions_sql('text', CONTRACTIONS_SHORT)} AS text FROM noisy"),
)
def short_rules(spark, folder):
    expanded = X.expand_contractions(F.col("text"), CONTRACTIONS_SHORT)
    return noisy_documents(spark, folder).withColumn("text", expanded)


def _anywhere_sql(text: str) -> str:
    for wrong, right in TYPOS.items():
        text = f"replace({text}, '{wrong}', '{right}')"
    return text


@add(
    "tx6_correct_anywhere",
    S.on_noisy(f"SELECT doc_id, {_anywhere_sql('text')} AS text FROM noisy"),
)
def correct_anywhere(spark, folder):
    corrected = X.correct_words(F.col("text"), whole_word=False)
    return noisy_documents(spark, folder).withColumn("text", corrected)


@add(
    "tx3_strip_tags",
    f"SELECT page_id, {gone('html', PATTERNS['html_tags'])} AS text FROM pages",
)
def strip_tags(spark, folder):
    return read_table(spark, folder, "pages").select(
        "page_id", X.strip_tags(F.col("html")).alias("text")
    )


@add(
    "tx4_strip_urls",
    f"SELECT page_id, {gone(chr(39) + 'see ' + chr(39) + ' || url', PATTERNS['urls'])} AS link, "
    f"{gone('html', PATTERNS['urls'])} AS text FROM pages",
)
def strip_urls(spark, folder):
    return read_table(spark, folder, "pages").select(
        "page_id",
        X.strip_urls(F.concat(F.lit("see "), "url")).alias("link"),
        X.strip_urls(F.col("html")).alias("text"),
    )


@add("tx_clean_text", S.on_noisy(f"SELECT doc_id, text FROM {FINAL} WHERE text <> ''", STEP_TABLES))
def clean_text(spark, folder):
    return TX.clean_text(noisy_documents(spark, folder), "text", "text", drop_blank=True)


@add(
    "u3_custom_rule",
    S.on_noisy(f"SELECT doc_id, {contractions_sql('text')} AS text FROM noisy"),
)
def custom_rule(spark, folder):
    def expand(text: str) -> str:
        for short, full in CONTRACTIONS:
            text = text.replace(short, full)
        return text

    rule = X.custom_rule(expand)
    return noisy_documents(spark, folder).withColumn("text", rule(F.col("text")))


# ---------------------------------------------------------------- words
@add(
    "tx10_words_to_rows",
    "SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, "
    "unnest(string_split_regex(lower(text), '\\s+')) AS word FROM documents) GROUP BY ALL",
)
def words_to_rows(spark, folder):
    documents = read_table(spark, folder, "documents")
    return (
        documents.select("doc_id", F.explode(X.words(F.col("text"))).alias("word"))
        .groupBy("doc_id", "word")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@add(
    "tx11_token_array",
    "SELECT doc_id, array_to_string(string_split_regex(text, '\\s+'), '|') AS tokens, "
    "CAST(len(string_split_regex(text, '\\s+')) AS INTEGER) AS n FROM documents",
)
def token_array(spark, folder):
    split = X.tokens(F.col("text"))
    return read_table(spark, folder, "documents").select(
        "doc_id", F.array_join(split, "|").alias("tokens"), F.size(split).alias("n")
    )


STOP_LIST = ", ".join(S.quoted(w) for w in [*ENGLISH, *EXTRA_STOP_WORDS])
KEPT_SQL = (
    "list_filter(string_split_regex({0}, '\\s+'), lambda w: lower(w) NOT IN (" + STOP_LIST + "))"
)


@add(
    "tx12_remove_stop_words",
    "SELECT doc_id, array_to_string(" + KEPT_SQL.format("text") + ", '|') AS kept, "
    "CAST(len(" + KEPT_SQL.format("text") + ") AS INTEGER) AS n FROM documents",
)
def remove_stop_words(spark, folder):
    split = read_table(spark, folder, "documents").select(
        "doc_id", X.tokens(F.col("text")).alias("words")
    )
    return TX.without_stop_words(split, "words").select(
        "doc_id", F.array_join("kept", "|").alias("kept"), F.size("kept").alias("n")
    )


@add(
    "tx13_join_tokens",
    S.on_noisy(
        "SELECT doc_id, array_to_string(" + KEPT_SQL.format("text") + f", ' ') AS final FROM {FINAL}",
        STEP_TABLES,
    ),
)
def join_tokens(spark, folder):
    cleaned = TX.clean_text(noisy_documents(spark, folder), "text", "clean")
    split = cleaned.withColumn("words", X.tokens(F.col("clean")))
    return TX.without_stop_words(split, "words").select(
        "doc_id", F.array_join("kept", " ").alias("final")
    )


WORDS_SQL = "SELECT unnest(string_split_regex(lower(text), '\\s+')) AS word FROM {0}"
COUNTS_SQL = (
    "SELECT word, count(*) AS n FROM (" + WORDS_SQL + ") WHERE length(word) > 2 GROUP BY word"
)


@add("ag11_word_frequency", "SELECT word, count(*) AS n FROM ("
     + WORDS_SQL.format("documents") + ") WHERE word <> '' GROUP BY word")
def word_frequency(spark, folder):
    return TX.word_counts(read_table(spark, folder, "documents"), "text")


@add(
    "tx16_stop_word_effect",
    "WITH t AS (SELECT unnest(string_split_regex(text, '\\s+')) AS word FROM documents), "
    "before AS (SELECT word, count(*) AS n FROM t WHERE word <> '' GROUP BY word "
    "ORDER BY n DESC, word LIMIT 100), "
    f"after AS (SELECT word, count(*) AS n FROM t WHERE word <> '' AND lower(word) NOT IN ({STOP_LIST}) "
    "GROUP BY word ORDER BY n DESC, word LIMIT 100) "
    "SELECT coalesce(b.word, a.word) AS word, b.n AS n_before, a.n AS n_after "
    "FROM before b FULL JOIN after a ON a.word = b.word",
)
def stop_word_effect(spark, folder):
    return TX.stop_word_effect(read_table(spark, folder, "documents"), "text")


# ---------------------------------------------------------------- patterns
@add(
    "ag9_pattern_counts",
    S.on_noisy(
        " UNION ALL ".join(
            f"SELECT '{n}' AS pattern, count(m) AS n, min(m) AS example FROM (SELECT "
            f"nullif(regexp_extract(text, {S.quoted(p)}, 0), '') AS m FROM noisy)"
            for n, p in PATTERNS.items()
        )
    ),
)
def pattern_counts(spark, folder):
    return TX.pattern_counts(noisy_documents(spark, folder), "text")


@add(
    "ag9_pattern_counts_for_row",
    S.on_noisy(
        " UNION ALL ".join(
            f"SELECT '{n}' AS pattern, count(m) AS n, max(CASE WHEN doc_id = 0 THEN m END) AS example "
            f"FROM (SELECT doc_id, nullif(regexp_extract(text, {S.quoted(p)}, 0), '') AS m FROM noisy)"
            for n, p in PATTERNS.items()
        )
    ),
)
def pattern_counts_for_row(spark, folder):
    documents = noisy_documents(spark, folder)
    return TX.pattern_counts(documents, "text", example_from=F.col("doc_id") == 0)


def _report_sql(name: str, pattern: str) -> str:
    by = " " if name == "non_letters" else ""
    hit = f"regexp_matches(text, {S.quoted(pattern)})"
    key = f"(SELECT min(doc_id) FROM noisy WHERE doc_id <> 0 AND {hit})"
    shown = f"(SELECT substr({{}}, 1, 100) || '...' FROM noisy WHERE doc_id = {key})"
    return (
        f"SELECT '{name}' AS pattern, (SELECT count(*) FROM noisy WHERE {hit}) AS n, "
        f"{key} AS example_key, coalesce({shown.format('text')}, 'N/A') AS before, "
        f"coalesce({shown.format(gone('text', pattern, by))}, 'N/A') AS after"
    )


@add(
    "ag10_pattern_report",
    S.on_noisy(" UNION ALL ".join(_report_sql(n, p) for n, p in PATTERNS.items())),
)
def pattern_report(spark, folder):
    return TX.pattern_report(noisy_documents(spark, folder), "doc_id", "text", exclude_key=0)


@add(
    "tx15_cleaning_trace",
    S.on_noisy(
        "SELECT doc_id, 0 AS step, 'original' AS name, length(text) AS n_chars, md5(text) AS digest "
        "FROM noisy"
        + "".join(
            f" UNION ALL SELECT doc_id, {i}, '{name}', length(text), md5(text) FROM s{i}"
            for i, name in enumerate(STEPS_SQL, start=1)
        ),
        STEP_TABLES,
    ),
)
def cleaning_trace(spark, folder):
    trace = TX.cleaning_trace(noisy_documents(spark, folder), "doc_id", "text")
    return trace.select(
        "doc_id", "step", "name",
        F.length("value").cast("bigint").alias("n_chars"),
        F.md5(F.col("value").cast("binary")).alias("digest"),
    )


@add(
    "tx17_first_match",
    S.on_noisy(
        "SELECT doc_id, "
        + ", ".join(
            f"nullif(regexp_extract(text, {S.quoted(p)}, 0), '') AS {n}" for n, p in PATTERNS.items()
        )
        + " FROM noisy"
    ),
)
def first_match(spark, folder):
    return TX.noisy_examples(noisy_documents(spark, folder), "doc_id", "text")


# ---------------------------------------------------------------- spelling
# The SQL function measures bytes, so letters of two bytes get a capital as stand-in;
# words are in lower case and hold no capitals themselves.
ACCENTED = "ßäçèéêëíñóöüàâîïôùûáúœ"


def plain(word: str) -> str:
    return f"translate({word}, '{ACCENTED}', '{''.join(chr(65 + i) for i in range(len(ACCENTED)))}')"


VOCABULARY_SQL = f"vocabulary AS ({COUNTS_SQL.format('benchmark')})"
NEAREST_SQL = (
    f"WITH {VOCABULARY_SQL}, counts AS ({COUNTS_SQL.format('documents')}), "
    "frequent AS (SELECT * FROM counts ORDER BY n DESC, word LIMIT 200), "
    "unknown AS (SELECT * FROM frequent WHERE word NOT IN (SELECT word FROM vocabulary)), "
    "pairs AS (SELECT u.word, u.n, v.word AS suggestion, v.n AS suggestion_n, "
    f"damerau_levenshtein({plain('u.word')}, {plain('v.word')}) AS distance FROM unknown u, vocabulary v), "
    "nearest AS (SELECT *, row_number() OVER (PARTITION BY word "
    "ORDER BY distance, suggestion_n DESC, suggestion) AS place FROM pairs WHERE distance <= 2) "
    "SELECT word, n, suggestion, CAST(distance AS INTEGER) AS distance FROM nearest WHERE place = 1"
)


def vocabulary(spark, folder):
    return TX.word_counts(read_table(spark, folder, "benchmark"), "text", min_length=3)


def document_words(spark, folder):
    return TX.word_counts(read_table(spark, folder, "documents"), "text", min_length=3)


@add(
    "j2_unknown_words",
    f"WITH {VOCABULARY_SQL}, counts AS ({COUNTS_SQL.format('documents')}) "
    "SELECT word, n FROM counts WHERE word NOT IN (SELECT word FROM vocabulary)",
)
def unknown_words(spark, folder):
    return SP.unknown_words(document_words(spark, folder), vocabulary(spark, folder))


@add("j3_nearest_words", NEAREST_SQL)
def nearest_words(spark, folder):
    known = vocabulary(spark, folder)
    frequent = TX.top_words(document_words(spark, folder), 200)
    return SP.nearest_words(SP.unknown_words(frequent, known), known)


@add("tx14_spelling_suggestions", NEAREST_SQL + " ORDER BY n DESC, word LIMIT 20")
def spelling_suggestions(spark, folder):
    return SP.suggestions(document_words(spark, folder), vocabulary(spark, folder))


def _one_less(word: str) -> str:
    return f"list_transform(range(1, length({word}) + 1), lambda i: {word}[1:i - 1] || {word}[i + 1:])"


FORMS_SQL = (
    f"SELECT word, n, unnest(list_distinct([word] || one || flatten(list_transform(one, lambda x: {_one_less('x')})))) "
    f"AS form FROM (SELECT word, n, {_one_less('word')} AS one FROM {{}})"
)
ALL_NEAREST_SQL = (
    f"WITH {VOCABULARY_SQL}, counts AS ({COUNTS_SQL.format('documents')}), "
    "unknown AS (SELECT * FROM counts WHERE word NOT IN (SELECT word FROM vocabulary)), "
    f"mine AS ({FORMS_SQL.format('unknown')}), theirs AS ({FORMS_SQL.format('vocabulary')}), "
    "alike AS (SELECT DISTINCT m.word, m.n, t.word AS suggestion, t.n AS suggestion_n FROM mine m JOIN theirs t USING (form)), "
    f"pairs AS (SELECT *, damerau_levenshtein({plain('word')}, {plain('suggestion')}) AS distance FROM alike), "
    "nearest AS (SELECT *, row_number() OVER (PARTITION BY word "
    "ORDER BY distance, suggestion_n DESC, suggestion) AS place FROM pairs WHERE distance <= 2) "
    "SELECT word, n, suggestion, CAST(distance AS INTEGER) AS distance FROM nearest WHERE place = 1"
)


@add("j3_nearest_of_all_words", ALL_NEAREST_SQL)
def nearest_of_all_words(spark, folder):
    """Every unknown word of the documents; candidates share what is left after deletions."""
    known = vocabulary(spark, folder)
    return SP.nearest_words(SP.unknown_words(document_words(spark, folder), known), known)


CORRECTED_SQL = (
    f"WITH found AS ({NEAREST_SQL} ORDER BY n DESC, word LIMIT 20), "
    "fixed AS (SELECT * FROM (VALUES "
    + ", ".join(f"({S.quoted(a)}, {S.quoted(b)})" for a, b in TYPOS.items())
    + ") AS t(word, suggestion)), "
    "known AS (SELECT * FROM fixed UNION ALL SELECT word, suggestion FROM found "
    "WHERE word NOT IN (SELECT word FROM fixed)), "
    "runs AS (SELECT doc_id, unnest(runs) AS run, unnest(range(len(runs))) AS place FROM (SELECT doc_id, "
    r"regexp_extract_all(text, '[\p{L}\p{N}_]+|[^\p{L}\p{N}_]+') AS runs FROM documents)), "
    "fixes AS (SELECT r.doc_id, count(k.word) AS corrected, "
    "string_agg(coalesce(k.suggestion, r.run), '' ORDER BY r.place) AS text "
    "FROM runs r LEFT JOIN known k ON k.word = r.run GROUP BY r.doc_id) "
    "SELECT doc_id, corrected > 0 AS corrected, length(text) AS n_chars, md5(text) AS digest FROM fixes"
)


@add("tx14_corrected_text", CORRECTED_SQL)
def corrected_text(spark, folder):
    """Whole texts with the corrections found in them and the fixed ones, one lookup per word."""
    documents = read_table(spark, folder, "documents")
    corrections = found_corrections(documents, "text", vocabulary(spark, folder)) | dict(TYPOS)
    text = X.correct_by_map(F.col("text"), corrections)
    return documents.where("text <> ''").select(
        "doc_id",
        (text != F.col("text")).alias("corrected"),
        F.length(text).cast("bigint").alias("n_chars"),
        F.md5(text.cast("binary")).alias("digest"),
    )
