"""Cleaning: goldens, step order, equality of the short and the stepwise form."""

import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from cohortlens.functions import text as X
from cohortlens.functions.fixed import NOISY_KEY, NOISY_TEXT
from cohortlens.operators import rows as R
from cohortlens.operators import spelling as SP
from cohortlens.operators import text as TX
from cohortlens.plans.analysis import prepare_text
from cohortlens.queries.stopwords import ENGLISH

GOLDEN = (
    "hi check pt clearly has diabetes do not trust the lab she cannot tolerate hospital admission "
    "today going to bump her insulin therapy refs see chart at she is a yr old will not comply has "
    "not taken medication in days"
)


def texts(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "id int, text string")


def test_golden_text(spark):
    df = TX.clean_text(texts(spark, [NOISY_TEXT]), "text", "clean")
    assert df.first()["clean"] == GOLDEN


def test_override_puts_the_noisy_text_in_one_row(spark):
    df = spark.createDataFrame([(NOISY_KEY, "a"), (1, "b")], "encounter_id int, text string")
    rows = {r.encounter_id: r.text for r in R.override(df, "encounter_id", NOISY_KEY, "text", NOISY_TEXT).collect()}
    assert rows == {NOISY_KEY: NOISY_TEXT, 1: "b"}


def test_trace_ends_with_the_cleaned_text(spark):
    trace = TX.cleaning_trace(texts(spark, [NOISY_TEXT]), "id", "text").orderBy("step").collect()
    assert [r.step for r in trace] == list(range(10))
    assert trace[0].value == NOISY_TEXT
    assert "@dr_smith" not in trace[1].value and "#diabetes" in trace[1].value
    assert "#insulin" not in trace[2].value
    assert "<b>" not in trace[3].value and "https" in trace[3].value
    assert "https" not in trace[4].value
    assert "cannot" in trace[5].value and "will not comply" in trace[5].value
    assert "diabetes" in trace[6].value and "diabetis" not in trace[6].value
    assert trace[9].value == GOLDEN


def test_patterns_are_gone_after_cleaning(spark):
    df = texts(spark, [NOISY_TEXT, "plain", "mail a@b.com"])
    before = {r.pattern: r.n for r in TX.pattern_counts(df, "text").collect()}
    after = TX.pattern_counts(TX.clean_text(df, "text", "text"), "text").collect()
    assert all(n > 0 for n in before.values())
    assert all(r.n == 0 for r in after)


def test_mention_pattern_cuts_a_mail_address(spark):
    df = texts(spark, ["write to a@b.com"])
    assert df.select(X.strip_mentions(F.col("text"))).first()[0] == "write to a.com"


def test_case_of_typos(spark):
    df = texts(spark, ["Diabetis diabetis"])
    strict = df.select(X.correct_words(F.col("text"))).first()[0]
    loose = df.select(X.correct_words(F.col("text"), ignore_case=True)).first()[0]
    assert (strict, loose) == ("Diabetis diabetes", "diabetes diabetes")


def test_corrections_are_literal(spark):
    df = texts(spark, ["c++ a.b axb"])
    fixed = df.select(X.correct_words(F.col("text"), {"a.b": "$1\\"})).first()[0]
    assert fixed == "c++ $1\\ axb"


ALPHABET = st.text(alphabet="ab1_ @#<>'.\n\tñhtp/:", max_size=25)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ALPHABET, min_size=30, max_size=60))
def test_short_form_equals_the_steps(spark, values):
    df = texts(spark, values)
    stepwise = F.col("text")
    for step in X.cleaning_steps().values():
        stepwise = step(stepwise)
    both = TX.clean_text(df.select("text", stepwise.alias("a")), "text", "b")
    assert both.where("a <> b").collect() == []


def test_cleaning_twice_changes_nothing(spark, small):
    documents = spark.read.parquet(f"{small}/documents.parquet")
    once = TX.clean_text(documents, "text", "once")
    assert TX.clean_text(once, "once", "twice").where("once <> twice").count() == 0


def test_word_split_keeps_empty_words(spark):
    df = texts(spark, [" a b", ""])
    assert [r[0] for r in df.select(X.words(F.col("text"))).collect()] == [["", "a", "b"], [""]]


def test_stop_word_list_is_sparks(spark):
    assert StopWordsRemover.loadDefaultStopWords("english") == ENGLISH


def test_custom_rule_keeps_input_on_error(spark):
    def strict(text):
        if "bad" in text:
            raise ValueError("bad")
        return text.upper()

    rule = X.custom_rule(strict)
    df = texts(spark, ["good", "bad", None, ""])
    assert [r[0] for r in df.select(rule(F.col("text"))).collect()] == ["GOOD", "bad", None, ""]


# ---------------------------------------------------------------- spelling
def damerau(a: str, b: str) -> int:
    """Unrestricted edit distance with neighbour exchanges, by its recurrence."""
    last, top = {}, len(a) + len(b)
    d = {(-1, -1): top}
    for i in range(len(a) + 1):
        d[i, -1], d[i, 0] = top, i
    for j in range(len(b) + 1):
        d[-1, j], d[0, j] = top, j
    for i in range(1, len(a) + 1):
        match = 0
        for j in range(1, len(b) + 1):
            k, m = last.get(b[j - 1], 0), match
            same = a[i - 1] == b[j - 1]
            if same:
                match = j
            d[i, j] = min(
                d[i - 1, j - 1] + (not same),
                d[i, j - 1] + 1,
                d[i - 1, j] + 1,
                d[k - 1, m - 1] + (i - k - 1) + 1 + (j - m - 1),
            )
        last[a[i - 1]] = i
    return d[len(a), len(b)]


def test_nearest_words_against_brute_force(spark):
    random.seed(7)
    letters = "abcé"
    make = lambda: "".join(random.choice(letters) for _ in range(random.randint(3, 9)))
    vocabulary = {make(): random.randint(1, 5) for _ in range(300)} | {"abcdefghijkl": 2}
    words = {make() for _ in range(120)} - set(vocabulary) | {"bacdefghijlk", "abcdefghij"}
    expected = {}
    for w in words:
        options = [(damerau(w, v), -n, v) for v, n in vocabulary.items()]
        best = min(o for o in options)
        if best[0] <= 2:
            expected[w] = (best[2], best[0])
    known = spark.createDataFrame(list(vocabulary.items()), "word string, n bigint")
    asked = spark.createDataFrame([(w, 1) for w in words], "word string, n bigint")
    found = {r.word: (r.suggestion, r.distance) for r in SP.nearest_words(asked, known).collect()}
    assert found == expected


def test_prepare_text_uses_found_corrections(spark):
    rows = [("patient patient", "hospitl")] * 3 + [(None, None), ("the", "hospitl")]
    df = spark.createDataFrame(rows, "a string, b string")
    vocabulary = spark.createDataFrame([("hospital", 5), ("patient", 3)], "word string, n bigint")
    done = prepare_text(df, ["a", "b"], vocabulary)
    assert sorted(r.final for r in done.collect()) == ["hospital"] + ["patient patient hospital"] * 3


def test_candidates_are_complete_and_few(spark):
    """All pairs within two edits share a shortened form, and few others do."""
    chance = random.Random(8)
    make = lambda: "".join(chance.choice("abcdefghij") for _ in range(chance.randint(1, 9)))
    words = sorted({make() for _ in range(150)})
    edited = sorted({w[:i] + chance.choice("abcxyz") + w[i + chance.randint(0, 1):] for w in words for i in [chance.randint(0, len(w))]})
    left = spark.createDataFrame([(w, 1) for w in words], "word string, n int")
    right = spark.createDataFrame([(w, 1) for w in edited], "word string, n int")
    pairs = SP.candidate_pairs(left, right)
    found = {(r.word, r.suggestion) for r in pairs.select("word", "suggestion").collect()}
    every = left.select("word").crossJoin(right.select(F.col("word").alias("suggestion")))
    near = every.where(SP.edits(F.col("word"), F.col("suggestion")).isNotNull())
    assert {(r.word, r.suggestion) for r in near.collect()} <= found
    assert len(found) < 0.1 * len(words) * len(edited)
