"""Whole-word corrections by a map, and the SQL of the corrected text on words that need them."""

import re

from pyspark.sql import functions as F

from cohortlens.functions import text as X
from cohortlens.plans.analysis import prepare_text


def corrected(spark, texts, corrections):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    return [r[0] for r in df.select(X.correct_by_map(F.col("text"), corrections)).collect()]


def slowly(text, corrections):
    return text and re.sub(r"\w+", lambda m: corrections.get(m[0], m[0]), text)


def test_words_are_looked_up_whole_and_once(spark):
    corrections = {"teh": "the", "the": "thee", "größe": "Größe!", "a_b": "$1\\", "x1": ""}
    texts = [
        None, "", " ", "teh", "Teh teh-teh, tehs teh", "größe größen", "a_b a_ b a", "x1", " x1\nx1 ", "…teh…", "the teh",
    ]
    assert corrected(spark, texts, corrections) == [slowly(t, corrections) for t in texts]
    assert corrected(spark, texts, {}) == texts


def test_any_number_of_corrections(spark):
    corrections = {f"wrong{i}": f"right{i}" for i in range(500)}
    text = " ".join(f"wrong{i},ok" for i in range(0, 600, 7))
    assert corrected(spark, [text], corrections) == [slowly(text, corrections)]


def test_prepared_text_uses_corrections_found_in_it(spark):
    rows = [(i, "patient stayd calm, http://stayd.example", "stayd again") for i in range(3)]
    df = spark.createDataFrame(rows, "id int, one string, two string")
    vocabulary = spark.createDataFrame([("stayed", 9), ("patient", 5), ("again", 2), ("calm", 2)], "word string, n long")
    ready = prepare_text(df, ["one", "two"], vocabulary).first()
    assert "stayed" in ready.clean and "stayd" not in ready.clean.split()
    assert "stayd" in ready.text
    assert "stayd" in prepare_text(df, ["one", "two"]).first().clean.split()
