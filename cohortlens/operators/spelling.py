"""Spelling suggestions for frequent words against a vocabulary table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortlens.functions.columns import only_known
from cohortlens.operators.text import top_words

REACH = 2


def unknown_words(words: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Words that the vocabulary does not hold."""
    return words.join(vocabulary.select("word"), "word", "left_anti")


def swaps(word: Column) -> Column:
    """The word with each pair of neighbouring letters exchanged in turn."""
    places = F.sequence(F.lit(1), F.length(word) - 1)
    return F.when(
        F.length(word) < 2, F.array().cast("array<string>")
    ).otherwise(
        F.transform(
            places,
            lambda i: F.concat(
                F.substring(word, F.lit(1), i - 1),
                F.substring(word, i + 1, F.lit(1)),
                F.substring(word, i, F.lit(1)),
                F.substr(word, i + 2),
            ),
        )
    )


def edits(a: Column, b: Column) -> Column:
    """Edit distance up to two, where exchanging two neighbouring letters is one edit.

    NULL beyond two. Two edits with an exchange among them differ from a word that
    one exchange away from ``a`` or ``b`` by at most one plain edit.
    """
    plain = F.levenshtein(a, b, 4)
    near_b = F.exists(swaps(a), lambda s: F.levenshtein(s, b, 1) >= 0)
    near_a = F.exists(swaps(b), lambda s: F.levenshtein(a, s, 1) >= 0)
    both = F.arrays_overlap(swaps(a), swaps(b))
    return (
        F.when(plain < 0, None)
        .when(plain <= 1, plain)
        .when(F.array_contains(swaps(a), b), 1)
        .when(plain == 2, 2)
        .when(near_b | near_a | both, 2)
    )


def shortened_forms(word: Column, deletions: int = REACH) -> Column:
    """The word and every word left of it after up to ``deletions`` letters are taken out.

    Two words within that many edits, exchanges included, have one of these in common: each
    edit is undone by taking out at most one letter on either side.
    """
    forms = F.array(word)
    last = forms
    for _ in range(deletions):
        last = F.array_distinct(F.flatten(F.transform(last, _one_letter_less)))
        forms = F.concat(forms, last)
    return F.array_distinct(forms)


def _one_letter_less(word: Column) -> Column:
    return F.when(F.length(word) == 0, F.array().cast("array<string>")).otherwise(
        F.transform(
            F.sequence(F.lit(1), F.length(word)),
            lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.substr(word, i + 1)),
        )
    )


def under_forms(words: DataFrame, word: str, columns: Sequence[Column | str]) -> DataFrame:
    """Each word under the hashes of its shortened forms; equal hashes are verified later."""
    forms = F.transform(shortened_forms(F.col(word)), lambda f: F.xxhash64(f))
    return words.select(*columns, F.explode(forms).alias("_form"))


def candidate_pairs(words: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Pairs of words that share a shortened form: all within reach, and few others."""
    known = [F.col("word").alias("suggestion"), F.col("n").alias("suggestion_n")]
    return (
        under_forms(words, "word", ["word", "n"])
        .join(under_forms(vocabulary, "word", known), "_form")
        .select("word", "n", "suggestion", "suggestion_n")
        .distinct()
    )


def nearest_words(words: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """For each word its nearest vocabulary word within two edits, if there is one.

    Fewest edits first, then the more frequent word, then alphabetical order.
    Candidates come from an equality join on shortened forms and are then verified.
    """
    candidates = candidate_pairs(words, vocabulary)
    measured = candidates.select(
        "*", only_known(edits(F.col("word"), F.col("suggestion"))).alias("distance")
    )
    best = Window.partitionBy("word").orderBy(
        F.asc("distance"), F.desc("suggestion_n"), F.asc("suggestion")
    )
    return (
        measured.withColumn("_place", F.row_number().over(best))
        .where("_place = 1")
        .select("word", "n", "suggestion", "distance")
    )


def suggestions(
    counts: DataFrame, vocabulary: DataFrame, checked: int = 200, reported: int = 20
) -> DataFrame:
    """Corrections for unknown words among the ``checked`` most frequent ones."""
    frequent = top_words(counts, checked)
    nearest = nearest_words(unknown_words(frequent, vocabulary), vocabulary)
    return top_words(nearest, reported)
