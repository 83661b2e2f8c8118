"""Text operators: cleaning, traces, pattern reports, word counts, stop-words."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.functions import text as X
from cohortlens.functions.columns import only_known, shortened, struct_rows
from cohortlens.functions.fixed import EXTRA_STOP_WORDS, PATTERNS, TYPOS
from cohortlens.sources.scratch import written


def clean_text(
    df: DataFrame,
    column: str,
    out: str,
    corrections: dict[str, str] = TYPOS,
    drop_blank: bool = False,
) -> DataFrame:
    """Add the text after all nine cleaning steps, with fewer passes over it.

    Mentions and hashtags go in one pass: what follows a match is never a word
    character, so removing one kind cannot extend or create a match of the other.
    Non-letters and blanks go in one pass: both leave one blank per run. Rules are
    tried only on texts that hold an apostrophe or one of the misspelt words; the
    search for those is much cheaper than the rules. Rows with nothing left are dropped
    on request.
    """
    stage = F.col("_stage")
    marks = F.regexp_replace(F.col(column), r"[@#]\w+", "")
    staged = df.withColumn("_stage", X.strip_urls(X.strip_tags(marks)))
    staged = staged.withColumn(
        "_stage", F.when(F.contains(stage, F.lit("'")), X.expand_contractions(stage)).otherwise(stage)
    )
    if corrections:
        found = reduce(lambda a, b: a | b, [F.contains(stage, F.lit(w)) for w in corrections])
        fixed = F.when(found, X.correct_words(stage, corrections)).otherwise(stage)
        staged = staged.withColumn("_stage", fixed)
    letters = F.regexp_replace(stage, r"[^a-zA-Z]+", " ")
    clean = X.lower_trimmed(letters)
    if not drop_blank:
        return staged.withColumn(out, clean).drop("_stage")
    others = [c for c in df.columns if c != out]
    return staged.select(*others, only_known(F.nullif(clean, F.lit(""))).alias(out))


def cleaning_trace(
    df: DataFrame, key: str, column: str, corrections: dict[str, str] = TYPOS
) -> DataFrame:
    """The text after each cleaning step, one row per step."""
    names = ["original", *X.cleaning_steps(corrections)]
    staged = df.select(key, F.col(column).alias("_s0"))
    # One projection per step: each stage is computed once and then only referred to.
    for i, step in enumerate(X.cleaning_steps(corrections).values(), start=1):
        staged = staged.withColumn(f"_s{i}", step(F.col(f"_s{i - 1}")))
    rows = [
        {"step": F.lit(i), "name": F.lit(name), "value": F.col(f"_s{i}")}
        for i, name in enumerate(names)
    ]
    return staged.select(key, F.inline(struct_rows(rows)))


# ---------------------------------------------------------------- patterns
def pattern_counts(
    df: DataFrame,
    column: str,
    patterns: dict[str, str] = PATTERNS,
    example_from: Column | None = None,
) -> DataFrame:
    """Rows matching each pattern and an example match, in a single pass.

    The example is the first match in the row ``example_from`` is true for, or else the
    smallest first match of all rows.
    """
    parts, rows = [], []
    for i, (name, pattern) in enumerate(patterns.items()):
        found = X.first_match(F.col(column), pattern)
        shown = found if example_from is None else F.when(example_from, found)
        parts += [F.count(found).alias(f"n{i}"), F.min(shown).alias(f"m{i}")]
        rows.append(
            {"pattern": F.lit(name), "n": F.col(f"n{i}"), "example": F.col(f"m{i}")}
        )
    return df.agg(*parts).select(F.inline(struct_rows(rows)))


def pattern_report(
    df: DataFrame,
    key: str,
    column: str,
    patterns: dict[str, str] = PATTERNS,
    exclude_key=None,
    length: int = 100,
) -> DataFrame:
    """Rows per pattern with a shortened before and after of the lowest matching key.

    One pass finds counts and keys; no text travels with the aggregate. The texts of the
    few chosen keys are then looked up with a filter that reaches the scan.
    """
    parts = []
    shown = F.lit(True) if exclude_key is None else F.col(key) != F.lit(exclude_key)
    for i, pattern in enumerate(patterns.values()):
        hit = F.col(column).rlike(pattern)
        parts += [
            F.count_if(hit).alias(f"n{i}"),
            F.min(F.when(hit & shown, F.col(key))).alias(f"k{i}"),
        ]
    row = df.agg(*parts).first()
    found = [(name, row[f"n{i}"], row[f"k{i}"]) for i, name in enumerate(patterns)]
    key_type = df.schema[key].dataType.simpleString()
    # One line per pattern, so both sides of the join below are that short.
    lines = df.sparkSession.createDataFrame(
        found, f"pattern string, n bigint, example_key {key_type}"
    )
    keys = list({k for _, _, k in found if k is not None})
    texts = df.where(F.col(key).isin(keys)).select(
        F.col(key).alias("example_key"), F.col(column).alias("_text")
    )
    after = F.lit(None).cast("string")
    for name, pattern in patterns.items():
        blank = " " if name == "non_letters" else ""
        cleaned = F.regexp_replace("_text", pattern, blank)
        after = F.when(F.col("pattern") == name, cleaned).otherwise(after)
    return lines.join(texts, "example_key", "left").select(
        "pattern",
        "n",
        "example_key",
        F.coalesce(shortened(F.col("_text"), length), F.lit("N/A")).alias("before"),
        F.coalesce(shortened(after, length), F.lit("N/A")).alias("after"),
    )


def noisy_examples(
    df: DataFrame, key: str, column: str, patterns: dict[str, str] = PATTERNS
) -> DataFrame:
    """First match of each pattern in each row, NULL where there is none."""
    return df.select(
        key, *[X.first_match(F.col(column), p).alias(n) for n, p in patterns.items()]
    )


# ---------------------------------------------------------------- words
def explode_words(df: DataFrame, column: str, out: str = "word") -> DataFrame:
    return df.select(F.explode(X.words(F.col(column))).alias(out))


def word_counts(
    df: DataFrame, column: str, min_length: int = 1, drop: Sequence[str] = ("",)
) -> DataFrame:
    """Number of uses of each word, counted before any shuffle as far as possible."""
    word = F.col("word")
    return (
        explode_words(df, column)
        .where((F.length(word) >= min_length) & ~word.isin(*drop))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def top_words(counts: DataFrame, rows: int) -> DataFrame:
    return counts.orderBy(F.desc("n"), F.asc("word")).limit(rows)


def stop_words(extra: Sequence[str] = EXTRA_STOP_WORDS) -> list[str]:
    return StopWordsRemover.loadDefaultStopWords("english") + list(extra)


def without_stop_words(
    df: DataFrame, column: str, out: str = "kept", extra: Sequence[str] = EXTRA_STOP_WORDS
) -> DataFrame:
    """Drop English and extra stop-words from an array of words."""
    remover = StopWordsRemover(inputCol=column, outputCol=out, stopWords=stop_words(extra))
    return remover.transform(df)


def stop_word_effect(
    df: DataFrame, column: str, rows: int = 100, extra: Sequence[str] = EXTRA_STOP_WORDS
) -> DataFrame:
    """The most frequent words with and without stop-words, side by side.

    Stop-words go word by word, so they can be taken from the counts: the texts are
    split and counted once for both sides.
    """
    word = F.explode(X.tokens(F.col(column))).alias("word")
    counts = written(
        df.select(word).where("word <> ''").groupBy("word").agg(F.count(F.lit(1)).alias("n")),
        "word-counts",
    )
    kept = counts.where(~F.lower("word").isin(*[w.lower() for w in stop_words(extra)]))
    before = top_words(counts, rows).withColumnRenamed("n", "n_before")
    after = top_words(kept, rows).withColumnRenamed("n", "n_after")
    return before.join(after, "word", "full")
