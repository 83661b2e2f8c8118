"""Text cleaning expressions. All run inside the JVM."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from cohortlens.functions.fixed import CONTRACTIONS, PATTERNS, TYPOS

Step = Callable[[Column], Column]

#: Characters of a word, for whole-word corrections.
WORD = r"[\p{L}\p{N}_]"


def without(pattern: str) -> Step:
    return lambda c: F.regexp_replace(c, pattern, "")


strip_mentions = without(PATTERNS["mentions"])
strip_hashtags = without(PATTERNS["hashtags"])
strip_tags = without(PATTERNS["html_tags"])
strip_urls = without(PATTERNS["urls"])


def expand_contractions(text: Column, rules: Iterable[tuple[str, str]] = CONTRACTIONS) -> Column:
    """Apply literal contraction rules one after the other."""
    for short, full in rules:
        text = F.replace(text, F.lit(short), F.lit(full))
    return text


def correct_words(
    text: Column,
    corrections: dict[str, str] = TYPOS,
    whole_word: bool = True,
    ignore_case: bool = False,
) -> Column:
    """Replace misspelt words. Words and corrections are taken literally."""
    for wrong, right in corrections.items():
        if not whole_word and not ignore_case:
            text = F.replace(text, F.lit(wrong), F.lit(right))
            continue
        pattern = re.escape(wrong)
        if whole_word:
            pattern = rf"\b{pattern}\b"
        if ignore_case:
            pattern = f"(?iu){pattern}"
        literal = right.replace("\\", "\\\\").replace("$", "\\$")
        text = F.regexp_replace(text, pattern, literal)
    return text


def correct_by_map(text: Column, corrections: dict[str, str]) -> Column:
    """Replace whole words that ``corrections`` lists, each looked up once in one pass.

    A word is a run of letters, digits and underscores. What a correction brings in is not
    corrected again, so the order of the corrections plays no part and there may be any number.
    """
    if not corrections:
        return text
    known = F.create_map(*[F.lit(part) for pair in corrections.items() for part in pair])
    runs = F.split(text, rf"(?<={WORD})(?=[^{WORD[1:]})|(?<=[^{WORD[1:]})(?={WORD})", -1)
    return F.array_join(F.transform(runs, lambda run: F.coalesce(F.try_element_at(known, run), run)), "")


def blank_non_letters(text: Column) -> Column:
    return F.regexp_replace(text, PATTERNS["non_letters"], " ")


def squeeze_blanks(text: Column) -> Column:
    return F.regexp_replace(text, r"\s+", " ")


def lower_trimmed(text: Column) -> Column:
    return F.lower(F.trim(text))


def cleaning_steps(corrections: dict[str, str] = TYPOS) -> dict[str, Step]:
    """The nine cleaning steps in order, for a step-by-step trace."""
    return {
        "mentions": strip_mentions,
        "hashtags": strip_hashtags,
        "html_tags": strip_tags,
        "urls": strip_urls,
        "contractions": expand_contractions,
        "typos": lambda c: correct_words(c, corrections),
        "non_letters": blank_non_letters,
        "blanks": squeeze_blanks,
        "lower_case": lower_trimmed,
    }


def words(text: Column) -> Column:
    """Lower-cased words split at white space; leading blanks give an empty word."""
    return F.split(F.lower(text), r"\s+")


def tokens(text: Column) -> Column:
    return F.split(text, r"\s+")


def first_match(text: Column, pattern: str) -> Column:
    """First match of a pattern, or NULL."""
    return F.nullif(F.regexp_extract(text, pattern, 0), F.lit(""))


def custom_rule(function: Callable[[str], str]) -> Step:
    """A user's own text function, run on Arrow batches; NULL and errors keep the input."""

    def guarded(value):
        if not value:
            return value
        try:
            return function(value)
        except Exception:
            return value

    @pandas_udf("string")
    def apply(values: pd.Series) -> pd.Series:
        return values.map(guarded)

    return apply
