"""Row and column repair: projections, filters, null handling, joins by key, sets."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortlens.functions import columns as C
from cohortlens.functions.fixed import MISSING, UNKNOWN


# ---------------------------------------------------------------- columns
def compose_text(df: DataFrame, parts: Sequence[str], out: str = "text") -> DataFrame:
    """Join text columns with a blank. NULL parts are skipped, so it is never NULL."""
    return df.withColumn(out, F.concat_ws(" ", *parts))


def override(df: DataFrame, key: str, value, column: str, replacement: str) -> DataFrame:
    """Replace one row's ``column`` by key and leave every other row as it is."""
    return df.withColumn(
        column,
        F.when(F.col(key) == F.lit(value), F.lit(replacement)).otherwise(F.col(column)),
    )


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.drop(*names)


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def project(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(*names)


def distinct_names(*lists: Iterable[str]) -> list[str]:
    """Concatenated name lists without repeats, in order of first appearance."""
    return list(dict.fromkeys(name for names in lists for name in names))


def vector_elements(df: DataFrame, vector: str, names: Sequence[str]) -> DataFrame:
    """The leading elements of an ML vector as plain columns."""
    return df.withColumns({n: C.element(vector, i) for i, n in enumerate(names)})


# ---------------------------------------------------------------- filters
def pick(df: DataFrame, key: str, value, *names: str) -> DataFrame:
    return df.where(F.col(key) == F.lit(value)).select(*(names or df.columns))


def exclude(df: DataFrame, key: str, value) -> DataFrame:
    """Rows with another key; rows with a NULL key are not kept."""
    return df.where(F.col(key) != F.lit(value))


def drop_blank(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column) != "")


def drop_values(df: DataFrame, column: str, values: Sequence[str] = ("", MISSING)) -> DataFrame:
    return df.where(~F.col(column).isin(*values))


def keep_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.where(F.col(column).isin(*values))


def longer_than(df: DataFrame, column: str, length: int = 2) -> DataFrame:
    return df.where(F.length(column) > length)


def where_sql(df: DataFrame, predicate: str) -> DataFrame:
    return df.where(predicate)


def where_regex(df: DataFrame, column: str, pattern: str) -> DataFrame:
    return df.where(F.col(column).rlike(pattern))


def known_values(df: DataFrame, column: str) -> DataFrame:
    """One column without its NULLs."""
    return df.where(F.col(column).isNotNull()).select(column)


def hash_sample(df: DataFrame, key: str, fraction: float, seed: int = 42) -> DataFrame:
    """Sample rows by a hash of their key: the same rows however data is partitioned."""
    return df.where(C.hash_below(key, fraction, seed))


def first_rows(df: DataFrame, order: str | Column, rows: int) -> DataFrame:
    return df.orderBy(order).limit(rows)


# ---------------------------------------------------------------- missing values
def markers_to_null(df: DataFrame, names: Sequence[str], marker: str = MISSING) -> DataFrame:
    return df.withColumns({n: C.marker_to_null(n, marker) for n in names})


def fill_unknown(
    df: DataFrame, names: Sequence[str], marker: str = MISSING, fill: str = UNKNOWN
) -> DataFrame:
    """Missing markers and NULLs both become ``fill``."""
    return df.withColumns({n: C.marker_or_null_to(n, marker, fill) for n in names})


def drop_incomplete(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(names))


# ---------------------------------------------------------------- joins and sets
def attach(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Add columns of ``other`` by key, keeping every row of ``df``.

    The join strategy is left to Catalyst: at run time a small ``other`` is
    broadcast, and a partition a hot key makes too large is split.
    """
    return df.join(other, key, "left")


def replace_from(df: DataFrame, other: DataFrame, key: str, column: str) -> DataFrame:
    """Take ``column`` from ``other`` where the key is found there, else keep it."""
    incoming = other.select(key, F.col(column).alias("_incoming"))
    return (
        attach(df, incoming, key)
        .withColumn(column, F.coalesce("_incoming", column))
        .drop("_incoming")
    )


def append(df: DataFrame, other: DataFrame) -> DataFrame:
    """All rows of both, by position, with duplicates."""
    return df.union(other)


def keep_lowest_key(df: DataFrame, names: Sequence[str], key: str) -> DataFrame:
    """One row per combination of ``names``: the one with the lowest key.

    Groups are told apart by a digest of the columns, so long values are neither sorted nor
    shuffled by value; the lowest key and its row are combined before the shuffle, which
    keeps many copies of one value cheap. A NULL differs from any text; NULL keys come first.
    """
    parts = [
        F.when(F.col(f"`{n}`").isNull(), "-").otherwise(
            F.concat(F.lit("="), F.sha2(F.col(f"`{n}`").cast("string"), 256))
        )
        for n in names
    ]
    rest = F.struct(*[F.col(f"`{n}`") for n in df.columns])
    first = F.min_by(rest, F.struct(F.col(key).isNotNull(), F.col(key)))
    return (
        df.groupBy(F.sha2(F.concat(*parts), 256).alias("_digest"))
        .agg(first.alias("_row"))
        .select("_row.*")
    )


def distinct_values(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*names).distinct()
