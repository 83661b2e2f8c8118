"""Small column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortlens.functions.fixed import MISSING, UNKNOWN


def marker_to_null(name: str, marker: str = MISSING) -> Column:
    return F.nullif(F.col(name), F.lit(marker))


def marker_or_null_to(name: str, marker: str = MISSING, fill: str = UNKNOWN) -> Column:
    return F.coalesce(marker_to_null(name, marker), F.lit(fill))


def shortened(column: Column, length: int = 100, tail: str = "...") -> Column:
    return F.concat(F.substring(column, 1, length), F.lit(tail))


def element(vector: str, position: int) -> Column:
    """One element of an ML vector, read inside the JVM."""
    return vector_to_array(F.col(vector))[position]


def hash_below(key: str, fraction: float, seed: int) -> Column:
    """True for about ``fraction`` of the keys, the same keys on every run.

    The first eight hex digits of an MD5 are compared with the threshold as
    text, so partitioning and row order play no part.
    """
    if fraction >= 1:
        return F.lit(True)
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary"))
    return F.substring(digest, 1, 8) < F.lit(sample_threshold(fraction))


def sample_threshold(fraction: float) -> str:
    return f"{int(fraction * 2**32):08x}"


def squared_distance(a: Column, b: Column) -> Column:
    """Squared Euclidean distance of two arrays of doubles."""
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, d: s + d
    )


def struct_rows(rows: Sequence[dict[str, Column]]) -> Column:
    """An array of structs, one per dict, to be turned to rows with ``inline``."""
    return F.array(*[F.struct(*[c.alias(n) for n, c in row.items()]) for row in rows])


def same_keys(names: Sequence[str], left: str, right: str) -> Column:
    """Join condition on several keys of two aliased tables, where NULL equals NULL."""
    conditions = [F.col(f"{left}.`{n}`").eqNullSafe(F.col(f"{right}.`{n}`")) for n in names]
    return reduce(lambda a, b: a & b, conditions)


def only_known(column: Column) -> Column:
    """A generator giving the value once, or no row at all where it is NULL.

    A filter on a computed column is moved below the projection that computes it, and
    the expression is then worked out twice. A generator is not, so costly expressions
    that decide about their own row go through this one.
    """
    return F.explode(F.array_compact(F.array(column)))
