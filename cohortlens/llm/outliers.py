"""Quality rules: base limits, and robust multivariate outliers per language and source.

Each text gives a vector of transformed statistics. For every cell of language and source the
centre and the scatter are those of the half of its rows that lie closest
together (minimum covariance determinant): starting from medians and quartiles, concentration
steps measure all rows by the last estimate and estimate anew from the closest ones, until the
determinant falls no further. Rows far from their cell's centre by Mahalanobis distance are
rejected. Small cells use the estimate of their language, small languages that of all rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import reduce
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.llm.common import map_rows, utf8
from cohortlens.sources.scratch import written

MIN_WORDS = 50
MOST_REPEATED = 0.5
SYMBOLS = "#*$%&|<>"
#: Share of a cell's rows the estimate rests on; fewer outliers than the rest do not move it.
SHARE = 0.5
#: Steps of a cell end when the logarithm of the determinant falls by less.
FALL = 1e-4
#: Rows with different texts a cell needs for an estimate of its own.
CELL_ROWS = 200
#: Estimates that are broadcast, at most.
MOST_BROADCAST = 10_000
#: Rows are rejected beyond this quantile of chi-square with a degree for each statistic.
CUT = 0.99999
#: Share of each correlation that is left out, so that no mix of statistics has a scatter of zero.
RIDGE = 1e-3
#: Distances are counted in so many steps per doubling.
STEPS_PER_DOUBLING = 8

NAMES = (
    "word_length",  # log of code points per word
    "symbols",  # log of symbols per word
    "capitals",  # log of the share of capitals
    "marks",  # log of punctuation marks per word
    "variety",  # log of distinct words over log of words
    "repeats",  # share of words in repeated windows, as an angle
    "lines",  # share of repeated lines, as an angle
)
SIZE = len(NAMES)
X = [f"x{i}" for i in range(SIZE)]

_CAPITALS = bytes(range(0x41, 0x5B))
_MARKS = b".,;:!?"


def _count(data: bytes, chosen: bytes) -> int:
    return len(data) - len(data.translate(None, chosen))


def statistics(text: str | None) -> tuple:
    """``(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)``, the vector, and the lines."""
    text = text or ""
    data = utf8(text)
    words = data.split()
    count = len(words)
    chars = len(text) - _count(data, b" \t\n\r\x0b\x0c")
    symbols = _count(data, SYMBOLS.encode())
    lines = [line for line in text.split("\n") if line.strip(" \t\r\x0b\x0c")]
    again = len(lines) - len(set(lines))
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, count)
    repeated = repeat_words(ids, len(numbers))
    each = max(count, 1)
    vector = (
        math.log(max(chars, 1) / each),
        math.log(symbols / each + 0.02),
        math.log(_count(data, _CAPITALS) / max(chars, 1) + 0.01),
        math.log(_count(data, _MARKS) / each + 0.05),
        math.log(len(numbers) + 1) / math.log(count + 1) if count else 1.0,
        math.asin(math.sqrt(repeated / each)),
        math.asin(math.sqrt(again / max(len(lines), 1))),
    )
    return (count, chars, symbols, again, repeated), vector, len(lines)


def repeat_words(ids: np.ndarray, distinct: int) -> int:
    """Words in 3-word windows that stand twice or more in the sequence."""
    if len(ids) < 4:
        return 0
    pairs, place = ids[:-1] * distinct + ids[1:], None
    _, place = np.unique(pairs, return_inverse=True)
    _, inverse, counts = np.unique(place[:-1] * distinct + ids[2:], return_inverse=True, return_counts=True)
    twice = counts[inverse] > 1
    covered = np.zeros(len(ids), bool)
    for shift in range(3):
        covered[shift : len(ids) - 2 + shift] |= twice
    return int(covered.sum())


_LONG = T.LongType()
STATISTICS = T.StructType(
    [
        T.StructField("doc_id", _LONG),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("digest", _LONG),
        *(
            T.StructField(n, _LONG)
            for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
        ),
        *(T.StructField(x, T.DoubleType()) for x in X),
    ]
)


def measured(docs: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    def make(rows: Iterable[tuple]) -> Iterator[tuple]:
        for key, lang, source, digest, text in rows:
            counts, vector, lines = statistics(text)
            yield key, lang, source, digest, *counts, lines, *vector

    groups = (F.col(lang_col).cast("string"), F.col(source_col).cast("string"))
    columns = docs.select(F.col(id_col).cast("long"), *groups, F.xxhash64(text_col), F.col(text_col))
    return map_rows(columns, make, STATISTICS)


def chi_square(share: float, degrees: float = SIZE) -> float:
    """Quantile of chi-square (Wilson and Hilferty)."""
    k = 2 / (9 * degrees)
    return degrees * max(0.0, 1 - k + NormalDist().inv_cdf(share) * math.sqrt(k)) ** 3


def guards(words: float, chars: float, lines: float, centre: list[float]) -> list[float]:
    """What one letter, symbol, capital, mark, distinct word, repeated window (four words at
    least) and repeated line more adds to the statistics of a cell's middle text."""
    words, chars, lines = max(words, 1), max(chars, 1), max(lines, 1)

    def angle(at: float, part: float) -> float:
        part = min(part, 1.0)
        share = min(math.sin(at) ** 2, 1 - part)
        return math.asin(math.sqrt(min(share + part, 1.0))) - math.asin(math.sqrt(share))

    return [
        math.log1p(1 / chars),
        math.log1p(math.exp(-centre[1]) / words),
        math.log1p(math.exp(-centre[2]) / chars),
        math.log1p(math.exp(-centre[3]) / words),
        math.log1p((words + 1) ** -centre[4]) / math.log(words + 1),
        angle(centre[5], 4 / words),
        angle(centre[6], 1 / lines),
    ]


# --- estimates: one row per cell: its rows, centre and precision, the scatter of the closest
# rows, the guards, the factor from that scatter to that of all rows, the determinant's
# logarithm, and whether the cell's steps have ended -------------------------------------

PAIRS = [(i, j) for i in range(SIZE) for j in range(i, SIZE)]
CENTRE = [f"m{i}" for i in range(SIZE)]
PRECISION = [f"p{i}_{j}" for i, j in PAIRS]
SCATTER = [f"c{i}_{j}" for i, j in PAIRS]
GUARDS = [f"g{i}" for i in range(SIZE)]
NUMBERS = (*CENTRE, *PRECISION, *SCATTER, *GUARDS, "factor", "determinant")
ESTIMATE = T.StructType(
    [
        T.StructField("cell", T.StringType()),
        T.StructField("rows", _LONG),
        *(T.StructField(n, T.DoubleType()) for n in NUMBERS),
        T.StructField("done", T.BooleanType()),
    ]
)


def guarded(scatter: np.ndarray, guard: np.ndarray) -> np.ndarray:
    """The scatter, with the guard's square for each statistic that spreads less than its guard.
    A statistic that spreads further is left as it is."""
    spread = np.sqrt(np.maximum(np.diag(scatter), guard**2))
    singular = np.diag(scatter) <= guard**2
    alike = (1 - RIDGE) * scatter / np.outer(spread, spread)
    alike[singular, :] = alike[:, singular] = 0.0
    np.fill_diagonal(alike, 1.0)
    return alike * np.outer(spread, spread)


def _values(centre: np.ndarray, scatter: np.ndarray, guard: np.ndarray, factor: float, determinant: float) -> list[float]:
    inverse = np.linalg.inv(guarded(factor * scatter, guard))
    matrices = [float(matrix[i, j]) for matrix in (inverse, scatter) for i, j in PAIRS]
    return [*map(float, centre), *matrices, *map(float, guard), float(factor), float(determinant)]


def squared_distance() -> Column:
    """Squared Mahalanobis distance of a row joined with its cell's estimate."""
    total = None
    for i, j in PAIRS:
        term = (F.col(X[i]) - F.col(f"m{i}")) * (F.col(X[j]) - F.col(f"m{j}")) * F.col(f"p{i}_{j}")
        term = term if i == j else 2.0 * term
        total = term if total is None else total + term
    return F.when(total.isNotNull(), F.greatest(total, F.lit(0.0)))


def start(cells: DataFrame) -> DataFrame:
    """Medians, and quartile distances as spreads."""
    sizes = [F.percentile_approx(n, 0.5, 2000).cast("double") for n in ("n_words", "word_chars", "n_lines")]
    quartiles = [F.percentile_approx(x, [0.25, 0.5, 0.75], 2000).alias(x) for x in X]

    def make(rows: Iterable[tuple]) -> Iterator[tuple]:
        for cell, count, sizes, *values in rows:
            centre = [v[1] for v in values]
            spread = np.array([(v[2] - v[0]) / 1.349 for v in values])
            yield cell, count, *_values(centre, np.diag(spread**2), np.array(guards(*sizes, centre)), 1.0, math.inf), False

    counted = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("rows"), F.array(*sizes).alias("sizes"), *quartiles)
    return written(map_rows(counted.filter(F.col("rows") >= CELL_ROWS), make, ESTIMATE), "estimate")


def _side(estimate: DataFrame) -> DataFrame:
    """Estimates are broadcast while they are counted to be few, some 600 bytes each; beyond
    that Spark chooses, and splits what it shuffles."""
    return F.broadcast(estimate) if estimate.count() <= MOST_BROADCAST else estimate


def concentrate(cells: DataFrame, estimate: DataFrame) -> DataFrame:
    """One concentration step: sums by cell and step of distance, then per cell the closest
    steps that hold SHARE of its rows. Sums are combined before they are shuffled; a cell then
    has a few hundred rows of sums.

    A cell whose determinant falls no further keeps the estimate it had and is done."""
    step = F.floor(STEPS_PER_DOUBLING * F.log2(squared_distance() + 2.0**-10)).cast("int")
    sums = [F.sum(x).alias(f"s_{x}") for x in X]
    squares = [F.sum(F.col(X[i]) * F.col(X[j])).alias(f"q{i}_{j}") for i, j in PAIRS]
    side = _side(estimate)
    by_step = (
        cells.join(side, "cell")
        .withColumn("step", step)
        .groupBy("cell", "step")
        .agg(F.count(F.lit(1)).alias("n"), *sums, *squares)
        .join(side.drop("rows", "done", *PRECISION), "cell")
    )

    def make(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("step")
        sizes = group["n"].to_numpy()
        rows = int(sizes.sum())
        running = sizes.cumsum()
        near = group.iloc[: int(np.searchsorted(running, SHARE * rows)) + 1]
        count = float(near["n"].sum())
        before = group.iloc[0]
        guard = before[GUARDS].to_numpy(float)
        centre = near[[f"s_{x}" for x in X]].sum().to_numpy() / count
        scatter, last = np.zeros((SIZE, SIZE)), np.zeros((SIZE, SIZE))
        for i, j in PAIRS:
            scatter[i, j] = scatter[j, i] = near[f"q{i}_{j}"].sum() / count - centre[i] * centre[j]
            last[i, j] = last[j, i] = before[f"c{i}_{j}"]
        determinant = float(np.linalg.slogdet(guarded(scatter, guard))[1])
        done = not determinant < before["determinant"] - FALL
        if done:
            centre, scatter, determinant = before[CENTRE].to_numpy(float), last, before["determinant"]
        # The closest rows alone would understate the scatter: scale it so that the middle
        # distance of all rows is that of normal vectors. Statistics that spread less than
        # their guards count for the part they have in it.
        at = int(np.searchsorted(running, 0.5 * rows))
        inside = (0.5 * rows - (running[at] - sizes[at])) / sizes[at]
        middle = 2.0 ** ((group["step"].iloc[at] + inside) / STEPS_PER_DOUBLING) - 2.0**-10
        degrees = float(np.minimum(1.0, before["factor"] * np.diag(last) / guard**2).sum())
        factor = before["factor"] * middle / chi_square(0.5, degrees) if degrees >= 1 else 1.0
        values = [group["cell"].iloc[0], rows, *_values(centre, scatter, guard, max(factor, 1.0), determinant), done]
        return pd.DataFrame([values], columns=["cell", "rows", *NUMBERS, "done"])

    return written(by_step.groupBy("cell").applyInPandas(make, ESTIMATE), "estimate")


def estimates(cells: DataFrame) -> DataFrame:
    """Steps until every cell is done. Each takes at least FALL from the determinants that are
    left, which the guards and RIDGE keep above zero, so the steps come to an end."""
    left, done = start(cells), []
    while True:
        after = concentrate(cells, left)
        done.append(after.filter("done"))
        left = after.filter("not done")
        if left.isEmpty():
            return reduce(DataFrame.unionAll, done).select("cell", *CENTRE, *PRECISION)


def _cell_names() -> list[Column]:
    lang = F.coalesce(F.concat(F.lit("="), "lang"), F.lit("-"))
    source = F.coalesce(F.concat(F.lit("="), "source"), F.lit("-"))
    # The length keeps any language apart from any source, whatever signs they hold.
    cell = F.concat(F.length(lang).cast("string"), F.lit("/"), lang, F.lit("/"), source)
    return [cell, F.concat(F.lit("l"), lang), F.lit("all")]


def quality(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """One row per row of ``docs``: counts, base verdict, distance and verdict.

    A row fails the base rules with fewer than 50 words or with over half its words in repeated
    3-word windows. The others are measured against the closest level with ``CELL_ROWS`` rows
    of different texts that passed the base rules: language and source, language, all. Without any such level all
    of them are kept and ``distance`` is null. A null text has no words; null languages and
    sources are values like others; null ids stay null; equal rows get equal rows. Other
    columns are not read; an empty table gives an empty table.
    """
    rows = measured(docs, id_col, text_col, lang_col, source_col)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > round(100 * MOST_REPEATED) * F.col("n_words"))
    names = _cell_names()
    rows = written(
        rows.withColumn("base_failed", failed).withColumns({f"cell{i}": name for i, name in enumerate(names)}), "rows"
    )
    # Copies count once in the estimates: a text that fills half a cell has no scatter.
    passed = written(
        rows.filter("not base_failed")
        .select("cell0", "cell1", "cell2", "digest", "n_words", "word_chars", "n_lines", *X)
        .distinct(),
        "passed",
    )
    names = F.explode(F.array("cell0", "cell1", "cell2")).alias("cell")
    estimate = written(estimates(passed.select(names, "n_words", "word_chars", "n_lines", *X)), "estimates")
    known = estimate.select("cell")
    # The level each pair of language and source is measured by.
    pairs = rows.select("cell0", "cell1", "cell2").distinct()
    for i in range(3):
        pairs = pairs.join(known.select(F.col("cell").alias(f"cell{i}"), F.lit(i).alias(f"has{i}")), f"cell{i}", "left")
    level = F.coalesce(*(F.when(F.col(f"has{i}").isNotNull(), F.col(f"cell{i}")) for i in range(3)))
    levels = written(
        pairs.select("cell0", level.alias("cell")).join(estimate, "cell", "left").drop("cell"), "levels"
    )
    distance = squared_distance()
    cut = chi_square(CUT)
    return (
        rows.join(_side(levels), "cell0")
        .select("*", F.round(F.sqrt(distance), 9).alias("distance"))
        .select(
            "doc_id",
            "n_words",
            "word_chars",
            "n_symbols",
            "n_dup_lines",
            "n_repeat_words",
            "base_failed",
            (~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= math.sqrt(cut))).alias("kept"),
            "distance",
        )
    )
