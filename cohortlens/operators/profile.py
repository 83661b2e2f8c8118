"""Column profiles: schema, frequencies, summaries, histograms, densities, box statistics."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.functions.columns import same_keys, struct_rows
from cohortlens.operators.ranks import exact_quantiles, long_values
from cohortlens.sources.scratch import written
from cohortlens.sources.tables import broadcast_if_small, to_driver

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


# ---------------------------------------------------------------- schema
def column_kind(data_type: T.DataType) -> str:
    if isinstance(data_type, T.NumericType):
        return "numeric"
    if isinstance(data_type, T.StringType):
        return "categorical"
    return "other"


def columns_of_kind(df: DataFrame, kind: str) -> list[str]:
    return [f.name for f in df.schema.fields if column_kind(f.dataType) == kind]


def schema_report(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, kind and how many values are known."""
    fields = df.schema.fields
    known = [F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(fields)]
    rows = [
        {
            "position": F.lit(i + 1),
            "column_name": F.lit(f.name),
            "data_type": F.lit(f.dataType.simpleString()),
            "kind": F.lit(column_kind(f.dataType)),
            "known": F.col(f"c{i}"),
        }
        for i, f in enumerate(fields)
    ]
    return df.agg(*known).select(F.inline(struct_rows(rows)))


# ---------------------------------------------------------------- frequencies
def frequency(df: DataFrame, name: str) -> DataFrame:
    """Values of a column by falling count; NULL is a value of its own."""
    return (
        df.groupBy(name).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc(name))
    )


def category_counts(df: DataFrame, names: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """Counts of every value of several columns, in one pass over the rows."""
    cells = struct_rows(
        [{"variable": F.lit(n), "value": F.col(f"`{n}`").cast("string")} for n in names]
    )
    return (
        df.select(*[F.col(f"`{g}`") for g in group], F.inline(cells))
        .groupBy(*group, "variable", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def category_shares(
    df: DataFrame, names: Sequence[str], group: Sequence[str] = (), out: str = "percent"
) -> DataFrame:
    """Percentage of each value among all rows, or among the rows of its group.

    The counts are written once; the totals, one per variable and group, come from them.
    """
    keys = [*group, "variable"]
    counts = written(category_counts(df, names, group), "category-counts")
    totals = counts.groupBy(*keys).agg(F.sum("n").alias("_rows"))
    return (
        counts.alias("c")
        .join(totals.alias("t"), same_keys(keys, "c", "t"))
        .select(
            *[F.col(f"c.{key}") for key in keys],
            "c.value",
            "c.n",
            (F.col("c.n") * 100.0 / F.col("t._rows")).alias(out),
        )
    )


# ---------------------------------------------------------------- numeric columns
def numeric_summary(
    df: DataFrame, names: Sequence[str] | None = None, interpolate: bool = False
) -> DataFrame:
    """Count, mean, deviation, minimum, quartiles and maximum, one row per column.

    Quartiles are exact elements of the data by default.
    """
    names = list(names or columns_of_kind(df, "numeric"))
    return exact_quantiles(df, names, QUARTILES, (), interpolate).select(
        "variable", "n_known", "mean", "deviation", "minimum", *QUARTILES, "maximum"
    )


def _finite(name: str) -> Column:
    """A column's value as a double; NULL where it is NULL, NaN or infinite."""
    value = F.col(f"`{name}`").cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value)


def _ranges(df: DataFrame, names: Sequence[str]) -> dict[str, dict]:
    """Count, extremes and deviation of the finite values per column, from one pass and one
    driver row. Columns without any are listed with a count of 0."""
    parts = []
    for i, name in enumerate(names):
        value = _finite(name)
        parts += [
            F.count(value).alias(f"n{i}"),
            F.min(value).alias(f"lo{i}"),
            F.max(value).alias(f"hi{i}"),
            F.stddev_samp(value).alias(f"sd{i}"),
        ]
    row = df.agg(*parts).first() if names else None
    return {
        name: {"n": row[f"n{i}"], "lo": row[f"lo{i}"], "hi": row[f"hi{i}"], "sd": row[f"sd{i}"]}
        for i, name in enumerate(names)
    }


def automatic_bins(df: DataFrame, names: Sequence[str]) -> dict[str, int]:
    """Bins per column by the narrower of the Freedman-Diaconis and Sturges widths."""
    bins = {}
    for row in to_driver(exact_quantiles(df, names, QUARTILES), max(len(names), 1)):
        length = (row.maximum or 0.0) - (row.minimum or 0.0)
        if not 0 < length < math.inf:
            bins[row.variable] = 1
            continue
        sturges = length / (math.log2(row.n_known) + 1)
        spread = 2.0 * (row.q75 - row.q25) * row.n_known ** (-1 / 3)
        bins[row.variable] = math.ceil(length / (min(spread, sturges) if spread else sturges))
    return bins


def histogram(
    df: DataFrame, names: Sequence[str], bins: int | dict[str, int] | str = 20
) -> DataFrame:
    """Equal-width histogram per column, with counts and percentages.

    Two column-pruned passes and no shuffle of values: extremes first, then counts
    per bin. The last bin is closed; bins without rows are listed with 0.
    ``bins`` is a number, a number per column, or ``"auto"``. NULL, NaN and infinite
    values are left out; a column without any other has one row with NULL for its bin.
    """
    if bins == "auto":
        bins = automatic_bins(df, names)
    frames, empty = [], []
    for name, span in _ranges(df, names).items():
        number = bins if isinstance(bins, int) else bins[name]
        if not span["n"]:
            empty.append(name)
            continue
        low, high = span["lo"], span["hi"]
        if low == high:
            low, high = low - 0.5, high + 0.5
        frames.append(
            {"variable": name, "low": low, "width": (high - low) / number, "bins": number,
             "rows": span["n"]}
        )
    schema = "variable string, low double, width double, bins int, rows bigint"
    settings = df.sparkSession.createDataFrame(
        [(f["variable"], f["low"], f["width"], f["bins"], f["rows"]) for f in frames]
        + [(name, None, None, 0, 0) for name in empty],
        schema,
    )
    places = []
    for f in frames:
        value = _finite(f["variable"])
        place = F.least(F.floor((value - f["low"]) / f["width"]), F.lit(f["bins"] - 1))
        # The smaller of NULL and a number is the number, so unknown values go first.
        place = F.when(value.isNotNull(), place).cast("int")
        places.append({"variable": F.lit(f["variable"]), "bin": place})
    counted = (
        df.select(F.inline(struct_rows(places))) if places
        else df.sparkSession.createDataFrame([], "variable string, bin int")
    )
    counted = (
        counted.where(F.col("bin").isNotNull())
        .groupBy("variable", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    numbers = F.when(F.col("bins") > 0, F.sequence(F.lit(0), F.col("bins") - 1))
    grid = settings.select("*", F.explode_outer(numbers).alias("bin"))
    n = F.when(F.col("bin").isNotNull(), F.coalesce("n", F.lit(0)))
    return grid.join(counted, ["variable", "bin"], "left").select(
        "variable",
        "bin",
        (F.col("low") + F.col("bin") * F.col("width")).alias("lower"),
        (F.col("low") + (F.col("bin") + 1) * F.col("width")).alias("upper"),
        F.coalesce(n, F.lit(0)).alias("n"),
        (n * 100.0 / F.when(F.col("rows") > 0, F.col("rows"))).alias("percent"),
    )


def density(
    df: DataFrame,
    names: Sequence[str],
    points: int = 200,
    bandwidth: float | None = None,
) -> DataFrame:
    """Gaussian density per column on an even grid between its extremes.

    Without a bandwidth, Scott's rule is used. Each task adds its values up on the grid, and
    only the ``points`` sums per column are shuffled. NULL, NaN and infinite values are left
    out. A column whose values are all equal has its grid at that value, without a bandwidth
    with a NULL density; one without values has one row of NULLs.
    """
    curves = []
    for name, span in _ranges(df, names).items():
        if not span["n"]:
            curves.append((name, None, None, None, 0))
            continue
        width = bandwidth or (span["sd"] or 0.0) * span["n"] ** (-1 / 5)
        step = (span["hi"] - span["lo"]) / (points - 1) if points > 1 else 0.0
        curves.append((name, span["lo"], step, width or None, span["n"]))
    settings = df.sparkSession.createDataFrame(
        curves, "variable string, low double, step double, width double, rows bigint"
    )
    drawn = [c for c in curves if c[3]]
    sums = _grid_sums(df, drawn, points).groupBy("variable", "point").agg(F.sum("mass").alias("_mass"))
    numbers = F.when(F.col("rows") > 0, F.sequence(F.lit(0), F.lit(points - 1)))
    grid = settings.select("*", F.explode_outer(numbers).alias("point"))
    area = F.col("rows") * F.col("width") * math.sqrt(2 * math.pi)
    mass = F.when(F.col("width").isNotNull(), F.coalesce("_mass", F.lit(0.0)))
    return grid.join(sums, ["variable", "point"], "left").select(
        "variable",
        "point",
        (F.col("low") + F.col("point") * F.col("step")).alias("x"),
        (mass / area).alias("density"),
    )


def _grid_sums(df: DataFrame, curves: Sequence[tuple], points: int) -> DataFrame:
    """Per task, column and grid point the sum of the Gaussian weights of the task's values."""
    schema = "variable string, point int, mass double"
    if not curves:
        return df.sparkSession.createDataFrame([], schema)
    values = df.select(*[_finite(name).alias(f"c{i}") for i, (name, *_) in enumerate(curves)])
    grids = [low + step * np.arange(points) for _, low, step, _, _ in curves]

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((len(curves), points))
        for batch in batches:
            for i, (_, _, _, width, _) in enumerate(curves):
                column = batch.column(i).drop_null().to_numpy(zero_copy_only=False)
                known, counts = np.unique(column, return_counts=True)
                for start in range(0, len(known), 1024):
                    part = slice(start, start + 1024)
                    z = (grids[i][None, :] - known[part, None]) / width
                    totals[i] += counts[part] @ np.exp(-0.5 * z * z)
        names = np.repeat([name for name, *_ in curves], points).tolist()
        numbers = np.tile(np.arange(points, dtype=np.int32), len(curves))
        yield pa.RecordBatch.from_arrays(
            [pa.array(names), pa.array(numbers), pa.array(totals.ravel())],
            names=["variable", "point", "mass"],
        )

    return values.mapInArrow(add_up, schema)


def box_stats(
    df: DataFrame,
    names: Sequence[str],
    group: Sequence[str] = (),
    reach: float = 1.5,
    single_task_rows: int | None = None,
) -> DataFrame:
    """Quartiles, whisker ends and number of outliers per column (and group).

    Columns and groups without known values have NULLs and no outliers. ``df`` is read three
    times: write a costly view to a table first.
    """
    keys = [*group, "variable"]
    extra = {} if single_task_rows is None else {"single_task_rows": single_task_rows}
    quartiles = exact_quantiles(df, names, QUARTILES, group, **extra)
    # Without a group there is one row per column.
    side = broadcast_if_small(quartiles) if group else F.broadcast(quartiles)
    spread = F.col("q75") - F.col("q25")
    inside = (F.col("value") >= F.col("q25") - reach * spread) & (
        F.col("value") <= F.col("q75") + reach * spread
    )
    counted = (
        long_values(df, names, group)
        .alias("v")
        .join(side.alias("q"), same_keys(keys, "v", "q"))
        .select(*[F.col(f"v.{k}") for k in keys], "v.value", *QUARTILES)
        .groupBy(*keys)
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("low_whisker"),
            F.max(F.when(inside, F.col("value"))).alias("high_whisker"),
            F.count_if(~inside).alias("outliers"),
        )
    )
    # Columns and groups without known values keep their row.
    return side.alias("q").join(counted.alias("c"), same_keys(keys, "q", "c"), "left").select(
        *[F.col(f"q.{k}") for k in keys],
        "q.n_known",
        *[f"q.{q}" for q in QUARTILES],
        "c.low_whisker",
        "c.high_whisker",
        F.coalesce("c.outliers", F.lit(0)).alias("outliers"),
    )
