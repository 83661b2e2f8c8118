"""Running totals, positions and exact quantiles that never need a whole group in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortlens.functions.columns import same_keys, struct_rows
from cohortlens.sources.scratch import written
from cohortlens.sources.tables import broadcast_if_small, to_driver

# Up to this many counts a group's slivers are ranked by one ordinary window task.
SINGLE_TASK_ROWS = 1_000_000


def running_totals(
    df: DataFrame,
    order: Sequence[str | Column],
    weight: str | None = None,
    group: Sequence[str] = (),
    single_task_rows: int | None = None,
) -> DataFrame:
    """Add ``running``: the sum of ``weight`` (or the row count) up to each row.

    Rows are ordered by ``order`` inside each ``group``; the order should be
    total. Rows are range partitioned on (group, order), each range is summed on its
    own and the totals of the ranges before it are added, so the work of a hot group is
    shared, whatever its size. Only a caller that gives ``single_task_rows`` has groups
    counted first and, if none is larger, summed by an ordinary window.
    ``df`` is read several times: pass a table that is cheap to read.
    """
    group = list(group)
    amount = F.lit(1).cast("bigint") if weight is None else F.col(weight)
    if single_task_rows is not None:
        sizes = df.groupBy(*group).count() if group else df.groupBy().count()
        largest = sizes.agg(F.max("count")).first()[0] or 0
        if largest <= single_task_rows:
            upto = Window.partitionBy(*group).orderBy(*order)
            return df.withColumn("running", F.sum(amount).over(_so_far(upto)))

    ranges = written(
        df.repartitionByRange(*group, *order).withColumn("_range", F.spark_partition_id()),
        "ranges",
    )
    inside = Window.partitionBy(*group, "_range").orderBy(*order)
    before = Window.partitionBy(*group).orderBy("_range")
    # One row per range and group: the totals are few, whatever the data size.
    offsets = (
        ranges.groupBy(*group, "_range")
        .agg(F.sum(amount).alias("_total"))
        .withColumn("_upto", F.sum("_total").over(_so_far(before)))
        .select(
            *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)],
            F.col("_range").alias("_r"),
            (F.col("_upto") - F.col("_total")).alias("_before"),
        )
    )
    match = F.col("_range") == F.col("_r")
    for i, name in enumerate(group):
        match = match & F.col(name).eqNullSafe(F.col(f"_g{i}"))
    summed = ranges.withColumn("_inside", F.sum(amount).over(_so_far(inside)))
    return summed.join(offsets, match).select(
        *df.columns, (F.col("_inside") + F.col("_before")).alias("running")
    )


def _so_far(window):
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def long_values(df: DataFrame, names: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """Known values of numeric columns, one row per cell."""
    cells = struct_rows(
        [{"variable": F.lit(n), "value": F.col(f"`{n}`").cast("double")} for n in names]
    )
    return df.select(*[F.col(f"`{g}`") for g in group], F.inline(cells)).where(
        F.col("value").isNotNull() & ~F.isnan("value")
    )


def value_counts(
    df: DataFrame, names: Sequence[str], group: Sequence[str] = ()
) -> DataFrame:
    """Distinct values of numeric columns in long form with their counts.

    Output: ``group`` columns, ``variable``, ``value``, ``n``; NULL and NaN are left out.
    Equal values are combined before the shuffle.
    """
    return (
        long_values(df, names, group)
        .groupBy(*group, "variable", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


# ---------------------------------------------------------------- exact quantiles
# Accuracy of the sketches that bracket a quantile: ranks are off by n / ACCURACY at
# most. Brackets reach three times as far to either side.
ACCURACY = 10_000
MARGIN = 3 / ACCURACY


def brackets(
    df: DataFrame, names: Sequence[str], shares: Sequence[float], group: Sequence[str] = ()
) -> DataFrame:
    """Size, moments, extremes and an interval around each wanted quantile.

    One row per column and group; ``low`` and ``high`` hold one bound per share. All of
    it comes from mergeable aggregates in one pass.
    """
    points = [min(max(p + side, 0.0), 1.0) for p in shares for side in (-MARGIN, MARGIN)]
    parts = []
    for i, name in enumerate(names):
        value = F.col(f"`{name}`").cast("double")
        value = F.when(~F.isnan(value), value)
        parts += [
            F.count(value).alias(f"n{i}"),
            F.avg(value).alias(f"mean{i}"),
            F.stddev_samp(value).alias(f"deviation{i}"),
            F.min(value).alias(f"minimum{i}"),
            F.max(value).alias(f"maximum{i}"),
            F.percentile_approx(value, points, ACCURACY).alias(f"bounds{i}"),
        ]
    rows = [
        {
            "variable": F.lit(name),
            "n_known": F.col(f"n{i}"),
            "mean": F.col(f"mean{i}"),
            "deviation": F.col(f"deviation{i}"),
            "minimum": F.col(f"minimum{i}"),
            "maximum": F.col(f"maximum{i}"),
            "low": F.array(*[F.col(f"bounds{i}")[2 * j] for j in range(len(shares))]),
            "high": F.array(*[F.col(f"bounds{i}")[2 * j + 1] for j in range(len(shares))]),
        }
        for i, name in enumerate(names)
    ]
    return df.groupBy(*group).agg(*parts).select(*group, F.inline(struct_rows(rows)))


def _bracketed_counts(
    df: DataFrame, names: Sequence[str], bounds: DataFrame, group: Sequence[str], number: int
) -> DataFrame:
    """Counts of the values inside the brackets; each gap below a bracket is one row.

    Gap rows have ``exact`` false and stand just before the bracket they lead up to.
    Everything above the last bracket is left out, so only a small part of the values
    is ever shuffled.
    """
    keys = [*group, "variable"]
    value, place = F.col("l.value"), F.lit(None)
    for j in reversed(range(number)):
        low, high = F.col("b.low")[j], F.col("b.high")[j]
        inside = F.struct(F.greatest(value, low).alias("value"), (value >= low).alias("exact"))
        place = F.when(value <= high, inside).otherwise(place)
    return (
        long_values(df, names, group).alias("l")
        .join(bounds.alias("b"), same_keys(keys, "l", "b"))
        .where(value <= F.col("b.high")[number - 1])
        .select(*[F.col(f"l.{k}") for k in keys], place.alias("place"))
        .groupBy(*keys, "place.value", "place.exact")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def exact_quantiles(
    df: DataFrame,
    names: Sequence[str],
    shares: dict[str, float],
    group: Sequence[str] = (),
    interpolate: bool = True,
    single_task_rows: int = SINGLE_TASK_ROWS,
) -> DataFrame:
    """Exact quantiles with the statistics of ``brackets``, one row per column and group.

    With ``interpolate`` a quantile lies linearly between its two neighbours, else it is
    the smallest element whose cumulative share reaches the requested one. Sketches
    narrow the search to a sliver of the values, and the sliver is ranked exactly. Should
    a rank lie outside its bracket after all, all values are ranked instead. ``df`` is
    read twice: write a costly view to a table first.
    """
    group = list(group)
    points = sorted(shares.items(), key=lambda item: item[1])
    found = brackets(df, names, [p for _, p in points], group)
    bounds = broadcast_if_small(found) if group else F.broadcast(_one_per_column(found, names))
    counts = written(_bracketed_counts(df, names, bounds, group, len(points)), "ranks")

    def read_off(table: DataFrame) -> DataFrame:
        picked = _picked(table, bounds, dict(points), group, interpolate, single_task_rows)
        return written(picked, "quantiles") if group else _one_per_column(picked, names)

    picked = read_off(counts)
    if picked.where("missed").limit(1).count():
        whole = value_counts(df, names, group).withColumn("exact", F.lit(True))
        picked = read_off(written(whole, "ranks"))
    return picked.drop("missed")


def _one_per_column(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """A result with one row per column, kept as a local table."""
    return df.sparkSession.createDataFrame(to_driver(df, len(names)), df.schema)


def _picked(
    counts: DataFrame,
    bounds: DataFrame,
    shares: dict[str, float],
    group: Sequence[str],
    interpolate: bool,
    single_task_rows: int,
) -> DataFrame:
    """Read the wanted ranks off the counts; ``missed`` tells that one was not found."""
    keys = [*group, "variable"]
    ranked = running_totals(counts, ["value", "exact"], "n", keys, single_task_rows)
    placed = (
        ranked.alias("r")
        .join(bounds.alias("b"), same_keys(keys, "r", "b"))
        .select(
            *[F.col(f"r.{c}") for c in [*keys, "value", "exact", "n", "running"]], "b.n_known"
        )
    )
    first, last, rows = F.col("running") - F.col("n"), F.col("running") - 1, F.col("n_known")

    def at(position: Column) -> Column:
        hit = (first <= position) & (position <= last) & F.col("exact")
        return F.max(F.when(hit, F.col("value")))

    parts, results = [], []
    for name, share in shares.items():
        if interpolate:
            point = (rows - 1) * F.lit(float(share))
            parts += [at(F.floor(point)).alias(f"_lo_{name}"), at(F.ceil(point)).alias(f"_hi_{name}")]
            low, high = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
            results.append((low + (high - low) * (point - F.floor(point))).alias(name))
        else:
            point = F.greatest(F.ceil(rows * F.lit(float(share))) - 1, F.lit(0))
            parts.append(at(point).alias(f"_at_{name}"))
            results.append(F.col(f"_at_{name}").alias(name))
    picks = placed.groupBy(*keys).agg(*parts)
    # Columns without any known value have no pick and keep their row, with NULLs.
    every = bounds.drop("low", "high").alias("b").join(
        picks.alias("p"), same_keys(keys, "b", "p"), "left"
    )
    missed = reduce(lambda a, b: a | b, [F.col(name).isNull() for name in shares])
    return every.select(
        *[F.col(f"b.{c}") for c in [*keys, "n_known", "mean", "deviation", "minimum", "maximum"]],
        *results,
    ).withColumn("missed", missed & (rows > 0))
