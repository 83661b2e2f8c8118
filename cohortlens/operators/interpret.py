"""Describing clusters: sizes, averages, dominant values, tokens, readable names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortlens.functions.fixed import (
    EMPTY_CATEGORY,
    INACTIVE_DRUG,
    LEVEL_NAMES,
    OPEN_NAMES,
    SCORE_NAMES,
)
from cohortlens.operators.profile import category_shares



def all_clusters():
    """A window over a whole profile: one row per cluster, never the clustered rows."""
    return Window.partitionBy()


# ---------------------------------------------------------------- profiles
def cluster_ids(df: DataFrame, prediction: str = "prediction") -> DataFrame:
    return df.select(prediction).distinct().orderBy(prediction)


def cluster_sizes(df: DataFrame, prediction: str = "prediction") -> DataFrame:
    return df.groupBy(prediction).agg(F.count(F.lit(1)).alias("n")).orderBy(prediction)


def averages(
    df: DataFrame, names: dict[str, str], prediction: str = "prediction"
) -> DataFrame:
    """Mean of each column per cluster; ``names`` maps column to output name."""
    return df.groupBy(prediction).agg(*[F.avg(c).alias(out) for c, out in names.items()])


def averages_by_dict(
    df: DataFrame, functions: dict[str, str], prediction: str = "prediction"
) -> DataFrame:
    """Aggregates given as column -> function name, named ``<function>_<column>``."""
    done = df.groupBy(prediction).agg(functions)
    return done.withColumnsRenamed(
        {f"{'avg' if f in ('avg', 'mean') else f}({c})": f"{f}_{c}" for c, f in functions.items()}
    )


def profile_with_rate(
    df: DataFrame, names: dict[str, str], event: Column, prediction: str = "prediction"
) -> DataFrame:
    """Size, means and number of rows with an event per cluster."""
    return df.groupBy(prediction).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(c).alias(out) for c, out in names.items()],
        F.count_if(event).alias("events"),
    )


def with_rate(profile: DataFrame, part: str = "events", whole: str = "n") -> DataFrame:
    """Percentage of one count in another, half-even rounded to two places."""
    return profile.withColumn("rate", F.bround(F.col(part) * 100.0 / F.col(whole), 2))


def normalised(profile: DataFrame, names: Sequence[str]) -> DataFrame:
    """Each mean moved to its place between the smallest and largest cluster."""
    return profile.withColumns(
        {
            n: (F.col(n) - F.min(n).over(all_clusters()))
            / (F.max(n).over(all_clusters()) - F.min(n).over(all_clusters()) + 1e-6)
            for n in names
        }
    )


def dominant_values(
    df: DataFrame, names: Sequence[str], prediction: str = "prediction", rows: int = 3
) -> DataFrame:
    """The most frequent values of each column in each cluster, with their share.

    The bound on the row number reaches the map side, so a task passes on only
    ``rows`` values per cluster and column.
    """
    shares = category_shares(df, names, [prediction])
    order = Window.partitionBy(prediction, "variable").orderBy(F.desc("n"), F.asc("value"))
    return (
        shares.withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= rows)
        .withColumn("percent", F.bround("percent", 2))
    )


def cluster_tokens(
    df: DataFrame, categories: Sequence[str], drugs: Sequence[str], prediction: str = "prediction"
) -> DataFrame:
    """Count of each ``column=value`` and each active ``drug_value`` per cluster."""
    parts = [_token(c, "=", EMPTY_CATEGORY).alias(c) for c in categories]
    parts += [_token(d, "_", INACTIVE_DRUG).alias(d) for d in drugs]
    wide = df.select(prediction, *parts)
    return (
        wide.unpivot([prediction], [*categories, *drugs], "column", "token")
        .where("token is not null")
        .groupBy(prediction, "token")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def drug_tokens(df: DataFrame, key: str, drugs: Sequence[str]) -> DataFrame:
    """The active drugs of each row as ``drug_value``."""
    wide = df.select(key, *[_token(d, "_", INACTIVE_DRUG).alias(d) for d in drugs])
    return wide.unpivot([key], list(drugs), "column", "token").where("token is not null").drop(
        "column"
    )


def _token(name: str, joint: str, none: Sequence[str]) -> Column:
    value = F.col(name).cast("string")
    return F.when(~value.isin(*none), F.concat(F.lit(f"{name}{joint}"), value))


# ---------------------------------------------------------------- ranks and names
def average_rank(profile: DataFrame, score: str, out: str) -> DataFrame:
    """Rank by falling score; equal scores share the whole part of their mean rank."""
    falling = Window.orderBy(F.desc(score))
    ties = Window.partitionBy(score)
    mean_rank = F.rank().over(falling) + (F.count(F.lit(1)).over(ties) - 1) / 2
    return profile.withColumn(out, F.floor(mean_rank).cast("int"))


def leaders(
    profile: DataFrame, first: Column, second: Column, prediction: str = "prediction"
) -> DataFrame:
    """Mark the cluster with the highest ``first`` score as place 1, the one with the
    highest ``second`` score among the others as 2, and number the rest by id."""
    by_first = Window.orderBy(F.desc(first), F.asc(prediction))
    top = profile.withColumn("_top", (F.row_number().over(by_first) == 1).cast("int"))
    by_second = Window.orderBy("_top", F.desc(second), F.asc(prediction))
    marked = top.withColumn(
        "_role",
        F.when(F.col("_top") == 1, 1).when(F.row_number().over(by_second) == 1, 2).otherwise(3),
    )
    by_id = Window.orderBy("_role", prediction)
    return marked.withColumn("place", F.row_number().over(by_id)).drop("_top", "_role")


def numbered_labels(
    named: DataFrame, label: str = "name", prediction: str = "prediction"
) -> DataFrame:
    """Number repeated labels from the second on."""
    same = Window.partitionBy(label).orderBy(prediction)
    nth = F.row_number().over(same)
    return named.withColumn("_nth", nth).withColumn(
        label,
        F.when(F.col("_nth") == 1, F.col(label)).otherwise(
            F.concat(F.col(label), F.lit(" (subgrupo "), F.col("_nth"), F.lit(")"))
        ),
    ).drop("_nth")


def named_by_level(
    profile: DataFrame,
    stay: str = "stay",
    drugs: str = "drugs",
    labs: str = "labs",
    inpatient: str = "inpatient",
    emergency: str = "emergency",
    prediction: str = "prediction",
    names: dict[str, str] = LEVEL_NAMES,
) -> DataFrame:
    """Name each cluster by where its means lie between the extremes of all clusters."""

    def level(column: str) -> Column:
        low, high = F.min(column).over(all_clusters()), F.max(column).over(all_clusters())
        return F.when(high > low, (F.col(column) - low) / (high - low)).otherwise(0.5)

    levels = profile.withColumns(
        {
            "_recurrence": (level(inpatient) + level(emergency)) / 2,
            "_intensity": (level(drugs) + level(stay)) / 2,
            "_labs": level(labs),
        }
    )
    recurrence, intensity, lab = F.col("_recurrence"), F.col("_intensity"), F.col("_labs")
    tests = [
        (recurrence > 0.6, "recurrent"),
        ((lab > 0.6) & (recurrence < 0.5), "evaluation"),
        (intensity > 0.6, "drug"),
        ((lab > 0.4) & (recurrence < 0.4), "followup"),
        (intensity > 0.4, "adjusted"),
        (F.lit(True), "low"),
    ]
    name = F.coalesce(*[F.when(test, F.lit(names[label])) for test, label in tests])
    named = levels.withColumn("name", name).drop("_recurrence", "_intensity", "_labs")
    return numbered_labels(named, "name", prediction)


def recurrence_score(inpatient: str, emergency: str) -> Column:
    return F.col(inpatient) + F.col(emergency)


def intensity_score(stay: str, drugs: str, labs: str) -> Column:
    return F.col(stay) + F.col(drugs) / 5 + F.col(labs) / 10


def named_by_score(
    profile: DataFrame, first: Column, second: Column, prediction: str = "prediction",
    names: dict[str, str] = SCORE_NAMES,
) -> DataFrame:
    """Most recurrent cluster, most intensive of the others, and routine for the rest.

    Without a ``mixed`` name every other cluster is routine; with it only the first is
    and the following ones are numbered.
    """
    placed = leaders(profile, first, second, prediction)
    place = F.col("place")
    rest = F.lit(names["routine"])
    if "mixed" in names:
        rest = F.when(place == 3, rest).otherwise(
            F.concat(F.lit(names["mixed"]), (place - 3).cast("string"))
        )
    name = (
        F.when(place == 1, names["recurrent"]).when(place == 2, names["complex"]).otherwise(rest)
    )
    return placed.withColumn("name", name).drop("place")


def named_open_ended(
    profile: DataFrame, first: Column, second: Column, prediction: str = "prediction"
) -> DataFrame:
    return named_by_score(profile, first, second, prediction, OPEN_NAMES)
