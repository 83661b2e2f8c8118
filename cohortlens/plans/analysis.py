"""The whole analysis: features, search, choice, profile and names; and the text side."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions import text as X
from cohortlens.operators import clusters as CL
from cohortlens.operators import features as FE
from cohortlens.operators import interpret as IN
from cohortlens.operators import rows as R
from cohortlens.operators import spelling as SP
from cohortlens.operators import text as TX
from cohortlens.sources.scratch import written
from cohortlens.sources.tables import to_driver


@dataclass
class Segmentation:
    """Rows with their cluster, everything that was tried, and the named profile."""

    rows: DataFrame
    tried: DataFrame
    chosen: CL.Clustering
    report: DataFrame


def segment(
    df: DataFrame,
    key: str,
    categories: Sequence[str],
    codes: Sequence[str],
    numeric: Sequence[str],
    measures: dict[str, str],
    k_pca: int = 3,
    ks: Sequence[int] = tuple(range(2, 9)),
    scaler: str = "minmax",
    partitions: int | None = None,
) -> Segmentation:
    """Cluster the rows of a wide table and describe the clusters.

    ``categories`` are one-hot encoded, ``codes`` only indexed. ``measures`` maps the
    columns to average to the names the report and the namer use.
    """
    used = R.distinct_names([key], categories, codes, numeric, measures)
    # Every estimator reads the rows again, so they are prepared and written once.
    repaired = written(R.fill_unknown(df.select(*used), [*categories, *codes]), "prepared")
    _, ready = FE.fit_features(repaired, categories, codes, numeric, scaler)
    chosen, tried = CL.choose(
        ready.select(key, "scaled"), key, k_pca=k_pca, ks=ks, partitions=partitions
    )
    clustered = R.attach(chosen.rows.select(key, "prediction"), repaired, key)
    report = IN.named_by_level(IN.averages(clustered, measures))
    return Segmentation(clustered, tried, chosen, report)


def found_corrections(
    df: DataFrame, column: str, vocabulary: DataFrame, checked: int = 200, reported: int = 20
) -> dict[str, str]:
    """Spelling corrections found in the text itself; at most ``reported`` of them."""
    counts = TX.word_counts(df, column, min_length=3)
    rows = to_driver(SP.suggestions(counts, vocabulary, checked, reported), reported)
    return {row.word: row.suggestion for row in rows}


def prepare_text(
    df: DataFrame, parts: Sequence[str], vocabulary: DataFrame | None = None
) -> DataFrame:
    """Compose, clean, split and filter a text; adds ``text``, ``clean``, ``words``,
    ``kept`` and ``final``."""
    composed = R.compose_text(df, parts)
    read = composed
    if vocabulary is not None:
        found = found_corrections(composed, "text", vocabulary)
        read = composed.withColumn("_read", X.correct_by_map(F.col("text"), found))
    source = "text" if vocabulary is None else "_read"
    cleaned = TX.clean_text(read, source, "clean", drop_blank=True).drop("_read")
    split = cleaned.withColumn("words", X.tokens(F.col("clean")))
    return TX.without_stop_words(split, "words", "kept").withColumn(
        "final", F.array_join("kept", " ")
    )
