"""The registered queries of these operators: each over its whole table, with its own settings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortlens.llm import (
    extraction,
    infill,
    jaccard,
    licenses,
    merkle,
    mixture,
    outliers,
    packing,
    shards,
    simhash,
    suffixes,
    toxicity,
    whitening,
)
from cohortlens.llm.common import table
from cohortlens.queries import Registry

registry = Registry()


@registry.add("op1_license_scan")
def license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.license_scan(table(spark, folder, "documents"))


@registry.add("op2_simhash_near_dedup")
def simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


@registry.add("op3_toxicity")
def toxicity_scores(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


@registry.add("op4_quality_rules")
def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return outliers.quality(table(spark, folder, "documents"))


@registry.add("op5_html_extraction")
def html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return extraction.extract(table(spark, folder, "pages"))


@registry.add("op6_best_fit_packing")
def best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


@registry.add("op7_sharding")
def sharding(spark: SparkSession, folder: str) -> DataFrame:
    return shards.shards(table(spark, folder, "documents"))


@registry.add("op8_document_fingerprints")
def document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return merkle.fingerprints(table(spark, folder, "documents"))


@registry.add("op9_suffix_array_dedup")
def suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.repeats(table(spark, folder, "documents"))


@registry.add("op10_source_mixture")
def source_mixture(spark: SparkSession, folder: str) -> DataFrame:
    return mixture.mixture(table(spark, folder, "documents")).drop("source", "copies")


@registry.add("op11_fill_in_middle", infill.SQL)
def fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    return infill.digests(infill.fill_in_middle(table(spark, folder, "documents")))


@registry.add("op12_embedding_whitening")
def embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))


@registry.add("op13_ngram_jaccard_join", jaccard.SQL)
def ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.classes(table(spark, folder, "documents"))
