"""A table of hospital-like encounters derived from the order tables.

Each order plays one encounter: customer and order attributes play the
demographic and drug columns, its line items the coded texts and the counts.
Orders without items have NULL there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.sources.tables import read_table

CATEGORICAL = ["race", "gender", "age", "metformin", "insulin"]
DIAGNOSES = ["diag_1", "diag_2", "diag_3"]
NUMERIC = [
    "time_in_hospital",
    "num_medications",
    "num_lab_procedures",
    "num_procedures",
    "number_diagnoses",
    "number_inpatient",
    "number_outpatient",
    "number_emergency",
]


def item_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with their part, reduced to one row per order.

    The brands of an order are collected as a set, no more than there are brands: counting
    them as distinct shuffles nearly every line item twice, with all the other facts.
    """
    items = read_table(spark, folder, "lineitem")
    parts = read_table(spark, folder, "part")
    flag = F.col("l_returnflag") == "R"
    shipped = F.col("l_linestatus") == "F"
    return (
        items.join(parts, items.l_partkey == parts.p_partkey)
        .groupBy("l_orderkey")
        .agg(
            F.min("p_type").alias("medical_specialty"),
            F.min("p_brand").alias("diag_1"),
            F.max("p_brand").alias("diag_2"),
            F.max("p_name").alias("diag_3"),
            F.max("l_returnflag").alias("returned"),
            F.count(F.lit(1)).alias("time_in_hospital"),
            F.sum("l_quantity").cast("bigint").alias("num_medications"),
            F.max("p_size").cast("bigint").alias("num_lab_procedures"),
            F.count_if(F.col("l_tax") > 0.04).alias("num_procedures"),
            F.size(F.collect_set("p_brand")).cast("bigint").alias("number_diagnoses"),
            F.sum(flag.cast("bigint")).alias("number_inpatient"),
            F.count_if(F.col("l_returnflag") == "A").alias("number_outpatient"),
            F.sum(shipped.cast("bigint")).alias("number_emergency"),
        )
    )


def encounters(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(spark, folder, "orders")
    customers = read_table(spark, folder, "customer")
    facts = item_facts(spark, folder)
    price = F.col("o_totalprice")
    return (
        orders.join(customers, orders.o_custkey == customers.c_custkey)
        .join(facts, orders.o_orderkey == facts.l_orderkey, "left")
        .select(
            F.col("o_orderkey").alias("encounter_id"),
            F.col("o_custkey").alias("patient_nbr"),
            F.col("c_mktsegment").alias("race"),
            F.col("o_orderstatus").alias("gender"),
            F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "?")
            .otherwise(F.col("o_orderpriority"))
            .alias("age"),
            "medical_specialty",
            *DIAGNOSES,
            F.when(F.col("returned") == "R", "<30").otherwise("NO").alias("readmitted"),
            F.when(F.col("c_acctbal") < 3000, "No").otherwise("Steady").alias("metformin"),
            F.when(price < 100000, "No")
            .when(price < 250000, "Steady")
            .otherwise("Up")
            .alias("insulin"),
            *NUMERIC,
        )
    )


def grouped_encounters(spark: SparkSession, folder: str) -> DataFrame:
    """Encounters with a ``prediction`` column any SQL engine can compute:
    the number of returned items, with three and more in one group."""
    returned = F.coalesce(F.col("number_inpatient"), F.lit(0))
    return encounters(spark, folder).withColumn(
        "prediction", F.least(returned, F.lit(3)).cast("int")
    )
