"""Sources, sinks and the two bounded crossings between driver and cluster."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.sources.scratch import written


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One parquet table of a data folder, read as it lies."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """CSV with a header line. A given schema saves the extra pass of inference."""
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def local_rows(
    spark: SparkSession, rows: Iterable[Sequence], schema: T.StructType | str
) -> DataFrame:
    """Rules, word lists and result records as a DataFrame. Never row data."""
    return spark.createDataFrame([tuple(row) for row in rows], schema)


def to_driver(df: DataFrame, max_rows: int = 10_000) -> list[Row]:
    """Bring a result to the driver only if it has at most ``max_rows`` rows."""
    rows = df.take(max_rows + 1)
    if len(rows) > max_rows:
        raise ValueError(f"result has more than {max_rows} rows; write it to a table instead")
    return rows


def written_bytes(df: DataFrame) -> int:
    """Bytes of the files a written table consists of."""
    hadoop = df.sparkSession._jsc.hadoopConfiguration()
    jvm = df.sparkSession._jvm
    size = 0
    for name in df.inputFiles():
        path = jvm.org.apache.hadoop.fs.Path(name)
        size += path.getFileSystem(hadoop).getFileStatus(path).getLen()
    return size


def broadcast_if_small(
    df: DataFrame, max_rows: int = 10_000, max_bytes: int = 8 << 20
) -> DataFrame:
    """A join side that is broadcast only after its rows and bytes were found to be few.

    It is computed and written once; what is broadcast is the written table. A larger one is
    left to Spark's own choice of join.
    """
    side = written(df, "side")
    few = len(side.limit(max_rows + 1).select(F.lit(1)).collect()) <= max_rows
    return F.broadcast(side) if few and written_bytes(side) <= max_bytes else side


def head(df: DataFrame, order: str | Sequence[str], rows: int = 5) -> DataFrame:
    """First rows in key order, so that the preview is the same on every run."""
    keys = [order] if isinstance(order, str) else list(order)
    return df.orderBy(*keys).limit(rows)


def shape(df: DataFrame) -> DataFrame:
    """One row: number of rows and of columns."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns)).cast("bigint")
    )
