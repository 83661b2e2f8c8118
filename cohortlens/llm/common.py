"""Helpers the text operators share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from cohortlens.sources.scratch import written

# White space of the word rule ``[^\x20\x09-\x0D]+``, as a Java and Python character class.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def utf8(text: str | None) -> bytes:
    """UTF-8 of a text; null counts as empty."""
    return (text or "").encode("utf-8", "surrogatepass")


def release_memory() -> None:
    """Return what a reused Python worker has freed to the system, where the C library can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def map_rows(
    df: DataFrame,
    make: Callable[[Iterable[tuple]], Iterable[tuple]],
    schema: T.StructType,
    rows_per_batch: int = 4096,
) -> DataFrame:
    """Rows of ``df`` through a Python generator, moved in Arrow batches of bounded size.

    ``make`` gets the rows of one partition as an iterator and yields output rows; at most
    one batch in and one batch out are held.
    """
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for start in range(0, batch.num_rows, 1024):
                    part = batch.slice(start, 1024)
                    yield from zip(*(column.to_pylist() for column in part.columns), strict=True)

        held: list[tuple] = []
        try:
            for row in make(rows()):
                held.append(row)
                if len(held) >= rows_per_batch:
                    yield _batch(held, arrow)
                    held = []
            if held:
                yield _batch(held, arrow)
        finally:
            held = []
            release_memory()

    return df.mapInArrow(run, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    arrays = [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def is_empty(df: DataFrame) -> bool:
    return not df.take(1)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (columns a, b of long): one row ``(node, root)``.

    The root is the smallest node of the component. Alternates the two star contractions of
    distributed component search until the edges are stars; every round is written to the
    shared folder, so a lost executor repeats one round at most. Each round holds at most one
    row per edge; nothing passes through the driver but three sums per round.
    """
    pairs = written(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "edges"
    )
    while True:
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # Each edge gives one: neighbours larger than a node move to its smallest neighbour.
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(large, "large-star")
        if _signature(large) == _signature(pairs):
            break  # the large star leaves stars, and nothing else, as they are
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        pairs = written(moved.union(least.select("a", F.col("m").alias("b"))).distinct(), "small-star")
    pairs = pairs.distinct()
    roots = pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())


#: Rows of one group are numbered in buckets of about so many.
BUCKET_ROWS = 50_000


def numbered(rows: DataFrame, group: list[str], order: list[str], total: int) -> DataFrame:
    """Adds ``number``: 0, 1, ... within each group, without one task for a large group.

    Rows are dealt into buckets by the hash of their order columns; buckets are counted, and
    the counts of earlier buckets are added to the number within the bucket. ``total`` is the
    number of all rows. Group columns must not be null.
    """
    buckets = max(1, total // BUCKET_ROWS)
    keys = ", ".join(group)
    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    sizes = dealt.groupBy(*group, "bucket").agg(F.count(F.lit(1)).alias("bucket_rows"))
    before = sizes.select(
        *group,
        "bucket",
        F.expr(f"sum(bucket_rows) over (partition by {keys} order by bucket) - bucket_rows").alias("before"),
    )
    inner = F.expr(f"row_number() over (partition by {keys}, bucket order by {', '.join(order)}) - 1")
    return (
        dealt.withColumn("inner", inner)
        .join(before, [*group, "bucket"])
        .withColumn("number", F.col("before") + F.col("inner"))
        .drop("bucket", "inner", "before")
    )


def _signature(pairs: DataFrame) -> tuple:
    """Count and order-free sums of a table of pairs."""
    digest = F.xxhash64("a", "b")
    return tuple(pairs.agg(F.count(F.lit(1)), F.bit_xor(digest), F.sum(F.shiftright(digest, 16))).first())


def map_arrays(
    df: DataFrame, make: Callable[[Iterable[tuple]], Iterable[tuple]], schema: T.StructType, rows: int = 1 << 16
) -> DataFrame:
    """Like :func:`map_rows`, for makers that yield whole columns: one tuple of equally long
    arrays for each input row. Output batches hold about ``rows`` rows."""
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def read() -> Iterator[tuple]:
            for batch in batches:
                for start in range(0, batch.num_rows, 256):
                    part = batch.slice(start, 256)
                    yield from zip(*(column.to_pylist() for column in part.columns), strict=True)

        held: list[tuple] = []
        size = 0
        try:
            for columns in make(read()):
                held.append(columns)
                size += len(columns[0])
                if size >= rows:
                    yield _joined(held, arrow)
                    held, size = [], 0
            if held:
                yield _joined(held, arrow)
        finally:
            held = []
            release_memory()

    return df.mapInArrow(run, schema)


def _joined(parts: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [
        pa.concat_arrays([pa.array(part[i], type=field.type) for part in parts]) for i, field in enumerate(schema)
    ]
    return pa.RecordBatch.from_arrays(columns, schema=schema)
