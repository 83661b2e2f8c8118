"""Shards of near-equal size in bytes, by sampled splitters over the texts' hashes.

Law: ``bytes``. Records are ordered by the hash of their text, so equal texts stand side by
side and mostly share a shard. A size-weighted sample of the hashes gives the splitters of
many ranges; each range is measured in full, ranges that are overfull are subdivided, and
neighbouring units are dealt to the shards by running bytes. The rows of a text that alone is
too large for a unit are spread over several, whatever their ids. DataFrame functions only.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.sources.scratch import written

SHARDS = 16
RANGES = 1024
#: Expected keys in the sample, per range.
SAMPLE_PER_RANGE = 32
#: A unit holds about so many rows at most, so that its rows are numbered in one task.
UNIT_ROWS = 1_000_000
LAW = "bytes"


def splitters(sample: list[tuple[int, int]], ranges: int) -> list[int]:
    """Distinct keys that cut the weighted sample ``(key, weight)`` into about equal parts."""
    ordered = sorted(sample)
    running = list(accumulate(weight for _, weight in ordered))
    if not running:
        return []
    cuts = {ordered[min(bisect_right(running, running[-1] * i / ranges), len(ordered) - 1)][0] for i in range(1, ranges)}
    return sorted(cuts)


def range_of(key: Column, cuts: list[int]) -> Column:
    """Number of splitters at most ``key``, looked up in two steps of about equal length."""
    width = max(1, int(len(cuts) ** 0.5))
    parts = [cuts[i : i + width] for i in range(0, len(cuts), width)] or [[]]
    longs = lambda values: F.array(*(F.lit(v).cast("long") for v in values)) if values else F.array().cast("array<long>")
    up_to = lambda values: F.size(F.filter(values, lambda v: v <= key))
    part = up_to(longs([p[0] for p in parts[1:]]))
    inner = up_to(F.element_at(F.array(*(longs(p) for p in parts)), part + 1))
    return part * width + inner


def shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", number: int = SHARDS) -> DataFrame:
    """One row per row of ``docs`` with its shard and its slot there.

    ``size`` is the text's UTF-8 bytes plus one; a null text is empty. Shards differ from an
    equal share by about one unit's bytes, or by the longest text if that is more, also where
    many rows share a text and an id or have neither. Slots are 0, 1, ... in each shard, ordered
    by text hash and id; equal rows are told apart in no defined way. Rows of a text that is
    too large for a unit are spread by their place in the table, so their shards may change if
    the table is stored in another way. A null id is ordinary.
    Other columns are not read; an empty table gives an empty table. The driver gets the sample and one row per unit, whose numbers are set by the
    parameters and by rows over ``UNIT_ROWS``.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = written(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
            F.xxhash64(text).alias("key"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "rows",
    )
    count, total = rows.agg(F.count(F.lit(1)), F.sum("size")).first()
    total = total or 0
    sampled = RANGES * SAMPLE_PER_RANGE
    chance = F.pmod(F.xxhash64("doc_id", "key", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    weight = F.floor(F.col("size") * (sampled / max(total, 1)) + chance)
    sample = rows.select("key", weight.alias("weight")).filter("weight > 0").collect()
    cuts = splitters([tuple(r) for r in sample], RANGES)

    # Texts that alone hold more than a range should: at most two for each range.
    heavy = rows.groupBy("key").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n"))
    heavy = heavy.filter((F.col("b") * RANGES > total) & (F.col("n") > 1) | (F.col("n") * RANGES > count) & (F.col("n") > RANGES))
    heavy = [(r["key"], _units(r["b"], r["n"], total)) for r in heavy.collect()]
    session = docs.sparkSession
    spread = session.createDataFrame(heavy, "key long, spread long")
    placed = rows.join(F.broadcast(spread), "key", "left").withColumn("range", range_of(F.col("key"), cuts))
    own_key = F.when(F.col("spread").isNotNull(), F.col("key"))
    placed = placed.withColumn("own", own_key)

    ranges = placed.filter("own is null").groupBy("range").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n"))
    divided = [(r["range"], _units(r["b"], r["n"], total)) for r in ranges.collect()]
    division = session.createDataFrame(divided, "range int, division long")
    unit = F.when(
        F.col("own").isNotNull(), F.pmod(F.xxhash64("row", F.lit("spread")), F.col("spread"))
    ).otherwise(F.pmod(F.xxhash64("key", F.lit("unit")), F.col("division")))
    placed = placed.join(F.broadcast(division), "range", "left").select(
        "doc_id", "size", "text_crc32", "key", "range", F.coalesce("own", F.lit(0)).alias("own"), unit.alias("unit")
    )

    measured = placed.groupBy("range", "own", "unit").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n"))
    found, bytes_before, rows_before = [], 0, [0] * number
    for r in sorted(measured.collect(), key=lambda r: (r["range"], r["own"], r["unit"])):
        shard = min(number - 1, (2 * bytes_before + r["b"]) * number // (2 * total))
        found.append((r["range"], r["own"], r["unit"], shard, rows_before[shard]))
        bytes_before += r["b"]
        rows_before[shard] += r["n"]
    units = session.createDataFrame(found, "range int, own long, unit long, shard int, first_slot long")
    slot = F.expr("row_number() over (partition by range, own, unit order by key, doc_id, text_crc32) - 1")
    return (
        placed.withColumn("inner", slot)
        .join(F.broadcast(units), ["range", "own", "unit"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit(LAW).alias("law"),
            "shard",
            (F.col("first_slot") + F.col("inner")).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )


def _units(size: int, rows: int, total: int) -> int:
    return max(1, -(-size * RANGES // max(total, 1)), -(-rows // UNIT_ROWS))
