"""Mixing sources to target weights by fitting each source's budget as a subset sum.

Documents are counted by exact length in words. A source's target is met by whole copies of
the source, then by an even share of the documents of each length, and the words still
missing by a bounded-knapsack programme over the lengths left. The chosen numbers of
documents per length are then drawn in a seeded order.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import WORD, is_empty, numbered
from cohortlens.sources.scratch import written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_COPIES = 2
SEED = 11
#: Words the knapsack programme is left to fit, at least; larger remainders are filled greedily.
KNAPSACK_WORDS = 20_000


def targets(
    sizes: Sequence[tuple[str | None, int]],
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST_COPIES,
) -> dict[str | None, float]:
    """Target words per source. Weights go round the sources by code point, null last.

    A target stops at ``most`` times its source; what is cut off is shared again by weight
    among the others until no target is above.
    """
    ordered = sorted(sizes, key=lambda x: (x[0] is None, x[0] or ""))
    weight = {name: weights[i % len(weights)] for i, (name, _) in enumerate(ordered)}
    size = dict(ordered)
    budget = share * sum(size.values())
    open_, out = set(size), {}
    while open_:
        each = budget / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * each > most * size[s]}
        if not over:
            out |= {s: weight[s] * each for s in open_}
            break
        for s in over:
            out[s] = float(most * size[s])
            budget -= out[s]
        open_ -= over
    return out


def fit(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take so that their words come close to
    ``budget``. Lengths are distinct; ``counts`` says how many there are."""
    total = int((lengths * counts).sum())
    if budget >= total:
        return counts.copy()
    taken = np.floor(counts * (budget / total)).astype(np.int64)
    left = budget - int((lengths * taken).sum())
    free = counts - taken
    descending = np.argsort(-lengths)
    for i in descending:  # greedy, down to what the programme fits exactly
        length = int(lengths[i])
        if length and left - length >= KNAPSACK_WORDS:
            more = min(int(free[i]), (left - KNAPSACK_WORDS) // length)
            taken[i] += more
            free[i] -= more
            left -= more * length
    return taken + knapsack(lengths, free, left)


def knapsack(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Bounded subset sum by dynamic programming on a bit set of reachable sums.

    Finds the sum nearest to ``budget``, the lower one of two as near; sums beyond twice the
    budget are never nearer than taking nothing.
    """
    out = np.zeros(len(lengths), np.int64)
    if budget <= 0:
        return out
    mask = (1 << (2 * budget + 1)) - 1
    reach = 1
    steps: list[tuple[int, int, int]] = []  # the sums reachable before, the length's place, how many
    for i in np.argsort(-lengths):
        length = int(lengths[i])
        if not 0 < length <= 2 * budget:
            continue
        have, part = min(int(counts[i]), 2 * budget // length), 1
        while have:  # 1, 2, 4, ... and the rest make every number up to all
            part = min(part, have)
            steps.append((reach, int(i), part))
            reach |= (reach << (length * part)) & mask
            have -= part
            part *= 2
        if reach >> budget & 1:
            break
    below = (reach & ((1 << (budget + 1)) - 1)).bit_length() - 1
    above = reach >> (budget + 1)
    first_above = budget + (above & -above).bit_length() if above else 3 * budget
    best = below if budget - below <= first_above - budget else first_above
    for before, i, part in reversed(steps):
        if not before >> best & 1:
            out[i] += part
            best -= part * int(lengths[i])
    return out


def mixture(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST_COPIES,
    seed: int = SEED,
) -> DataFrame:
    """One row per row of ``docs``: how many copies of it the mix takes.

    Columns: doc_id, source, size (words), source_size, target, copies, taken (words). A null
    text has no words; a null source is a source of its own, the last. A source without words
    has target 0. Rows with equal ids count each for itself; ties in the seeded order can only
    be between rows equal in id, source and size. Other columns are not read. An empty table
    gives an empty table. The driver gets one row per source; a task gets the length counts of
    one source.
    """
    rows = written(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            F.col(source_col).alias("source"),
            F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("")).alias("mix_key"),
            F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            F.xxhash64(F.lit(seed), F.col(id_col)).alias("draw"),
        ),
        "sizes",
    )
    counted = written(rows.groupBy("mix_key", "size").agg(F.count(F.lit(1)).alias("n")), "lengths")
    sums = counted.groupBy("mix_key").agg(F.sum(F.col("size") * F.col("n")).alias("words"), F.sum("n").alias("n")).collect()
    goal = targets([(r["mix_key"][1:] or "" if r["mix_key"] else None, r["words"]) for r in sums], weights, share, most)
    session = docs.sparkSession
    goals = session.createDataFrame(
        [(r["mix_key"], r["words"], float(goal[r["mix_key"][1:] if r["mix_key"] else None])) for r in sums],
        "mix_key string, source_size long, target double",
    )

    def choose(lengths: pd.DataFrame) -> pd.DataFrame:
        lengths = lengths.sort_values("size")
        words, target = int(lengths["source_size"].iloc[0]), float(lengths["target"].iloc[0])
        whole = min(int(target // words), most) if words else 0
        extra = fit(lengths["size"].to_numpy(), lengths["n"].to_numpy(), round(target - whole * words))
        if whole == most:
            extra[:] = 0
        return lengths.assign(whole=whole, extra=extra)[
            ["mix_key", "size", "source_size", "target", "whole", "extra"]
        ]

    chosen = written(
        counted.join(goals, "mix_key")
        .groupBy("mix_key")
        .applyInPandas(choose, "mix_key string, size long, source_size long, target double, whole long, extra long"),
        "chosen",
    )
    ranked = numbered(rows, ["mix_key", "size"], ["draw", "doc_id"], sum(r["n"] for r in sums))
    copies = F.col("whole") + F.when(F.col("number") < F.col("extra"), 1).otherwise(0)
    return ranked.join(chosen, ["mix_key", "size"]).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with their columns."""
    found = written(mixture(docs, id_col, text_col, source_col), "mixture")
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    names = docs.columns
    own = docs.select(
        F.struct("*").alias("row"), F.col(id_col).cast("long").alias("i"), F.col(source_col).alias("s"), size.alias("w")
    )
    same = lambda a, b: a["i"].eqNullSafe(b["doc_id"]) & a["s"].eqNullSafe(b["source"]) & (a["w"] == b["size"])
    keys = written(
        found.groupBy("doc_id", "source", "size").agg(F.min("copies").alias("copies"), F.sum("copies").alias("all"), F.count(F.lit(1)).alias("n")),
        "copies",
    )
    even = keys.filter("copies * n = all and copies > 0")
    out = own.join(even, same(own, even)).select("row", "copies")
    uneven = keys.filter("copies * n <> all")
    if not is_empty(uneven):
        # Rows equal in id, source and size of which the mix takes some more often than others.
        rows = own.join(uneven, same(own, uneven)).select(
            "row",
            F.expr("copies + if(row_number() over (partition by i, s, w order by row) <= all - copies * n, 1, 0)").alias("copies"),
        )
        out = out.union(rows.filter("copies > 0"))
    repeats = out.withColumn("again", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))))
    return repeats.select(*(F.col("row")[name].alias(name) for name in names))
