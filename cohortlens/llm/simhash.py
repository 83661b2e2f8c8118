"""Near-duplicate texts by SimHash fingerprints joined with a binary trie.

Fingerprints are 64 bits of word shingles. Texts whose fingerprints differ in few bits are
linked, and linked texts form groups.

The join works on distinct fingerprints only, so copies cost nothing. Two fingerprints that
differ in at most ``d`` bits agree in one of ``d + 1`` blocks of bits; fingerprints are
grouped by each block's value, and inside a group a binary trie is joined with itself. A
group that is too large is divided again by blocks of the bits not yet fixed, which loses no
pair for the same reason. After the last division so few bits are free that a group of
distinct fingerprints is bounded by their number, whatever the data.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.llm.common import components, is_empty, map_rows, utf8
from cohortlens.sources.scratch import written

SEED = 42
BITS = 64
SHINGLE_WORDS = 3
MAX_DISTANCE = 2
#: Divisions of the bits that are still free; at most 14 bits are free after the last.
LEVELS = 4
#: A group of more fingerprints is divided again.
GROUP = 2048

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str | None, width: int = SHINGLE_WORDS) -> int:
    """SimHash of the whole text as an unsigned number.

    A bit is set if it is set in over half the shingles' hashes. Fewer words than a shingle
    form one; no words give zero.
    """
    words = utf8(text).translate(_LOWER).split()
    if not words:
        return 0
    if len(words) < width:
        shingles: Iterable[bytes] = (b" ".join(words),)
        total = 1
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False))
        total = len(words) - width + 1
    hashes = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=SEED), shingles), np.uint64, total)
    counts = np.zeros(BITS, np.int64)
    for start in range(0, total, 1 << 15):
        part = hashes[start : start + (1 << 15)]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


def signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE_WORDS) -> DataFrame:
    """One row ``(doc_id, fp)`` per row of ``docs``; ``fp`` is the signed form."""

    def make(rows: Iterable[tuple]) -> Iterator[tuple]:
        for key, text in rows:
            yield key, signed(fingerprint(text, width))

    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("fp", T.LongType())])
    return map_rows(docs.select(F.col(id_col).cast("long"), F.col(text_col)), make, schema)


def trie_links(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions ``(i, j)`` of all values at most ``budget`` bits apart, in each group for itself.

    A group is ``values[start:end]``, distinct and ascending, so a node of its binary trie is a
    range of them. The walk starts with each root paired with itself and goes down one bit at a
    time, for all groups at once, until only pairs of single values are left.
    """
    pairs = starts, ends, starts, ends, np.full(len(starts), budget, np.int8)
    for bit in range(BITS - 1, -1, -1):
        if not len(pairs[0]):
            break
        pairs = _descend(values, *pairs, bit)
    return pairs[0], pairs[2]


def _descend(
    values: np.ndarray, a0: np.ndarray, a1: np.ndarray, b0: np.ndarray, b1: np.ndarray, left: np.ndarray, bit: int
) -> tuple[np.ndarray, ...]:
    """Node pairs one bit further down, with what is left of their budgets.

    Different branches cost one bit; a pair that overdraws its budget is pruned, and so is a
    single value beside itself.
    """
    ones = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values >> np.uint64(bit) & np.uint64(1), out=ones[1:], dtype=np.int64)
    am, bm = a1 - (ones[a1] - ones[a0]), b1 - (ones[b1] - ones[b0])
    own = a0 == b0  # a node beside itself: its two crossings are one pair
    parts = []
    for one0, one1, other0, other1, cost, keep in (
        (a0, am, b0, bm, 0, ~own | (am - a0 > 1)),
        (am, a1, bm, b1, 0, ~own | (a1 - am > 1)),
        (a0, am, bm, b1, 1, left > 0),
        (am, a1, b0, bm, 1, ~own & (left > 0)),
    ):
        at = np.flatnonzero(keep & (one0 < one1) & (other0 < other1))
        parts.append((one0[at], one1[at], other0[at], other1[at], left[at] - np.int8(cost)))
    return tuple(np.concatenate(column) for column in zip(*parts, strict=True))


def _first_connected(count: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of ``count`` positions the smallest one connected with it by the pairs."""
    first = np.arange(count)
    while True:
        low, new = np.minimum(first[i], first[j]), first.copy()
        np.minimum.at(new, first[i], low)
        np.minimum.at(new, first[j], low)
        while (new[new] != new).any():
            new = new[new]
        if (new == first).all():
            return first
        first = new


def trie_edges(
    values: np.ndarray, budget: int, starts: np.ndarray | None = None, ends: np.ndarray | None = None
) -> np.ndarray:
    """Edges ``(a, b)`` from the first value of each connected set to its others, a row each.

    Without bounds all values are one group.
    """
    if starts is None or ends is None:
        starts, ends = np.array([0]), np.array([len(values)])
    first = _first_connected(len(values), *trie_links(values, starts, ends, budget))
    other = np.flatnonzero(first != np.arange(len(values)))
    return np.stack([values[first[other]], values[other]], axis=1)


def _divisions(distance: int) -> list[tuple[int, int, int, int]]:
    """Rows ``(level, node, child, mask)``: the fixed bits of each child, for all levels."""
    rows, known, level_nodes = [], {0: 0}, [0]
    for level in range(1, LEVELS + 1):
        below = []
        for node in level_nodes:
            free = [b for b in range(BITS) if not known[node] >> b & 1]
            for block in np.array_split(np.array(free), distance + 1):
                child = len(known)
                known[child] = known[node] | sum(1 << int(b) for b in block)
                rows.append((level, node, child, signed(known[child])))
                below.append(child)
        level_nodes = below
    return rows


def links(values: DataFrame, distance: int = MAX_DISTANCE) -> DataFrame:
    """Edges ``(a, b)`` that connect all fingerprints (column ``fp``, distinct) within reach.

    Connected fingerprints are exactly those connected by pairs at most ``distance`` bits
    apart; of the pairs themselves only spanning edges of each group are kept.
    """
    rows = _divisions(distance)
    rest = values.select("fp", F.lit(0).alias("node"))
    found = None
    for level in range(1, LEVELS + 1):
        # One row per child of the row's node, at most 3 * 3 ** (level - 1) of them in all.
        children = F.array(
            *(
                F.struct(F.lit(node).alias("parent"), F.lit(child).alias("node"), F.lit(mask).cast("long").alias("mask"))
                for at, node, child, mask in rows
                if at == level
            )
        )
        own = F.filter(children, lambda c: c["parent"] == F.col("node"))
        keyed = rest.select("fp", F.explode(own).alias("child")).select(
            F.col("child.node").alias("node"), F.col("fp").bitwiseAND(F.col("child.mask")).alias("block"), "fp"
        )
        sizes = keyed.groupBy("node", "block").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
        keyed = written(keyed.join(sizes, ["node", "block"]), "blocks")
        last = level == LEVELS
        ready = keyed if last else keyed.filter(F.col("size") <= GROUP)
        edges = _joined(ready, distance)
        found = edges if found is None else found.union(edges)
        if last:
            break
        rest = keyed.filter(F.col("size") > GROUP).select("node", "fp")
        if is_empty(rest):
            break
    return found


def _joined(keyed: DataFrame, distance: int) -> DataFrame:
    """Edges of all groups. Rows of a group arrive one after the other; one group is held."""
    dealt = keyed.select("node", "block", "fp").repartition("node", "block").sortWithinPartitions("node", "block", "fp")
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((3, 0), np.int64)
        for batch in batches:
            columns = [column.to_numpy(zero_copy_only=False).astype(np.int64) for column in batch.columns]
            held = np.concatenate([held, np.stack(columns)], axis=1)
            last = held[:, -1:] if held.shape[1] else held
            done = int(np.flatnonzero((held[:2] != last[:2]).any(axis=0)).max(initial=-1)) + 1
            if done:
                yield _edges(held[:, :done], distance)
                held = held[:, done:]
        if held.shape[1]:
            yield _edges(held, distance)

    return dealt.mapInArrow(run, schema)


def _edges(rows: np.ndarray, distance: int) -> pa.RecordBatch:
    """Edges of whole groups, given as node, block and fingerprint in order."""
    new = np.r_[True, (rows[:2, 1:] != rows[:2, :-1]).any(axis=0)]
    values = rows[2].view(np.uint64)
    values = values[np.lexsort((values, np.cumsum(new)))]  # tries are in unsigned order
    bounds = np.r_[np.flatnonzero(new), len(values)]
    found, at = [np.zeros((0, 2), np.uint64)], 0
    while at < len(bounds) - 1:
        # Whole groups of about GROUP values in all are walked together.
        to = max(int(np.searchsorted(bounds, bounds[at] + GROUP, "right")) - 1, at + 1)
        inside = bounds[at : to + 1] - bounds[at]
        found.append(trie_edges(values[bounds[at] : bounds[to]], distance, inside[:-1], inside[1:]))
        at = to
    a, b = np.concatenate(found).view(np.int64).T
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = SHINGLE_WORDS,
    distance: int = MAX_DISTANCE,
) -> DataFrame:
    """One row ``(doc_id, fingerprint, component_id)`` per row of ``docs``.

    ``component_id`` is the smallest id reachable over links of at most ``distance`` bits.
    Texts that are null, empty or without words have fingerprint zero and link like others.
    A null id is kept and never is the smallest; a group of null ids only has null. Equal rows
    give equal rows. Columns other than the id and the text are not read. An empty table gives
    an empty table.
    """
    return _groups(docs, id_col, text_col, width, distance).drop("root")


def _groups(docs: DataFrame, id_col: str, text_col: str, width: int, distance: int) -> DataFrame:
    """The same rows with ``root``, which tells groups apart even where ids repeat."""
    hashed = written(fingerprints(docs, id_col, text_col, width), "fingerprints")
    values = written(hashed.groupBy("fp").agg(F.min("doc_id").alias("first")), "values")
    roots = components(links(values, distance)).select(F.col("node").alias("fp"), "root")
    rooted = written(
        values.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root")), "rooted"
    )
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = written(rooted.join(smallest, "root").select("fp", "component_id", "root"), "classes")
    return hashed.join(classes, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "root"
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without all but one of each group of near-duplicates.

    The one with the smallest id stays. Of rows that share that id, too, one stays. Rows without
    an id are never a group's first unless the whole group has none; then one of them stays.
    """
    classes = written(_groups(docs, id_col, text_col, SHINGLE_WORDS, MAX_DISTANCE), "groups")
    again = written(
        classes.groupBy("doc_id").count().filter("count > 1").select(F.col("doc_id").alias("again")), "again"
    )
    gone = written(
        classes.filter("not doc_id <=> component_id")
        .join(again, F.col("doc_id").eqNullSafe(F.col("again")), "left_anti")
        .select(F.col("doc_id").alias("gone")),
        "gone",
    )
    kept = docs.join(gone, docs[id_col].eqNullSafe(gone["gone"]), "left_anti")
    if is_empty(again):
        return kept
    single = kept.join(again, kept[id_col].eqNullSafe(again["again"]), "left_anti")
    several = kept.join(again, kept[id_col].eqNullSafe(again["again"]), "left_semi")
    return single.unionByName(_one_each(several, classes, id_col, text_col))


def _one_each(rows: DataFrame, classes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows that share their id with other rows: the fingerprint tells their groups apart."""
    own = rows.select(F.struct("*").alias("row"), _hex_fingerprint(F.col(text_col)).alias("own"))
    groups = classes.select("fingerprint", "component_id", "root").distinct()
    return (
        own.join(groups, own["own"] == groups["fingerprint"])
        .filter(F.col(f"row.{id_col}").eqNullSafe(F.col("component_id")))
        .groupBy("root")
        .agg(F.first("row").alias("row"))
        .select("row.*")
    )


@F.pandas_udf(T.StringType())
def _hex_fingerprint(texts: pd.Series) -> pd.Series:
    return texts.map(lambda text: format(fingerprint(text), "016x"))
