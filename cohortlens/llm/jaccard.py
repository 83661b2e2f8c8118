"""Links between texts whose word shingles overlap, by R-trees over count vectors.

A text's set is its distinct word shingles, as 64-bit hashes. The hashes fall into groups, and
the counts per group are a point: two sets share at most as many shingles as the sum of the
smaller counts, and two boxes of points hold no linked pair if the sum of the smaller upper
corners is below what the link needs. An R-tree over the points is joined with itself from the
root down by that bound, and pairs of points that survive are verified on the sets.

Trees are built where links can be. Shingles have one order, common ones last, and linked sets
share one of the first fifth of each, so a tree is built over the sets that share such a
shingle; sets of one shingle too many for a task are dealt into tiles, and pairs of tiles are
joined like pairs of boxes. The order knows how common a shingle is from counts over all
texts, so a passage of half the corpus brings hardly any sets together. Large groups are first
joined tile by tile on their sets, in a few rounds with other groups each, and what is linked
there already is not compared again: thousands of near copies do not become millions of pairs.
Equal sets are one point.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.llm.common import components, map_rows
from cohortlens.sources.scratch import written
from cohortlens.sources.tables import broadcast_if_small

WIDTH = 5
#: Linked if the intersection is at least so many percent of the union.
PERCENT = 80
#: Bits of the hash that name its group, and so dimensions of the points. Counts are bytes: what
#: a group has beyond 255 counts for the set as a whole.
GROUP_BITS = 9
GROUPS = 1 << GROUP_BITS
MOST = 255
#: Cells of the table of counts that orders shingles; its size does not depend on the input.
CELL_BITS = 20
#: Points in a leaf, and in a tile.
LEAF = 8
TILE = 512
#: Bytes of sets in a tile.
TILE_BYTES = 16 << 20
#: Sets of one shingle from which their groups are joined tile by tile first.
LARGE = 8
#: Most rounds in which that is done.
ROUNDS = 3
#: Pairs whose bound is computed at a time.
STEP = 1 << 13
#: Width of the bands of set sizes that tiles are made of.
BAND = 1.06

_ODD, _SHIFT = np.uint64(0x9E3779B97F4A7C15), np.uint64(32)
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


# ---------------------------------------------------------------- sets and points
def shingles(text: bytes | None, width: int = WIDTH) -> np.ndarray:
    """Hashes of the distinct shingles, ascending. Fewer words than a shingle form one."""
    words = (text or b"").translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < width:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words))], np.uint64)
    total = len(words) - width + 1
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    found = hashes[:total].copy()
    # Each step is one to one in what is known so far and in the word that comes next.
    for i in range(1, width):
        found *= _ODD
        found ^= found >> _SHIFT
        found += hashes[i : i + total]
    found *= _ODD
    found ^= found >> _SHIFT
    found *= _ODD
    return np.unique(found)


def point(found: np.ndarray) -> np.ndarray:
    """Count of the hashes in each group, at most ``MOST``."""
    counts = np.bincount((found >> np.uint64(64 - GROUP_BITS)).astype(np.int64), minlength=GROUPS)
    return np.minimum(counts, MOST).astype(np.uint8)


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


# ---------------------------------------------------------------- the tree
@dataclass
class Tree:
    """Boxes of a binary R-tree in breadth-first order. Children of a box stand side by side."""

    order: np.ndarray  # points by leaf
    first: np.ndarray  # of each box, in ``order``
    last: np.ndarray
    child: np.ndarray  # number of the lower child; -1 for leaves
    upper: np.ndarray  # upper corners
    excess: np.ndarray  # most that a set has beyond its point
    least: np.ndarray  # smallest set
    label: np.ndarray  # the one class of all points below, or -1


def tree(points: np.ndarray, excess: np.ndarray, sizes: np.ndarray, labels: np.ndarray) -> Tree:
    """Packed top down: each box is cut in the middle of the side along which it is widest."""
    order = np.arange(len(points))
    first, last, child = [0], [len(points)], []
    for box, start in enumerate(first):
        end = last[box]
        if end - start <= LEAF:
            child.append(-1)
            continue
        own = order[start:end]
        spread = np.ptp(points[own], axis=0)
        side = points[own, int(spread.argmax())] if int(spread.max()) * 8 > np.ptp(sizes[own]) else sizes[own]
        middle = (end - start) // 2
        order[start:end] = own[np.argpartition(side, middle, kind="introselect")]
        child.append(len(first))
        first += [start, start + middle]
        last += [start + middle, end]
    upper = np.zeros((len(first), points.shape[1]), points.dtype)
    least, beyond = np.zeros((2, len(first)), np.int64)
    label = np.full(len(first), -1, np.int64)
    for box in reversed(range(len(first))):
        low = child[box]
        if low < 0:
            own = order[first[box] : last[box]]
            upper[box], beyond[box], least[box] = points[own].max(axis=0), excess[own].max(), sizes[own].min()
            names = labels[own]
            label[box] = names[0] if (names == names[0]).all() else -1
        else:
            upper[box] = np.maximum(upper[low], upper[low + 1])
            beyond[box] = max(beyond[low], beyond[low + 1])
            least[box] = min(least[low], least[low + 1])
            label[box] = label[low] if label[low] == label[low + 1] else -1
    return Tree(order, np.array(first), np.array(last), np.array(child), upper, beyond, least, label)


def overlap(one: Tree | Side, other: Tree | Side, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Most shingles that sets below the boxes (or of the points) ``a`` and ``b`` can share."""
    most = np.minimum(one.excess[a], other.excess[b])
    for start in range(0, len(a), STEP):
        i, j = a[start : start + STEP], b[start : start + STEP]
        most[start : start + STEP] += np.minimum(one.upper[i], other.upper[j]).sum(axis=1, dtype=np.int64)
    return most


def _within(one: Tree | Side, other: Tree | Side, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Which of the pairs can hold a link: ``overlap >= percent / (100 + percent) * (|A| + |B|)``."""
    return (100 + percent) * overlap(one, other, a, b) >= percent * (one.least[a] + other.least[b])


class Side:
    """The points of a tile with their tree."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, labels: np.ndarray) -> None:
        self.upper, self.least, self.labels = points, sizes, labels
        self.excess = sizes - points.sum(axis=1, dtype=np.int64)
        self.tree = tree(points, self.excess, sizes, labels)


def surviving(one: Side, other: Side, percent: int = PERCENT, visits: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of points (of ``one`` and ``other``) that the bound does not exclude.

    With ``one is other`` each pair comes once and no point is paired with itself. Points of
    one class are not paired. ``visits`` collects the numbers of box pairs looked at.
    """
    same = one is other
    a = b = np.zeros(1, np.int64)
    leaves: list[tuple[np.ndarray, np.ndarray]] = []
    s, t = one.tree, other.tree
    while len(a):
        if visits is not None:
            visits.append(len(a))
        keep = _within(s, t, a, b, percent)
        keep &= (s.label[a] < 0) | (s.label[a] != t.label[b])
        a, b = a[keep], b[keep]
        ready = (s.child[a] < 0) & (t.child[b] < 0)
        leaves.append((a[ready], b[ready]))
        a, b = a[~ready], b[~ready]
        # The larger box is opened; a box with itself gives its children and their pair.
        self_pair = (a == b) & same
        open_a = ~self_pair & (s.child[a] >= 0) & ((t.child[b] < 0) | (s.last[a] - s.first[a] >= t.last[b] - t.first[b]))
        open_b = ~self_pair & ~open_a
        low = s.child[a[self_pair]]
        ca, cb = s.child[a[open_a]], t.child[b[open_b]]
        a, b = (
            np.concatenate([low, low + 1, low, ca, ca + 1, a[open_b], a[open_b]]),
            np.concatenate([low, low + 1, low + 1, b[open_a], b[open_a], cb, cb + 1]),
        )
    out: list[tuple[np.ndarray, np.ndarray]] = []
    for at, bt in leaves:
        for start in range(0, len(at), STEP // LEAF**2):
            i, j = at[start : start + STEP // LEAF**2], bt[start : start + STEP // LEAF**2]
            n, m = s.last[i] - s.first[i], t.last[j] - t.first[j]
            cell = np.arange(int((n * m).sum())) - np.repeat(np.cumsum(n * m) - n * m, n * m)
            left = np.repeat(s.first[i], n * m) + cell // np.repeat(m, n * m)
            right = np.repeat(t.first[j], n * m) + cell % np.repeat(m, n * m)
            once = np.repeat(i != j, n * m) | (left < right) if same else np.ones(len(cell), bool)
            p, q = s.order[left[once]], t.order[right[once]]
            keep = one.labels[p] != other.labels[q]
            p, q = p[keep], q[keep]
            keep = _within(one, other, p, q, percent)
            out.append((p[keep], q[keep]))
    if not out:
        return a, b
    return np.concatenate([x for x, _ in out]), np.concatenate([x for _, x in out])


# ---------------------------------------------------------------- on the cluster
def _shared_counts(docs: DataFrame, width: int) -> np.ndarray:
    """How common the shingles of each cell are: 0, or the power of two above the usual.

    Counts over all texts are added up in a table of fixed size; what is returned orders
    shingles and nothing else, so sets that share a cell cost time at most.
    """
    cells, chunk = 1 << CELL_BITS, 1 << 12

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(cells, "<u4")
        for batch in batches:
            for text in batch.column(0):
                counts[(shingles(text.as_py(), width) & np.uint64(cells - 1)).astype(np.int64)] += 1
        parts = counts.reshape(-1, chunk)
        full = np.flatnonzero(parts.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(full.astype(np.int64)), pa.array([parts[i].tobytes() for i in full], pa.binary())], names=["chunk", "counts"]
        )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                totals.setdefault(number, np.zeros(chunk, "<u8"))
                totals[number] += np.frombuffer(data, "<u4")
        arrays = [pa.array(list(totals), pa.int64()), pa.array([v.tobytes() for v in totals.values()], pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, names=["chunk", "counts"])

    schema = "chunk long, counts binary"
    summed = docs.select("text").mapInArrow(count, schema).repartition("chunk").mapInArrow(add, schema)
    total = np.zeros((cells // chunk, chunk))
    for row in summed.collect():
        total[row["chunk"]] = np.frombuffer(row["counts"], "<u8")
    usual = 4 * total.mean() + 16
    return np.maximum(np.floor(np.log2(np.maximum(total.ravel(), 1) / usual)) + 1, 0).astype(np.uint8)


SETS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.BinaryType()),
        T.StructField("n", T.LongType()),
        T.StructField("d1", T.LongType()),
        T.StructField("d2", T.LongType()),
        T.StructField("first", T.ArrayType(T.LongType())),
        T.StructField("point", T.BinaryType()),
    ]
)


def _sets(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Each text with the size, digest, point and first shingles of its set."""
    levels = docs.sparkSession.sparkContext.broadcast(_shared_counts(docs, width))

    def make(rows: Iterable[tuple]) -> Iterator[tuple]:
        common = levels.value
        mask = np.uint64(len(common) - 1)
        for key, text in rows:
            found = shingles(text, width)
            if not len(found):
                yield key, None, 0, None, None, None, None
                continue
            most = len(found) * (100 - percent) // 100 + 1
            at = np.argsort(common[(found & mask).astype(np.int64)], kind="stable")[:most]
            digest = np.frombuffer(xxhash.xxh3_128_digest(found.tobytes()), np.int64).tolist()
            yield key, text, len(found), *digest, found[at].view(np.int64), point(found).tobytes()

    made = map_rows(docs.select("doc_id", "text"), make, SETS, 512)
    return written(made.withColumn("row", F.monotonically_increasing_id()), "sets")


def _members(firsts: DataFrame) -> DataFrame:
    """``(shingle, row)`` of the first shingles that several rows have, one group per set of rows."""
    cells = firsts.select(F.explode("first").alias("shingle"), "row")
    laid = cells.repartition("shingle").sortWithinPartitions("shingle")

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last row of a batch waits for the next one, and the value before is remembered.
        before, held = None, None
        for batch in batches:
            keys, rows = (c.to_numpy() for c in batch.columns)
            if held is not None:
                keys, rows = np.append(held[0], keys), np.append(held[1], rows)
            if not len(keys):
                continue
            equal = keys[1:] == keys[:-1]
            keep = np.append(before is not None and keys[0] == before, equal)[:-1] | equal
            yield pa.RecordBatch.from_arrays([pa.array(keys[:-1][keep]), pa.array(rows[:-1][keep])], names=["shingle", "row"])
            before = keys[-2] if len(keys) > 1 else before
            held = keys[-1:], rows[-1:]
        if held is not None and before is not None and held[0][0] == before:
            yield pa.RecordBatch.from_arrays([pa.array(held[0]), pa.array(held[1])], names=["shingle", "row"])

    members = written(laid.mapInArrow(shared, "shingle long, row long"), "members")
    digest = F.xxhash64("row")
    groups = members.groupBy("shingle").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.shiftright(digest, 8)).alias("s"), F.bit_xor(F.xxhash64("row", F.lit(1))).alias("x")
    )
    kept = written(groups.groupBy("rows", "s", "x").agg(F.min("shingle").alias("shingle")).select("shingle", "rows"), "groups")
    return written(members.join(kept, "shingle"), "kept-members")


EDGES = "a long, b long"
UNIT = ["shingle", "unit", "side", "row", "label", "n", "point"]


def _units(dealt: DataFrame, columns: list[str], join: Callable[[dict[str, list]], tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """``join`` on the rows of each unit, which arrive one unit after the other; one is held."""
    laid = dealt.select(*columns).repartition("shingle", "unit").sortWithinPartitions("shingle", "unit", "side", "row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key: tuple | None = None
        held: list[pa.RecordBatch] = []

        def edges() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            a, b = join({name: table.column(name) for name in columns})
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            keys = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()])
            starts = np.append(0, np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1)
            for start, end in zip(starts.tolist(), [*starts[1:].tolist(), batch.num_rows], strict=True):
                if start == end:
                    continue
                if held and key != (own := tuple(keys[:, start].tolist())):
                    yield edges()
                    held = []
                key = tuple(keys[:, start].tolist())
                held.append(batch.slice(start, end - start))
        if held:
            yield edges()

    return laid.mapInArrow(run, EDGES)


def _side(columns: dict[str, pa.ChunkedArray], chosen: np.ndarray) -> Side:
    points = np.frombuffer(b"".join(columns["point"].to_pylist()), np.uint8).reshape(-1, GROUPS)
    return Side(points[chosen], columns["n"].to_numpy()[chosen], columns["label"].to_numpy()[chosen])


def _named(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """The members with the label of their class; those without one are their own."""
    rows = members.select("shingle", "row")
    if labels is None:
        return rows.withColumn("label", F.col("row"))
    return rows.join(labels, "row", "left").withColumn("label", F.coalesce("label", "row"))


def _large_links(members: DataFrame, labels: DataFrame | None, sets: DataFrame, width: int, percent: int, turn: int) -> DataFrame:
    """Verified links inside tiles of the large groups of several classes, each row in one of its groups.

    That is the largest at first, and in later turns the first in an order of all groups that is
    another each turn: near copies have most groups in common and so mostly meet. Tiles are dealt
    twice, so that those of one group are linked through each other; links that are missed here
    are found with those of small groups.
    """
    named = _named(members, labels)
    sizes = named.groupBy("shingle").agg(F.count(F.lit(1)).alias("rows"), F.min("label").alias("l"), F.max("label").alias("h"))
    large = sizes.filter((F.col("rows") >= LARGE) & (F.col("l") < F.col("h"))).select("shingle", "rows")
    place = F.struct("rows", "shingle") if not turn else F.struct(F.xxhash64("shingle", F.lit(turn)), "shingle")
    own = written(named.join(large, "shingle").groupBy("row", "label").agg(F.max_by("shingle", place).alias("shingle")), "own-groups")
    rows = sets.select("row", "n", "point").join(broadcast_if_small(own, 500_000), "row")
    near = _units(_tiles(written(rows, "large"), TILE), UNIT, _with_partners(percent)).select(F.col("a").alias("row")).distinct()
    near = broadcast_if_small(near.join(own, "row"), 500_000)
    rows = written(sets.select("row", "text", "n", "point").join(near, "row"), "large-near")

    def join(columns: dict[str, pa.ChunkedArray]) -> tuple[np.ndarray, np.ndarray]:
        names = columns["row"].to_numpy()
        one = _side(columns, np.arange(len(names)))
        found = [shingles(t, width) for t in columns["text"].to_pylist()]
        p, q = surviving(one, one, percent)
        # Likeliest pairs first; what they link need not be compared.
        likely = overlap(one, one, p, q) / (one.least[p] + one.least[q])
        group = np.unique(one.labels, return_inverse=True)[1]
        edges = []
        for at in np.argsort(-likely, kind="stable").tolist():
            i, j = int(p[at]), int(q[at])
            if group[i] != group[j] and linked(found[i], found[j], percent):
                group[group == group[j]] = group[i]
                edges.append((names[i], names[j]))
        a, b = np.array(edges, np.int64).reshape(-1, 2).T
        return a, b

    return _units(_tiles(rows, TILE), [*UNIT, "text"], join)


def _joined_first(members: DataFrame, sets: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The links of the large groups, and the classes they make, after as many rounds as find more."""
    links = labels = None
    for turn in range(ROUNDS):
        more = written(_large_links(members, labels, sets, width, percent, turn), "large-links")
        if links is not None and more.isEmpty():
            break
        links = more if links is None else links.union(more)
        labels = written(components(links).select(F.col("node").alias("row"), F.col("root").alias("label")), "labels")
    return links, labels


def _with_partners(percent: int) -> Callable[[dict[str, pa.ChunkedArray]], tuple[np.ndarray, np.ndarray]]:
    """The rows of a unit that any other may be linked with."""

    def join(columns: dict[str, pa.ChunkedArray]) -> tuple[np.ndarray, np.ndarray]:
        names = columns["row"].to_numpy()
        one = _side(columns, np.arange(len(names)))
        found = names[np.unique(np.concatenate(surviving(one, one, percent)))]
        return found, found

    return join


def _tiles(rows: DataFrame, size: int) -> DataFrame:
    """Rows dealt into tiles of their group, each twice where there are several."""
    tiles = rows.groupBy("shingle").agg(
        F.ceil(F.greatest(F.count(F.lit(1)) / size, F.sum("n") * 8 / TILE_BYTES)).cast("long").alias("tiles")
    )
    deals = F.explode(F.when(F.col("tiles") > 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return (
        rows.join(tiles, "shingle")
        .select("*", deals.alias("deal"))
        .withColumn("unit", 2 * F.pmod(F.xxhash64("row", "deal"), F.col("tiles")) + F.col("deal"))
        .withColumn("side", F.lit(0))
    )


def _candidates(members: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of rows in different classes that survive the bound, from all groups."""
    named = _named(members, labels)
    mixed = named.groupBy("shingle").agg(F.count(F.lit(1)).alias("rows"), F.min("label").alias("l"), F.max("label").alias("h"))
    open_groups = mixed.filter("l <> h").select("shingle", "rows")
    points = sets.select("row", "n", "point")
    rows = written(named.join(open_groups, "shingle").join(points, "row"), "points")
    few = rows.filter(F.col("rows") <= TILE).withColumns({"unit": F.lit(0).cast("long"), "side": F.lit(0)})
    tiled = rows.filter(F.col("rows") > TILE).withColumn("band", F.floor(F.log("n") / F.log(F.lit(BAND))))
    # Tiles hold like sizes, and so large boxes of other sizes need not be opened.
    bands = tiled.groupBy("shingle", "band").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("long").alias("deals"))
    tiled = tiled.join(bands, ["shingle", "band"]).withColumn(
        "tile", F.xxhash64("band", F.pmod(F.xxhash64("row"), F.col("deals")))
    )
    tiled = written(tiled, "tiled")
    boxes = written(
        tiled.groupBy("shingle", "tile").agg(
            F.min("n").alias("least"), F.max("n").alias("most"), F.min("label").alias("l"), F.max("label").alias("h")
        ),
        "boxes",
    )
    other = boxes.select("shingle", *(F.col(c).alias(f"{c}2") for c in ("tile", "least", "most", "l", "h")))
    near = (
        boxes.join(other, "shingle")
        .filter("tile <= tile2 and not (l = h and l2 = h2 and l = l2)")
        .filter(f"100 * most >= {percent} * least2 and 100 * most2 >= {percent} * least")
    )
    unit = F.xxhash64("tile", "tile2").alias("unit")
    sides = near.select("shingle", "tile", unit, F.lit(0).alias("side")).union(
        near.filter("tile <> tile2").select("shingle", F.col("tile2").alias("tile"), unit, F.lit(1).alias("side"))
    )
    many = tiled.join(sides, ["shingle", "tile"])

    def join(columns: dict[str, pa.ChunkedArray]) -> tuple[np.ndarray, np.ndarray]:
        side, names = columns["side"].to_numpy(), columns["row"].to_numpy()
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        one = _side(columns, left)
        other = _side(columns, right) if len(right) else one
        p, q = surviving(one, other, percent)
        a, b = names[left][p], names[right if len(right) else left][q]
        return np.minimum(a, b), np.maximum(a, b)

    return _units(few.select(*UNIT).union(many.select(*UNIT)), UNIT, join).distinct()


def _verified(pairs: DataFrame, sets: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs whose sets are linked."""
    needed = broadcast_if_small(pairs.select(F.col("a").alias("row")).union(pairs.select("b")).distinct(), 500_000)

    def make(rows: Iterable[tuple]) -> Iterator[tuple]:
        for row, text in rows:
            yield row, shingles(text, width).tobytes()

    found = map_rows(sets.select("row", "text").join(needed, "row", "left_semi"), make, T.StructType().add("row", "long").add("hashes", "binary"), 512)
    found = written(found, "compared-sets")
    both = pairs.join(found.select(F.col("row").alias("a"), F.col("hashes").alias("one")), "a").join(
        found.select(F.col("row").alias("b"), F.col("hashes").alias("other")), "b"
    )

    def check(rows: Iterable[tuple]) -> Iterator[tuple]:
        for a, b, one, other in rows:
            if linked(np.frombuffer(one, np.uint64), np.frombuffer(other, np.uint64), percent):
                yield a, b

    return map_rows(both.select("a", "b", "one", "other"), check, T.StructType().add("a", "long").add("b", "long"))


def classes(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row ``(doc_id, n_shingles, component_id)`` per row of ``docs``.

    ``component_id`` is the smallest id reachable over links. Texts that are null, empty or
    without words have no shingles and link with nothing: their component is their own id. Rows
    with equal ids are different documents. A null id is kept and never is the smallest; a
    component of null ids only has null. Columns other than the id and the text are not read.
    An empty table gives an empty table. Tables of rows, members and pairs stay on the cluster;
    the driver gets the counts of ``2 ** CELL_BITS`` cells.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    sets = _sets(texts, width, percent)
    full = sets.filter("n > 0")
    equal = written(
        full.groupBy("d1", "d2").agg(F.min("row").alias("row"), F.min("doc_id").alias("first_id")), "equal-sets"
    )
    kept = broadcast_if_small(equal.select("row"), 500_000)
    members = _members(full.select("row", "first").join(kept, "row", "left_semi"))
    linked_large, labels = _joined_first(members, full, width, percent)
    pairs = written(_candidates(members, labels, full, percent), "pairs")
    links = written(_verified(pairs, full, width, percent).union(linked_large), "links")
    roots = components(links).select(F.col("node").alias("row"), "root")
    rooted = written(equal.join(roots, "row", "left").withColumn("root", F.coalesce("root", "row")), "rooted")
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = written(rooted.join(smallest, "root").select("d1", "d2", "component_id"), "named")
    of_words = full.select("doc_id", "n", "d1", "d2").join(named, ["d1", "d2"])
    of_none = sets.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return (
        of_words.select("doc_id", "n", "component_id")
        .union(of_none)
        .select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    )


#: The same rows in DuckDB, by counting equal shingles of all pairs; for small tables.
SQL = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM worded),
every AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
cells AS (SELECT e.* FROM every e SEMI JOIN (SELECT shingle FROM every GROUP BY shingle HAVING count(*) > 1) k USING (shingle)),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM cells a JOIN cells b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id AND b.n BETWEEN 0.8 * a.n AND 1.25 * a.n
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (
  SELECT doc_id AS node, doc_id AS other FROM sets
  UNION
  SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.other)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, min(r.other) AS component_id
FROM sets s JOIN reach r ON r.node = s.doc_id
GROUP BY s.doc_id, len(s.s)
"""
