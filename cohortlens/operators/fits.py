"""Many clusterings of the same points fitted together: a step of all of them is one pass.

The points are held as blocks of rows. K-means starts from the centres that Spark's own
initialisation finds; splits in two start from noise around the centre that is split, drawn as
Spark's bisecting fit draws it. From there on every pass moves the centres of all fits that
have not ended, so the number of passes does not grow with the number of fits. Fits may see
different numbers of leading coordinates of the points; the width of their centres tells.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.serializers import NoOpSerializer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.operators.scores import Scores, silhouette_sums

BLOCK_ROWS = 2_048
PART_BYTES = 32 << 20
MAX_STEPS = 20
TOLERANCE = 1e-4
# Centres that moved less than this share of their length only differ by rounding.
STILL = 1e-12
MAX_LEVEL = 63
# Spark's k-means takes this many rounds of points for its starting centres, and so many steps among them.
START_ROUNDS = 2
START_STEPS = 30
# Distances below this share of the squared lengths are taken from the differences.
CLOSE = 1e-6


# ---------------------------------------------------------------- points
class Block(NamedTuple):
    part: int
    before: int
    points: np.ndarray


@contextmanager
def blocks_of(df: DataFrame, features: str) -> Iterator[RDD]:
    """The vectors as matrices of at most ``BLOCK_ROWS`` rows, held inside the block.

    Each comes with its partition of ``df`` and the number of rows before it there.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = 0
        for batch in batches:
            lists = batch.column(0)
            values = lists.flatten()
            if lists.null_count or values.null_count:
                raise ValueError("vectors with missing values cannot be clustered")
            points = values.to_numpy().reshape(len(lists), -1) if len(lists) else np.empty((0, 0))
            if not np.isfinite(points).all():
                raise ValueError("vectors with values that are not finite cannot be clustered")
            for at in range(0, len(points), BLOCK_ROWS):
                part = points[at : at + BLOCK_ROWS]
                head = np.array([batch.column(1)[0].as_py(), before, part.shape[1]])
                before += len(part)
                # Coordinate by coordinate: a few leading ones then lie together.
                yield pa.RecordBatch.from_arrays([pa.array([head.tobytes() + part.tobytes("F")], pa.binary())], names=["data"])

    spark = df.sparkSession
    rows = df.select(vector_to_array(F.col(features)).alias("point"), F.spark_partition_id().alias("part"))
    binary = spark._jvm.org.apache.spark.sql.Encoders.BINARY()
    packed = getattr(rows.mapInArrow(pack, "data binary")._jdf, "as")(binary).toJavaRDD()
    # The bytes go to the tasks as they are held.
    whole = RDD(packed, spark.sparkContext, NoOpSerializer()).persist(StorageLevel.MEMORY_AND_DISK_DESER)
    held = whole
    try:
        size = whole.map(len).sum()
        # Passes over few rows should not be many tasks.
        wanted = max(spark.sparkContext.defaultParallelism, -(-size // PART_BYTES))
        held = whole.coalesce(int(wanted)) if wanted < whole.getNumPartitions() else whole
        yield held.map(_block)
    finally:
        whole.unpersist()


def _block(data: bytes) -> Block:
    part, before, width = np.frombuffer(data, np.int64, 3).tolist()
    return Block(part, before, np.frombuffer(data, float, offset=24).reshape(width, -1).T)


def add_up(blocks: RDD, step: Callable[[np.ndarray], list[np.ndarray]]) -> list[np.ndarray]:
    """The sums of what ``step`` finds in each block; the driver gets one list per task."""

    def run(part: Iterable[Block]) -> list[list[np.ndarray]]:
        total = None
        for block in part:
            found = step(block.points)
            total = found if total is None else [a + b for a, b in zip(total, found, strict=True)]
        return [] if total is None else [total]

    parts = blocks.mapPartitions(run).collect()
    if not parts:
        raise ValueError("there are no rows to cluster")
    return [np.sum(cells, axis=0) for cells in zip(*parts, strict=True)]


def _near(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances less the points' own squared lengths, a line per centre; absent centres are NaN."""
    lengths = np.square(centres).sum(axis=1)
    absent = np.isnan(lengths)
    found = np.where(absent[:, None], 0.0, -2 * centres) @ points.T
    found += lengths[:, None]
    found[absent] = np.inf
    return found


def _hot(near: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Of the lines between two of ``ends`` the first smallest is true at each point."""
    best = np.stack([near[at:end].min(axis=0) for at, end in zip(ends, ends[1:], strict=False)])
    hot = near == np.repeat(best, np.diff(ends), axis=0)
    if np.count_nonzero(hot) > best.size:
        for at, end in zip(ends, ends[1:], strict=False):
            hot[at:end] &= np.cumsum(hot[at:end], axis=0) == 1
    return hot


def _second(near: np.ndarray) -> np.ndarray:
    """Whether the second of two lines is the smaller one."""
    return near[1] < near[0]


def _ends(tables: Sequence[np.ndarray]) -> np.ndarray:
    return np.cumsum([0, *map(len, tables)])


# ---------------------------------------------------------------- models
@dataclass
class Leaf:
    number: int


@dataclass
class Fork:
    centres: np.ndarray
    sides: list[Fork | Leaf | None]


@dataclass
class Model:
    """Centres, and for a bisecting fit the splits that lead to them."""

    centres: np.ndarray
    tree: Fork | Leaf | None = None
    converged: bool | None = None
    features: str = "pca"

    def clusterCenters(self) -> list[np.ndarray]:  # noqa: N802, as Spark's models
        return list(self.centres)

    def predict(self, points: np.ndarray) -> np.ndarray:
        if self.tree is None:
            return _near(points, self.centres).argmin(axis=0)
        own = np.zeros(len(points), int)
        left = [(self.tree, np.arange(len(points)))]
        while left:
            node, rows = left.pop()
            if isinstance(node, Leaf):
                own[rows] = node.number
                continue
            side = _second(_near(points[rows], node.centres)).astype(int)
            left += [(child, rows[side == at]) for at, child in enumerate(node.sides) if child is not None]
        return own

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """The rows with the number of their cluster."""
        predict = self.predict

        @F.arrow_udf("int")
        def cluster(lists: pa.Array) -> pa.Array:
            if not len(lists):
                return pa.array([], pa.int32())
            points = lists.flatten().to_numpy().reshape(len(lists), -1)
            return pa.array(predict(points), pa.int32())

        return df.withColumn(out, cluster(vector_to_array(F.col(self.features))))


# ---------------------------------------------------------------- starting centres
def _hash32(data: bytes, seed: int) -> int:
    """MurmurHash3 of bytes, a multiple of four."""
    mask, h = 0xFFFFFFFF, seed
    for (k,) in struct.iter_unpack("<I", data):
        k = k * 0xCC9E2D51 & mask
        k = (k << 15 | k >> 17) * 0x1B873593 & mask
        h ^= k
        h = ((h << 13 | h >> 19) & mask) * 5 + 0xE6546B64 & mask
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & mask
    h = (h ^ h >> 13) * 0xC2B2AE35 & mask
    return h ^ h >> 16


def _state(seed: int) -> int:
    """What Spark's ``XORShiftRandom`` begins with."""
    data = struct.pack(">q", seed)
    low = _hash32(data, 0x3C074A61)
    return _hash32(data, low) << 32 | low


def _shift(states: np.ndarray) -> np.ndarray:
    states = states ^ (states << np.uint64(21))
    states ^= states >> np.uint64(35)
    return states ^ (states << np.uint64(4))


def _turn(images: np.ndarray, states: np.ndarray) -> np.ndarray:
    """States after as many shifts as ``images`` stand for: the images of the 64 bits."""
    bits = (states[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)
    return np.bitwise_xor.reduce(np.where(bits.astype(bool), images, np.uint64(0)), axis=1)


@cache
def _jumps() -> list[np.ndarray]:
    """Images of the bits after 1, 2, 4, ... shifts."""
    found = [_shift(np.uint64(1) << np.arange(64, dtype=np.uint64))]
    while len(found) < 48:
        found.append(_turn(found[-1], found[-1]))
    return found


def draws(seed: int, before: int, count: int) -> np.ndarray:
    """Doubles that Spark's ``XORShiftRandom`` draws after the first ``before`` ones."""
    jumps, lane = _jumps(), 4
    states = np.array([_state(seed)], np.uint64)
    for at in range((2 * before).bit_length()):
        if 2 * before >> at & 1:
            states = _turn(jumps[at], states)
    # Lanes of 16 shifts advance side by side.
    while len(states) << 4 < 2 * count:
        states, lane = np.concatenate([states, _turn(jumps[lane], states)]), lane + 1
    lanes = []
    for _ in range(16):
        states = _shift(states)
        lanes.append(states)
    row = np.stack(lanes, axis=1).ravel()[: 2 * count]
    high, low = row[0::2] & np.uint64((1 << 26) - 1), row[1::2] & np.uint64((1 << 27) - 1)
    return ((high << np.uint64(27)) + low).astype(float) * 2.0**-53


def first_seed(seed: int) -> int:
    """The first whole number drawn, which Spark's initialisation draws everything from."""
    found = int(_shift(np.array([_state(seed)], np.uint64))[0]) & 0xFFFFFFFF
    return found - (1 << 32) if found >> 31 else found


def _apart(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, a line per centre."""
    lengths, own = np.square(points).sum(axis=1), np.square(centres).sum(axis=1)
    found = -2 * centres @ points.T
    found += lengths
    found += own[:, None]
    centre, row = np.nonzero(found < CLOSE * (lengths + own.max()))
    for at in range(0, len(row), BLOCK_ROWS):
        one, other = centre[at : at + BLOCK_ROWS], row[at : at + BLOCK_ROWS]
        found[one, other] = np.square(points[other] - centres[one]).sum(axis=1)
    return found


@dataclass
class Candidates:
    """Points taken at one width, and which of them each of the fits took, in their order."""

    ks: np.ndarray
    points: np.ndarray
    taken: list[list[int]]

    def costs(self, block: np.ndarray) -> np.ndarray:
        """Per fit the rows' squared distances to the nearest point taken."""
        apart = _apart(block[:, : self.points.shape[1]], self.points)
        return np.stack([apart[own].min(axis=0) for own in self.taken])

    def drop_copies(self) -> None:
        for at, own in enumerate(self.taken):
            first: dict[tuple, int] = {}
            for i in own:
                first.setdefault(tuple(self.points[i].tolist()), i)
            self.taken[at] = list(first.values())


def starting_centres_together(
    blocks: RDD, first: np.ndarray, sizes: Mapping[int, Sequence[int]], seed: int,
    settle: Callable[[np.ndarray, np.ndarray, int], np.ndarray],
) -> dict[tuple[int, int], np.ndarray]:
    """The centres Spark's k-means begins with, for numbers of clusters by width.

    Spark takes points at random, in proportion to their distance from those taken before, each
    row with a number drawn for its partition and place. The numbers do not depend on the fit,
    so all fits take their points in the same passes. ``first`` is the point all begin with;
    ``settle`` makes centres of points and the numbers of rows nearest to them.
    """
    found = {
        width: Candidates(np.array(list(ks)), first[None, :width], [[0] for _ in ks]) for width, ks in sizes.items()
    }
    for turn in range(START_ROUNDS):
        known = list(found.values())
        whole = add_up(blocks, lambda b: [c.costs(b).sum(axis=1) for c in known])  # noqa: B023

        def take(part: Iterable[Block], turn=turn, known=known, whole=whole) -> Iterator[tuple]:
            for block in part:
                drawn = draws(seed ^ (turn << 16) ^ block.part, block.before, len(block.points))
                for at, (own, total) in enumerate(zip(known, whole, strict=True)):
                    with np.errstate(divide="ignore", invalid="ignore"):
                        hit = drawn < 2.0 * own.costs(block.points) * own.ks[:, None] / total[:, None]
                    for row in np.flatnonzero(hit.any(axis=0)):
                        point = block.points[row, : own.points.shape[1]].copy()
                        yield block.part, block.before + int(row), at, hit[:, row].copy(), point

        for *_, at, hit, point in sorted(blocks.mapPartitions(take).collect(), key=lambda line: line[:3]):
            own = known[at]
            for fit in np.flatnonzero(hit):
                own.taken[fit].append(len(own.points))
            own.points = np.concatenate([own.points, point[None]])
    for own in found.values():
        own.drop_copies()

    def count(block: np.ndarray) -> list[np.ndarray]:
        out = []
        for own in found.values():
            apart = _apart(block[:, : own.points.shape[1]], own.points)
            out += [_hot(apart[taken], np.array([0, len(taken)])).sum(axis=1) for taken in own.taken]
        return out

    weights = iter(add_up(blocks, count))
    starts = {}
    for width, own in found.items():
        for k, taken in zip(own.ks.tolist(), own.taken, strict=True):
            points, near = own.points[taken], next(weights)
            starts[width, k] = points if len(points) <= k else settle(points, near.astype(float), k)
    return starts


# ---------------------------------------------------------------- k-means
@dataclass
class Moving:
    """Centres on their way, and the number of steps they made."""

    centres: np.ndarray
    steps: int = 0
    ended: bool = False
    still: bool = False
    sums: np.ndarray | None = None

    def update(self, sums: np.ndarray, tolerance: float | None) -> None:
        """New centres from rows of count, squared lengths and coordinates.

        Without a ``tolerance`` the fit ends early only where more steps would find the same.
        """
        known = sums[:, 0] > 0
        new = self.centres.copy()
        new[known] = sums[known, 2:] / sums[known, :1]
        moved = np.square(new - self.centres)[known].sum(axis=1)
        self.steps += 1
        if tolerance is None:
            new[~known] = np.nan
            same = known == ~np.isnan(self.centres[:, 0])
            self.still = bool(same.all() and (moved <= STILL**2 * np.square(new[known]).sum(axis=1)).all())
        else:
            self.still = bool((moved <= tolerance**2).all())
        self.centres, self.sums = new, sums
        self.ended = self.still or self.steps >= MAX_STEPS


# ---------------------------------------------------------------- bisecting
class Noise:
    """Doubles of ``java.util.Random``, which Spark's bisecting fit draws per split."""

    def __init__(self, seed: int, width: int) -> None:
        self.state, self.width, self.drawn = (seed ^ 0x5DEECE66D) & ((1 << 48) - 1), width, []

    def _bits(self, number: int) -> int:
        self.state = (self.state * 0x5DEECE66D + 0xB) & ((1 << 48) - 1)
        return self.state >> (48 - number)

    def draw(self, at: int) -> np.ndarray:
        while len(self.drawn) <= at:
            row = [((self._bits(26) << 27) + self._bits(27)) * 2.0**-53 for _ in range(self.width)]
            self.drawn.append(np.array(row))
        return self.drawn[at]


class Part(NamedTuple):
    """A cluster of a bisecting fit: the split and side it comes from, count and sums."""

    at: tuple
    size: float
    cost: float
    centre: np.ndarray


def _part(at: tuple, sums: np.ndarray) -> Part:
    centre = sums[2:] / sums[0]
    cost = max(sums[1] - sums[0] * float(centre @ centre), 0.0)
    return Part(at, float(sums[0]), cost, centre)


@dataclass
class Bisection:
    """A fit with at most ``k`` leaves: nodes numbered as in a heap, the root being 1.

    All clusters of a level that are needed are split at the same time, the larger ones where
    not all are. A split is named by the cluster and the noise it starts from, so fits that
    make the same split share it.
    """

    k: int
    partitions: int
    active: dict[int, Part]
    needed: int = 0
    drawn: int = 0
    level: int = 1
    ended: bool = False
    splits: dict[int, tuple] = field(default_factory=dict)
    parts: dict[int, Part] = field(default_factory=dict)

    def plan(self) -> dict[int, tuple]:
        """The splits of the next level by the number of their node; none at the end."""
        if not (self.active and self.needed > 0 and self.level < MAX_LEVEL):
            return {}
        order = sorted(self.active, key=lambda i: (i % self.partitions, i))
        chosen = [i for i in order if self.active[i].cost > np.finfo(float).eps * self.active[i].size]
        if len(chosen) > self.needed:
            chosen = sorted(chosen, key=lambda i: -self.active[i].size)[: self.needed]
        return {i: (*self.active[i].at, self.drawn + n) for n, i in enumerate(chosen)}

    def grow(self, planned: dict[int, tuple], done: Mapping[tuple, Moving]) -> None:
        self.parts.update(self.active)
        self.splits.update(planned)
        self.active = {
            2 * i + side: _part((name, side), done[name].sums[side])
            for i, name in planned.items() for side in (0, 1) if done[name].sums[side][0] > 0
        }
        self.needed -= len(planned)
        self.drawn += len(planned)
        self.level += 1

    def model(self, done: Mapping[tuple, Moving], features: str) -> Model:
        nodes, leaves = {**self.parts, **self.active}, []

        def build(i: int) -> Fork | Leaf | None:
            if i not in nodes:
                return None
            if i not in self.splits:
                leaves.append(nodes[i].centre)
                return Leaf(len(leaves) - 1)
            return Fork(done[self.splits[i]].centres, [build(2 * i), build(2 * i + 1)])

        tree = build(1)
        return Model(np.array(leaves), tree, all(done[name].still for name in self.splits.values()), features)


def _rows_of(name: tuple, second: Mapping[tuple, np.ndarray], known: dict) -> np.ndarray:
    """Which rows belong to the cluster that a split divides."""
    if name not in known:
        parent, own = name[0], name[1]
        inside = second[parent] if own else ~second[parent]
        known[name] = inside & _rows_of(parent, second, known) if parent[0] else inside
    return known[name]


def _one_step(free: list[np.ndarray], wanted: list[tuple], forks: dict[tuple, np.ndarray]) -> Callable[[np.ndarray], list[np.ndarray]]:
    """Per block the sums of one, squared length and coordinates per centre of each fit."""
    plans = []
    for width in sorted({c.shape[1] for c in [*free, *forks.values()]}):
        moving = [at for at, c in enumerate(free) if c.shape[1] == width]
        names = [name for name, c in forks.items() if c.shape[1] == width]
        split = [at for at, name in enumerate(wanted) if forks[name].shape[1] == width]
        tables = [*(free[at] for at in moving), *(forks[name] for name in names)]
        places = [*moving, *(len(free) + at for at in split)]
        parts = np.cumsum([*(len(free[at]) for at in moving), *(2 for _ in split)])[:-1]
        ends = _ends(tables[: len(moving)])
        plans.append((width, names, [wanted[at] for at in split], places, np.concatenate(tables), ends, parts))

    def step(block: np.ndarray) -> list[np.ndarray]:
        out: list[np.ndarray] = [np.empty(0)] * (len(free) + len(wanted))
        cells, squares = np.empty((len(block), 2 + block.shape[1]), order="F"), np.square(block)
        cells[:, 0], cells[:, 2:] = 1.0, block
        for width, names, split, places, every, ends, parts in plans:
            cells[:, 1] = squares[:, :width].sum(axis=1)
            near = _near(block[:, :width], every)
            hot = [_hot(near[: ends[-1]], ends)] if len(ends) > 1 else []
            pairs = near[ends[-1] :].reshape(len(names), 2, len(block))
            second, known = {name: _second(pair) for name, pair in zip(names, pairs, strict=True)}, {}
            for name in split:
                inside = _rows_of(name, second, known) if name[0] else np.ones(len(block), bool)
                hot.append(np.stack([inside & ~second[name], inside & second[name]]))
            sums = np.split(np.concatenate(hot).astype(float) @ cells[:, : 2 + width], parts)
            for at, own in zip(places, sums, strict=True):
                out[at] = own
        return out

    return step


def fit_together(
    blocks: RDD, starts: Mapping[object, np.ndarray], bisecting: Mapping[object, int], seed: int,
    features: str, partitions: int, widths: Mapping[object, int] | None = None,
) -> dict[object, Model]:
    """K-means from each of ``starts`` and bisecting fits of the sizes given, by their names.

    ``widths`` tells how many coordinates a bisecting fit sees; without it all.
    """
    free = {name: Moving(centres) for name, centres in starts.items()}
    splits: dict[tuple, Moving] = {}
    fits: dict[object, Bisection] = {}
    if bisecting:
        size, squares, totals = add_up(blocks, lambda b: [np.array(len(b)), np.square(b).sum(axis=0), b.sum(axis=0)])
        width_of = {name: (widths or {}).get(name, len(totals)) for name in bisecting}
        noise = {width: Noise(seed, width) for width in width_of.values()}
        # The first split has no side it lies on; its width stands there.
        roots = {w: _part(((), w), np.concatenate([[size, squares[:w].sum()], totals[:w]])) for w in noise}
        fits = {name: Bisection(k, partitions, {1: roots[width_of[name]]}, k - 1) for name, k in bisecting.items()}
    plans: dict[object, dict[int, tuple]] = {}
    while True:
        if all(m.ended for m in splits.values()):
            for name, fit in fits.items():
                if fit.ended:
                    continue
                if plans.get(name):
                    fit.grow(plans[name], splits)
                plans[name] = fit.plan()
                fit.ended = not plans[name]
                for i, split in plans[name].items():
                    centre = fit.active[i].centre
                    apart = 1e-4 * float(np.linalg.norm(centre)) * noise[len(centre)].draw(split[2])
                    splits.setdefault(split, Moving(np.array([centre - apart, centre + apart])))
        moving = [m for m in free.values() if not m.ended]
        wanted = [name for name, m in splits.items() if not m.ended]
        if not moving and not wanted:
            # Splits that another fit had made already may lead to a level of their own.
            if all(fit.ended for fit in fits.values()):
                break
            continue
        needed = set()
        for name in wanted:
            while name:
                needed.add(name)
                name = name[0]
        forks = {name: splits[name].centres for name in splits if name in needed}
        sums = add_up(blocks, _one_step([m.centres for m in moving], wanted, forks))
        for m, own in zip(moving, sums, strict=False):
            m.update(own, TOLERANCE)
        for name, own in zip(wanted, sums[len(moving) :], strict=True):
            splits[name].update(own, None)
    models = {name: Model(m.centres, None, m.steps < MAX_STEPS, features) for name, m in free.items()}
    return models | {name: fit.model(splits, features) for name, fit in fits.items()}


# ---------------------------------------------------------------- scores
def _assigner(models: Sequence[Model]) -> Callable[[np.ndarray], np.ndarray]:
    """For points a line per cluster of each model: whether a row belongs to it."""
    flat = [m.centres for m in models if m.tree is None]
    forks: dict[int, tuple[int, np.ndarray]] = {}

    def numbered(node: Fork | Leaf | None) -> tuple | int:
        # Models share the centres of splits they have in common.
        if not isinstance(node, Fork):
            return node.number if node else 0
        number, _ = forks.setdefault(id(node.centres), (len(forks), node.centres))
        return number, *map(numbered, node.sides)

    trees = [(len(m.centres), m.tree and numbered(m.tree)) for m in models]
    count, ends = len(forks), _ends(flat)
    every = [*flat, *(centres for _, centres in forks.values())]
    table = np.concatenate(every) if every else np.empty((0, models[0].centres.shape[1]))

    def run(points: np.ndarray) -> np.ndarray:
        near = _near(points, table)
        hot = iter(np.split(_hot(near[: ends[-1]], ends), ends[1:-1]) if flat else [])
        second = [_second(pair) for pair in near[ends[-1] :].reshape(count, 2, len(points))]

        def fill(node: tuple | int, inside: np.ndarray, lines: np.ndarray) -> None:
            if isinstance(node, tuple):
                number, first, other = node
                fill(first, inside & ~second[number], lines)
                fill(other, inside & second[number], lines)
            else:
                lines[node] |= inside

        out = []
        for size, tree in trees:
            if tree is None:
                out.append(next(hot))
                continue
            lines = np.zeros((size, len(points)), bool)
            fill(tree, np.ones(len(points), bool), lines)
            out.append(lines)
        return np.concatenate(out)

    return run


def block_scores(blocks: RDD, models: Mapping[object, Model]) -> dict[object, Scores]:
    """Silhouette, cost and cluster sizes of every model, in two passes over the blocks.

    Points and centres are taken less a point among the centres, so that sums do not lose
    digits where all lie far from the origin.
    """
    if not models:
        return {}
    names: dict[int, list[object]] = {}
    for name, model in models.items():
        names.setdefault(model.centres.shape[1], []).append(name)
    own = {width: [models[name] for name in there] for width, there in names.items()}
    assign = {width: _assigner(there) for width, there in own.items()}
    ends = {width: _ends([m.centres for m in there]) for width, there in own.items()}
    middle = own[max(own)][0].centres.mean(axis=0)

    def sums(block: np.ndarray) -> list[np.ndarray]:
        out = []
        for width, assigned in assign.items():
            points = block[:, :width] - middle[:width]
            cells = np.empty((len(points), 2 + width), order="F")
            cells[:, 0], cells[:, 1], cells[:, 2:] = 1.0, np.square(points).sum(axis=1), points
            out.append(assigned(block[:, :width]).astype(float) @ cells)
        return out

    tables = dict(zip(assign, add_up(blocks, sums), strict=True))

    def scored(block: np.ndarray) -> list[np.ndarray]:
        return [
            silhouette_sums(block[:, :width] - middle[:width], assigned(block[:, :width]), tables[width], ends[width])
            for width, assigned in assign.items()
        ]

    scores = {}
    for (width, there), found in zip(own.items(), add_up(blocks, scored), strict=True):
        parts = np.split(tables[width], ends[width][1:-1])
        for name, model, table, score in zip(names[width], there, parts, found.tolist(), strict=True):
            sizes, centres = table[:, 0], model.centres - middle[:width]
            apart = table[:, 1] - 2 * (centres * table[:, 2:]).sum(axis=1) + sizes * np.square(centres).sum(axis=1)
            scores[name] = Scores(
                score / float(sizes.sum()) if (sizes > 0).sum() > 1 else None,
                float(np.maximum(apart, 0.0).sum()), [int(n) for n in sizes], model.converged,
            )
    return {name: scores[name] for name in models}


# ---------------------------------------------------------------- fits on leading coordinates
@dataclass
class Points:
    """Rows that fits are asked of, on any number of their leading coordinates."""

    rows: DataFrame
    features: str
    seed: int
    blocks: RDD
    asked: list[tuple[int, str, int]] = field(default_factory=list)

    def leading(self, width: int) -> Leading:
        return Leading(self, width)

    def _first(self, seed: int) -> np.ndarray:
        """The row Spark's initialisation begins with, taken by Spark."""
        sample = self.rows.select(self.features)._jdf.toJavaRDD().takeSample(False, 1, seed)
        if not len(sample):
            raise ValueError("there are no rows to cluster")
        return np.array(list(sample[0].get(0).toArray()), float)

    def _settle(self, points: np.ndarray, weights: np.ndarray, k: int) -> np.ndarray:
        """Centres among few weighted points, by the steps of Spark on its driver."""
        context = self.rows.sparkSession.sparkContext
        jvm, gateway = context._jvm, context._gateway
        local = jvm.org.apache.spark.mllib.clustering
        lines, sizes = gateway.new_array(local.VectorWithNorm, len(points)), gateway.new_array(jvm.double, len(points))
        for at, (point, weight) in enumerate(zip(points.tolist(), weights.tolist(), strict=True)):
            values = gateway.new_array(jvm.double, len(point))
            for place, value in enumerate(point):
                values[place] = value
            lines[at] = local.VectorWithNorm(jvm.org.apache.spark.mllib.linalg.Vectors.dense(values))
            sizes[at] = weight
        centres = local.LocalKMeans.kMeansPlusPlus(0, lines, sizes, k, START_STEPS)
        return np.array([list(c.vector().toArray()) for c in centres], float)

    def fitted(self) -> tuple[dict[tuple, Model], dict[tuple, Scores]]:
        """Models and scores of all fits asked for, by width, algorithm and k."""
        sizes: dict[int, list[int]] = {}
        for width, algorithm, k in self.asked:
            if algorithm == "kmeans":
                sizes.setdefault(width, []).append(k)
        free = {}
        if sizes:
            seed = first_seed(self.seed)
            found = starting_centres_together(self.blocks, self._first(seed), sizes, seed, self._settle)
            free = {(width, "kmeans", k): centres for (width, k), centres in found.items()}
        halved = {asked: asked[2] for asked in self.asked if asked[1] == "bisecting"}
        widths = {asked: asked[0] for asked in halved}
        partitions = self.rows.rdd.getNumPartitions()
        models = fit_together(self.blocks, free, halved, self.seed, self.features, partitions, widths)
        return models, block_scores(self.blocks, models)


@dataclass
class Leading:
    """The first coordinates of points."""

    points: Points
    width: int

    def ask(self, algorithm: str, k: int) -> None:
        if algorithm not in ("kmeans", "bisecting"):
            raise ValueError(f"unknown algorithm {algorithm!r}")
        if k < 2:
            raise ValueError(f"{k} clusters asked of a fit, which has two or more")
        self.points.asked.append((self.width, algorithm, k))


@contextmanager
def points_of(rows: DataFrame, features: str, seed: int) -> Iterator[Points]:
    with blocks_of(rows, features) as blocks:
        yield Points(rows, features, seed, blocks)
