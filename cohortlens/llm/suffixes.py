"""Passages that several documents share, found with a sparse suffix array.

Of all suffixes only those are retained that begin at a minimiser: the smallest hash of
``CORE`` words among ``WINDOW`` neighbouring ones. Any ``CORE + WINDOW - 1`` = 50 words then
hold a retained position, the same one wherever they stand, so no shared passage of 50 words
is missed. Suffixes are ordered by their core; a core that stands in one document only is
dropped. Suffixes that go on alike on both sides as far as a 50-word passage around the core
can reach are merged before anything is compared. The rest is sorted, and suffixes with the
same core are extended to the left and right over every way a 50-word passage can lie around
it, and neighbours that agree are matches. Cores with very many different surroundings are
compared by a distributed aggregate over the same keys instead of in one task.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.llm.common import WORD, map_arrays, map_rows, utf8
from cohortlens.sources.scratch import written

MIN_WORDS = 50
CORE = 14
WINDOW = MIN_WORDS - CORE + 1
#: Words on either side of a core that a passage of MIN_WORDS around it can reach.
REACH = MIN_WORDS - CORE
#: Surroundings of one core that are compared in one task; more are compared by an aggregate.
GROUP = 4096

_WORDS = re.compile(WORD)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_SIDE = np.array([_BASE, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


class _Powers:
    """Powers of the rolling hash's base and of its inverse. Those for long texts are made when
    they are needed and not kept."""

    KEPT = 1 << 14
    base = inverse = np.ones(1, np.uint64)

    @classmethod
    def upto(cls, count: int) -> tuple[np.ndarray, np.ndarray]:
        if count > cls.KEPT:
            return cls._made(count)
        if len(cls.base) < count:
            cls.base, cls.inverse = cls._made(cls.KEPT)
        return cls.base[:count], cls.inverse[:count]

    @staticmethod
    def _made(count: int) -> tuple[np.ndarray, np.ndarray]:
        steps = np.full((2, count), [[_BASE], [_INVERSE]], np.uint64)
        steps[:, 0] = 1
        base, inverse = np.cumprod(steps, axis=1, dtype=np.uint64)
        return base, inverse


def mix(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that order and equality of sums say nothing about the words."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def word_hashes(text: str | None) -> np.ndarray:
    words = utf8(text).split()
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def running(words: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * _Powers.upto(len(words))[0], out=sums[1:], dtype=np.uint64)
    return sums


def spans_hash(sums: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Hashes of the words in ``[low, high)``; equal words give equal hashes anywhere."""
    return mix((sums[high] - sums[low]) * _Powers.upto(len(sums))[1][low])


def minimisers(cores: np.ndarray) -> np.ndarray:
    """Places of the smallest core hash (the first, if tied) in every window."""
    windows = np.lib.stride_tricks.sliding_window_view(cores, WINDOW)
    found = np.empty(len(windows), np.int64)
    for start in range(0, len(windows), 1 << 15):
        part = windows[start : start + (1 << 15)]
        found[start : start + len(part)] = part.argmin(axis=1) + np.arange(start, start + len(part))
    return np.unique(found)


def retained(text: str | None) -> tuple[np.ndarray, ...]:
    """``(place, end, core, context)`` of the suffixes retained: where they begin, how far the
    surroundings reach, and the hashes of the core and of core and surroundings."""
    words = word_hashes(text)
    count = len(words)
    if count < MIN_WORDS:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, empty
    sums = running(words)
    every = np.arange(count - CORE + 1)
    cores = spans_hash(sums, every, every + CORE)
    at = minimisers(cores)
    low, high = np.maximum(at - REACH, 0), np.minimum(at + MIN_WORDS, count)
    around = spans_hash(sums, low, high) + (at - low).astype(np.uint64) * _SIDE[1] + (high - at).astype(np.uint64)
    return at, high, cores[at].view(np.int64), mix(around).view(np.int64)


_LONG, _INT = T.LongType(), T.IntegerType()
SUFFIXES = T.StructType(
    [T.StructField(n, t) for n, t in (("id", _LONG), ("body", _LONG), ("place", _INT), ("end", _INT), ("core", _LONG), ("context", _LONG))]
)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, body, text)``: a document's id, null as the smallest number, and its text's hash."""
    return docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("id"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("body"),
        F.col(text_col).alias("text"),
    )


def suffixes(texts: DataFrame) -> DataFrame:
    def make(rows: Iterable[tuple]) -> Iterator[tuple]:
        for key, body, text in rows:
            at, end, core, context = retained(text)
            if len(at):
                yield np.full(len(at), key), np.full(len(at), body), at.astype(np.int32), end.astype(np.int32), core, context

    return map_arrays(texts, make, SUFFIXES)


# --- surroundings of cores -------------------------------------------------------------

SURROUNDINGS = T.StructType(
    [
        T.StructField("core", _LONG),
        T.StructField("context", _LONG),
        T.StructField("first", _LONG),
        T.StructField("last", _LONG),
        T.StructField("many", T.BooleanType()),
        T.StructField("left", T.BinaryType()),
        T.StructField("right", T.BinaryType()),
    ]
)


def surroundings(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The words around the cores in ``wanted`` (id, body, cores), as 32-bit hashes outwards."""
    joined = texts.join(wanted, ["id", "body"]).select("text", "cores")

    def make(rows: Iterable[tuple]) -> Iterator[tuple]:
        for text, cores in rows:
            words = word_hashes(text).astype("<u4")
            for c in cores:
                at = c["place"]
                left = words[max(0, at - REACH) : at][::-1]
                right = words[at + CORE : at + MIN_WORDS]
                yield c["core"], c["context"], c["first"], c["last"], c["many"], left.tobytes(), right.tobytes()

    return map_rows(joined, make, SURROUNDINGS)


def passages(cores: np.ndarray, lefts: list[bytes], rights: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every 50-word passage around each core: ``(row, words left of the core, key)``."""
    sides, sizes = [], []
    for values in (lefts, rights):
        size = np.array([len(v) // 4 for v in values])
        padded = b"".join(v.ljust(4 * REACH, b"\0") for v in values)
        words = np.frombuffer(padded, "<u4").reshape(-1, REACH).astype(np.uint64)
        sums = np.zeros((len(values), REACH + 1), np.uint64)
        np.cumsum(mix(words + _SIDE[2]) * _Powers.upto(REACH)[0], axis=1, out=sums[:, 1:], dtype=np.uint64)
        sides.append(sums)
        sizes.append(size)
    out = np.arange(REACH + 1)
    fits = (out[None, :] <= sizes[0][:, None]) & (REACH - out[None, :] <= sizes[1][:, None])
    row, left = np.nonzero(fits)
    key = mix(sides[0][row, left] * _SIDE[0] + mix(sides[1][row, REACH - left]) * _SIDE[1] + left.astype(np.uint64))
    return row, left, mix(key ^ mix(cores.view(np.uint64)[row]))


def compared(cores: np.ndarray, lefts: list[bytes], rights: list[bytes], first: np.ndarray, last: np.ndarray) -> list[np.ndarray]:
    """For each row the extent of its passages found in several documents, and of those an
    earlier document holds: ``shared_low, shared_high, known_low, known_high``, as words before
    and after the core's place; 0 and 0 for none."""
    row, left, key = passages(cores, lefts, rights)
    order = np.argsort(key, kind="stable")
    row, left, key = row[order], left[order], key[order]
    result = [np.zeros(len(cores), np.int32) for _ in range(4)]
    if not len(key):
        return result
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    sizes = np.diff(np.r_[starts, len(key)])
    low = np.repeat(np.minimum.reduceat(first[row], starts), sizes)
    high = np.repeat(np.maximum.reduceat(last[row], starts), sizes)
    for at, chosen in ((0, low < high), (2, low < first[row])):
        np.minimum.at(result[at], row[chosen], -left[chosen].astype(np.int32))
        np.maximum.at(result[at + 1], row[chosen], (MIN_WORDS - left[chosen]).astype(np.int32))
    return result


EXTENTS = T.StructType(
    [
        *(T.StructField(n, _LONG) for n in ("core", "context")),
        *(T.StructField(n, _INT) for n in ("shared_low", "shared_high", "known_low", "known_high")),
    ]
)


def _compare_sorted(rows: Iterable[tuple]) -> Iterator[tuple]:
    """Rows ordered by core; whole cores are gathered and compared together."""

    def flush(held: list[tuple]) -> tuple:
        core, context, first, last, left, right = zip(*held, strict=True)
        cores = np.array(core, np.int64)
        return cores, np.array(context, np.int64), *compared(cores, list(left), list(right), np.array(first), np.array(last))

    held: list[tuple] = []
    for row in rows:
        if len(held) >= GROUP and row[0] != held[-1][0]:
            yield flush(held)
            held = []
        held.append(row)
    if held:
        yield flush(held)


def _compare_wide(wide: DataFrame) -> DataFrame:
    """The same comparison by an aggregate, for cores with very many surroundings."""
    schema = T.StructType(
        [*(T.StructField(n, _LONG) for n in ("core", "context", "first", "last", "key")), T.StructField("left", _INT)]
    )

    def make(rows: Iterable[tuple]) -> Iterator[tuple]:
        for core, context, first, last, left, right in rows:
            _, before, key = passages(np.array([core], np.int64), [left], [right])
            same = [np.full(len(key), value, np.int64) for value in (core, context, first, last)]
            yield *same, key.view(np.int64), before.astype(np.int32)

    every = map_arrays(wide, make, schema)
    found = every.groupBy("key").agg(F.min("first").alias("low"), F.max("last").alias("high"))
    found = written(found.filter("low < high"), "windows")
    extent = lambda when, value, pick, name: F.coalesce(pick(F.when(when, value)), F.lit(0)).cast("int").alias(name)
    known = F.col("low") < F.col("first")
    end = F.lit(MIN_WORDS) - F.col("left")
    return (
        every.join(found, "key")
        .groupBy("core", "context")
        .agg(
            extent(F.lit(True), -F.col("left"), F.min, "shared_low"),
            extent(F.lit(True), end, F.max, "shared_high"),
            extent(known, -F.col("left"), F.min, "known_low"),
            extent(known, end, F.max, "known_high"),
        )
    )


# --- passages of documents -------------------------------------------------------------


def occurrences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Extents in words around retained places: ``id, body, first, shared_*, known_*``.

    ``first`` is the smallest id with the same surroundings; ``known`` extents are those that a
    document with a smaller id holds too.
    """
    texts = keyed(docs, id_col, text_col)
    every = written(suffixes(texts), "suffixes")
    common = every.groupBy("core").agg(F.min("id").alias("low"), F.max("id").alias("high")).filter("low < high")
    # Written first: then both sides of the join are plain exchanges, and a hot core is split.
    every = written(every.join(written(common.select("core"), "cores"), "core", "left_semi"), "common")
    contexts = written(
        every.groupBy("core", "context").agg(
            F.min(F.struct("id", "body", "place")).alias("at"), F.min("id").alias("first"), F.max("id").alias("last")
        ),
        "contexts",
    )
    several = written(contexts.groupBy("core").agg(F.count(F.lit(1)).alias("ways")).filter("ways > 1"), "several")
    part = F.struct("core", "context", "at.place", "first", "last", (F.col("ways") > GROUP).alias("many"))
    wanted = (
        contexts.join(several, "core")
        .groupBy(F.col("at.id").alias("id"), F.col("at.body").alias("body"))
        .agg(F.collect_list(part).alias("cores"))
    )
    around = written(surroundings(texts, wanted), "surroundings")
    columns = ["core", "context", "first", "last", "left", "right"]
    few = around.filter("not many").select(columns).repartition("core").sortWithinPartitions("core", "right")
    extents = map_arrays(few, _compare_sorted, EXTENTS).union(_compare_wide(around.filter("many").select(columns)))
    extents = extents.dropDuplicates(["core", "context"])  # rows equal in id and text give theirs twice
    zero = lambda name: F.coalesce(F.col(name), F.lit(0))
    facts = written(
        contexts.select("core", "context", "first", "last").join(extents, ["core", "context"], "left"), "facts"
    )
    whole = (F.col("first") < F.col("last")).alias("whole")
    rows = every.join(facts.select("*", whole), ["core", "context"])
    start = F.greatest(F.col("place") - REACH, F.lit(0))
    later = F.col("id") != F.col("first")
    return rows.select(
        "id",
        "body",
        "first",
        F.when(F.col("whole"), start).otherwise(F.col("place") + zero("shared_low")).alias("shared_low"),
        F.when(F.col("whole"), F.col("end")).otherwise(F.col("place") + zero("shared_high")).alias("shared_high"),
        F.when(later, start).otherwise(F.col("place") + zero("known_low")).alias("known_low"),
        F.when(later, F.col("end")).otherwise(F.col("place") + zero("known_high")).alias("known_high"),
    )


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of half-open spans; empty ones are left out."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(s for s in spans if s[0] < s[1]):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per stretch of words that lies in shared passages of 50 or more words.

    Columns: doc_id, start_word, n_words, first_doc_id (the smallest id among the documents
    that share the surroundings of a place in the stretch) and known_words, how many words of
    the stretch an earlier document holds; 0 in the first document. A passage is shared if it
    stands in documents with different ids; rows with equal ids count as one document, and so
    do rows without an id. Texts of fewer than 50 words and null texts share nothing. Documents
    that share nothing have no row. Other columns are not read; an empty table gives an empty
    table.
    """
    found = occurrences(docs, id_col, text_col)
    parts = F.struct("shared_low", "shared_high", "known_low", "known_high", "first")
    grouped = found.groupBy("id", "body").agg(F.collect_list(parts).alias("parts")).select("id", "parts")
    schema = T.StructType(
        [
            *(T.StructField(n, _LONG) for n in ("doc_id", "start_word", "n_words", "first_doc_id", "known_words")),
        ]
    )

    def make(rows: Iterable[tuple]) -> Iterator[tuple]:
        none = -(1 << 63)
        for key, parts in rows:
            parts.sort(key=lambda p: (p["shared_low"], p["shared_high"]))
            known = merged((p["known_low"], p["known_high"]) for p in parts)
            for low, high in merged((p["shared_low"], p["shared_high"]) for p in parts):
                inside = [p for p in parts if low <= p["shared_low"] and p["shared_high"] <= high]
                first = min(p["first"] for p in inside if p["shared_low"] < p["shared_high"])
                held = sum(max(0, min(high, b) - max(low, a)) for a, b in known)
                yield (None if key == none else key), low, high - low, (None if first == none else first), held

    return map_rows(grouped, make, schema)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """The rows of ``docs`` with the passages cut out that a document with a smaller id holds.

    The words go with the white space after them; everything else in a text stays as it is.
    Every row stays, if with an empty text. ``length_col``, where there is one, is counted anew
    for the texts cut. Null texts stay null.
    """
    found = occurrences(docs, id_col, text_col).filter("known_low < known_high")
    spans = written(
        found.groupBy("id", "body").agg(F.collect_set(F.struct("known_low", "known_high")).alias("spans")), "spans"
    )
    rows = docs.select(F.struct("*").alias("row"))
    text = F.col("row")[text_col]
    rows = rows.select(
        "row",
        F.coalesce(F.col("row")[id_col].cast("long"), F.lit(-(1 << 63))).alias("id"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("body"),
    )
    joined = rows.join(spans, ["id", "body"], "left")
    hit = F.col("spans").isNotNull()
    made = joined.select(
        "row", hit.alias("hit"), _cut(F.when(hit, text), "spans.known_low", "spans.known_high").alias("cut_text")
    )

    def column(name: str) -> Column:
        kept = F.col("row")[name]
        if name == text_col:
            return F.when(F.col("hit"), F.col("cut_text")).otherwise(kept)
        if name == length_col:
            return F.when(F.col("hit"), F.length("cut_text")).otherwise(kept).cast(docs.schema[name].dataType)
        return kept

    return made.select(*(column(name).alias(name) for name in docs.columns))


def cut(text: str, spans: Iterable[tuple[int, int]]) -> str:
    """``text`` without the words in the spans and the white space after them."""
    starts = [m.start() for m in _WORDS.finditer(text)] + [len(text)]
    out, at = [], 0
    for low, high in merged(spans):
        out.append(text[at : starts[low]])
        at = starts[min(high, len(starts) - 1)]
    return "".join([*out, text[at:]])


@F.pandas_udf(T.StringType())
def _cut(texts: pd.Series, lows: pd.Series, highs: pd.Series) -> pd.Series:
    made = [
        None if text is None else cut(text, zip(low.tolist(), high.tolist(), strict=True))
        for text, low, high in zip(texts, lows, highs, strict=True)
    ]
    return pd.Series(made, dtype=object)
