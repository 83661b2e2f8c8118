"""Packing documents into sequences of fixed length by exact-complement hashing.

Only the number of pieces of each length matters for the plan, and there are at most as many
lengths as a sequence has tokens. The plan is made on those counts: single lengths and pairs are
indexed by their sum, triples as a length and an indexed pair; what fills a gap exactly is used
as often as all its lengths are available, and what is left is packed best-fit. Each step uses up a length
or is the last of its kind, so the plan stays short whatever the number of pieces. Pieces are
then numbered within their length on the cluster and find their place in the plan.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.llm.common import map_rows, numbered
from cohortlens.sources.scratch import written

SEQUENCE_TOKENS = 2048
END_ID = 0
#: Stretches between spaces whose ids are kept at hand while a partition is encoded.
KNOWN_FORMS = 200_000

# The published split pattern of this byte-level vocabulary.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Below this character the libraries' Unicode tables agree on letters, digits and white space.
SETTLED = "\u0590"

IDS = np.dtype("<u4")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Ids:
    """Token ids of whole texts, as bytes of little-endian 32-bit numbers.

    The ids are those of the tokenizer in the file. Its split pattern never joins what stands
    before a single space with what follows, so ids are looked up for each stretch between
    spaces and found once for each new stretch, by a faster library that reads the same
    vocabulary. Texts with white space side by side are encoded whole; texts or stretches
    with rarer characters, or with an added token's own string, go to the tokenizer itself.
    """

    def __init__(self, path: str) -> None:
        from tiktoken import Encoding
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        self.added = [token.content for token in added.values()]
        # Byte-level vocabularies write a byte that is not printable as a character from 256 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        ranks = {bytes(byte[c] for c in token): n for token, n in vocabulary.items() if n not in added}
        self.fast = Encoding("given", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.known: dict[str, bytes] = {}

    def exact(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, IDS).tobytes()

    def whole(self, text: str) -> bytes:
        if not text.isascii() and max(text) >= SETTLED:
            return self.exact(text)
        return np.array(self.fast.encode_ordinary(text), IDS).tobytes()

    def __call__(self, text: str) -> bytes:
        if any(content in text for content in self.added):
            return self.exact(text)
        first, *rest = text.split(" ")
        known = self.known
        try:
            return self.whole(first) + b"".join(map(known.__getitem__, rest)) if rest else self.whole(first)
        except KeyError:
            pass
        new = set(rest).difference(known)
        if not first or first[-1].isspace() or any(not s or s[0].isspace() or s[-1].isspace() for s in new):
            return self.whole(text)
        found = {s: self.whole(" " + s) for s in new}
        if len(known) + len(found) <= KNOWN_FORMS:
            known.update(found)
            return self.whole(first) + b"".join(map(known.__getitem__, rest))
        return self.whole(first) + b"".join([found[s] if s in found else known[s] for s in rest])


def cut(tokens: int, size: int = SEQUENCE_TOKENS) -> Iterator[tuple[int, int]]:
    """``(start, length)`` of a document's pieces: all full but the first, if one is short."""
    short = tokens % size
    start = 0
    if short or not tokens:
        yield 0, short
        start = short
    for at in range(start, tokens, size):
        yield at, size


PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
)


def pieces(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SEQUENCE_TOKENS,
    vocabulary: str | None = None,
) -> DataFrame:
    """Tokenised pieces of all documents; each document ends with the end id."""

    def make(rows: Iterable[tuple]) -> Iterator[tuple]:
        # Made for this partition and let go with it: later stages reuse the worker.
        ids = Ids(vocabulary or default_vocabulary())
        end = np.array([END_ID], IDS).tobytes()
        for key, text in rows:
            data = ids(text or "") + end
            for number, (start, length) in enumerate(cut(len(data) // 4, size)):
                yield key, number, start, length, zlib.crc32(data[4 * start : 4 * (start + length)])

    return map_rows(docs.select(F.col(id_col).cast("long"), F.col(text_col)), make, PIECES)


Plan = list[tuple[tuple[int, ...], int]]


class Sums:
    """Lengths that are left, and their pairs by sum; a triple is a length and a pair of the rest."""

    def __init__(self, counts: dict[int, int], size: int) -> None:
        self.size = size
        self.left = np.zeros(size + 1, np.int64)
        for n, count in counts.items():
            self.left[n] = max(count, 0)
        #: For each sum the longer members of its pairs, longest first.
        self.pairs = [self._there(s, np.arange(s - 1, (s - 1) // 2, -1)) for s in range(size + 1)]
        #: How many of them are still there.
        self.live = np.array([len(longer) for longer in self.pairs])

    def _there(self, total: int, longer: np.ndarray) -> np.ndarray:
        other = self.left[total - longer]
        return longer[(self.left[longer] > 0) & (other > 0) & ((2 * longer != total) | (other > 1))]

    def enough(self, *combination: int) -> bool:
        return all(self.left[n] >= combination.count(n) for n in combination)

    def take(self, n: int, times: int) -> None:
        """Take pieces of length ``n`` away, and the pairs that end with them."""
        before = self.left[n]
        self.left[n] -= times
        if self.left[n] < 2 <= before and 2 * n <= self.size:
            self.live[2 * n] -= 1
        if not self.left[n]:
            self.live[n + np.flatnonzero(self.left[: self.size - n + 1])] -= 1

    def pair(self, total: int, longest: int, *held: int) -> tuple[int, int] | None:
        """A pair of this sum that is there beside the pieces held, none of it over ``longest``."""
        if not self.live[total]:
            return None
        if 2 * self.live[total] < len(self.pairs[total]):
            self.pairs[total] = self._there(total, self.pairs[total])
        for a in self._there(total, self.pairs[total]).tolist():
            if a <= longest and self.enough(*held, a, total - a):
                return a, total - a
        return None

    def filling(self, first: int) -> tuple[int, ...] | None:
        """``first`` with one, two or three others that fill a sequence exactly."""
        gap = self.size - first
        if not gap:
            return (first,)
        if self.enough(first, gap):
            return first, gap
        # Pairs and triples with their longest member first keep short pieces for later gaps.
        if pair := self.pair(gap, gap, first):
            return first, *pair
        longest = np.arange(gap - 2, (gap + 2) // 3 - 1, -1)
        for a in longest[(self.left[longest] > 0) & (self.live[gap - longest] > 0)].tolist():
            if pair := self.pair(gap - a, a, first, a):
                return first, a, *pair
        return None


def plan(counts: dict[int, int], size: int = SEQUENCE_TOKENS) -> Plan:
    """Combinations of lengths and how many sequences each fills, for the given piece counts."""
    sums = Sums(counts, size)
    left = sums.left
    out: Plan = []

    def use(combination: tuple[int, ...]) -> None:
        times = min(int(left[n]) // combination.count(n) for n in set(combination))
        out.append((combination, times))
        for n in set(combination):
            sums.take(n, times * combination.count(n))

    for first in np.flatnonzero(left)[::-1].tolist():
        while left[first] and (combination := sums.filling(first)):
            use(combination)
    while left.any():
        # Best-fit decreasing on the counts: the longest piece, then whatever fits best.
        chosen: list[int] = []
        gap = size
        ascending = np.flatnonzero(left).tolist()
        while True:
            at = bisect_right(ascending, gap) - 1
            while at >= 0 and left[ascending[at]] <= chosen.count(ascending[at]):
                at -= 1
            if at < 0:
                break
            chosen.append(ascending[at])
            gap -= ascending[at]
        use(tuple(chosen))
    return out


def places(found: Plan) -> dict[int, tuple[list[int], list[int], list[int]]]:
    """For each length: first piece numbers of its runs, with each run's first sequence and offset."""
    out: dict[int, tuple[list[int], list[int], list[int]]] = {}
    given: dict[int, int] = {}
    sequence = 0
    for combination, times in found:
        offset = 0
        for n in combination:
            starts, sequences, offsets = out.setdefault(n, ([], [], []))
            starts.append(given.get(n, 0))
            sequences.append(sequence)
            offsets.append(offset)
            given[n] = given.get(n, 0) + times
            offset += n
        sequence += times
    return out


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SEQUENCE_TOKENS,
    vocabulary: str | None = None,
) -> DataFrame:
    """One row per piece with its sequence and its place there, as few sequences as can be.

    A null text counts as empty and is one piece of the end id alone. Null ids stay null; rows
    with equal ids are packed each for itself. Ties between pieces of one length are ordered by
    id, piece and content, so reruns agree. Other columns are not read. An empty table gives an
    empty table. Only the counts per length (at most ``size`` rows) reach the driver.
    """
    cut_up = written(pieces(docs, id_col, text_col, size, vocabulary), "pieces")
    counts = {r["length"]: r["n"] for r in cut_up.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    where = cut_up.sparkSession.sparkContext.broadcast(places(plan(counts, size)))
    order = ["doc_id", "piece", "ids_crc32"]
    ranked = numbered(cut_up, ["length"], order, sum(counts.values()))

    def make(rows: Iterable[tuple]) -> Iterator[tuple]:
        found = where.value
        for *row, number in rows:
            starts, sequences, offsets = found[row[3]]
            run = bisect_right(starts, number) - 1
            yield *row, sequences[run] + number - starts[run], offsets[run]

    schema = T.StructType(
        [*PIECES.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )
    return map_rows(ranked.select(*PIECES.names, "number"), make, schema)
