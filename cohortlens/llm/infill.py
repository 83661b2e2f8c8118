"""Fill-in-the-middle: a text's middle is moved to its end, between marker strings.

A unit is a run of letters A-Z, a-z or any other single code point. Cuts fall between units,
so the text is never decoded: its UTF-8 is read eight bytes at a time as unsigned words, the
bytes that end a unit are marked by arithmetic on the whole word, marks are counted per word,
a cut's word is found in the running counts, and its byte by a running count inside the word.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.llm.common import map_rows

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKERS = (PREFIX, SUFFIX, MIDDLE)
SEED = 1
#: Percent of the texts that are rearranged, and of those the share with the suffix first.
RATE = 90
SUFFIX_FIRST = 20
#: Words marked at a time, so that what is held beside a long text stays small.
BLOCK = 1 << 15
#: Outputs in a batch; each is about as long as its text.
OUTPUT_ROWS = 256

_WORD = np.dtype("<u8")
_ONES = np.uint64(0x0101010101010101)
_HIGH = np.uint64(0x8080808080808080)
_LOW7 = np.uint64(0x7F7F7F7F7F7F7F7F)
_CASE = np.uint64(0x2020202020202020)
# A byte's high bit comes on when these are added to a lower-case letter's seven bits: from
# "a" on, and from the character after "z" on.
_FROM_A = np.uint64((0x80 - 0x61) * 0x0101010101010101)
_PAST_Z = np.uint64((0x80 - 0x7B) * 0x0101010101010101)
_BYTE, _TOP = np.uint64(8), np.uint64(56)


def _classes(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """High bits of the bytes that are letters, and of those that continue a code point."""
    lower = (words | _CASE) & _LOW7
    letters = (lower + _FROM_A) & ~(lower + _PAST_Z) & ~words & _HIGH
    continued = words & ~(words << np.uint64(1)) & _HIGH
    return letters, continued


def unit_ends(words: np.ndarray, following: int = 0) -> np.ndarray:
    """High bits of the bytes that end a unit; ``following`` is the word after the last.

    A byte ends a unit unless the next byte continues its code point or both are letters.
    """
    letters, continued = _classes(np.append(words, np.uint64(following)))

    def of_next(marks: np.ndarray) -> np.ndarray:
        return (marks[:-1] >> _BYTE) | (marks[1:] << _TOP)

    return _HIGH & ~of_next(continued) & ~(letters[:-1] & of_next(letters))


class Units:
    """Unit ends of one text: how many there are, and the byte after the k-th."""

    def __init__(self, text: bytes) -> None:
        self.size = len(text)
        self.words = np.frombuffer(text + bytes(-len(text) % 8), _WORD)
        counts = np.zeros(len(self.words), np.uint8)
        for start in range(0, len(self.words), BLOCK):
            counts[start : start + BLOCK] = np.bitwise_count(self._marks(start, start + BLOCK))
        self.until = np.cumsum(counts, dtype=np.int64)
        self.count = int(self.until[-1]) if len(counts) else 0

    def _marks(self, start: int, stop: int) -> np.ndarray:
        stop = min(stop, len(self.words))
        marks = unit_ends(self.words[start:stop], self.words[stop] if stop < len(self.words) else 0)
        padding = 8 * len(self.words) - self.size
        if padding and stop == len(self.words):
            marks[-1] &= _HIGH >> np.uint64(8 * padding)
        return marks

    def byte_after(self, k: int) -> int:
        """Length in bytes of the first ``k`` units."""
        if not k:
            return 0
        at = int(np.searchsorted(self.until, k))
        rank = np.uint64(k - (int(self.until[at - 1]) if at else 0))
        # After the multiplication each byte holds the marks up to and with itself.
        running = (self._marks(at, at + 1) >> np.uint64(7)) * _ONES
        reached = ((running | _HIGH) - rank * _ONES) & _HIGH
        return 8 * at + 9 - int(np.bitwise_count(reached)[0])


def draws(key: int | None, seed: int = SEED) -> tuple[int, int, int, int]:
    """Four numbers below 2**32 that depend on the seed and the document only."""
    name = f"{seed}:{'' if key is None else key}"
    digest = hashlib.sha256(name.encode()).digest()
    return tuple(np.frombuffer(digest[:16], ">u4").tolist())


def rearranged(
    text: bytes, key: int | None, seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST
) -> tuple[int, str, tuple[bytes, bytes, bytes]]:
    """Number of units, form, and (prefix, middle, suffix); plain texts are all prefix."""
    units = Units(text)
    first, second, share, order = draws(key, seed)
    if not text or any(m.encode() in text for m in MARKERS) or share % 100 >= rate:
        return units.count, "plain", (text, b"", b"")
    low, high = sorted((first % (units.count + 1), second % (units.count + 1)))
    a, b = units.byte_after(low), units.byte_after(high)
    form = "spm" if order % 100 < suffix_first else "psm"
    return units.count, form, (text[:a], text[a:b], text[b:])


def code_points(data: bytes) -> int:
    """Bytes that do not continue a code point."""
    return int(np.count_nonzero(np.frombuffer(data, np.uint8) & 0xC0 != 0x80))


ROWS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("form", T.StringType()),
        T.StructField("prefix_chars", T.LongType()),
        T.StructField("middle_chars", T.LongType()),
        T.StructField("output", T.BinaryType()),
    ]
)


def fill_in_middle(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = SEED,
    rate: int = RATE,
    suffix_first: int = SUFFIX_FIRST,
) -> DataFrame:
    """One row ``(doc_id, n, form, prefix_chars, middle_chars, output)`` per row of ``docs``.

    ``output`` is the text with its middle last: ``<P>prefix<S>suffix<M>middle`` (psm),
    ``<S>suffix<P>prefix<M>middle`` (spm), or the text itself (plain). Empty and null texts are
    plain and give an empty output, and so are texts that hold a marker, which could not be
    restored. A null id is drawn as an empty string and stays null. The choice depends on id
    and seed alone: reruns agree, equal rows give equal rows. Other columns are not read. An
    empty table gives an empty table. One pass without a shuffle; a task holds one text and
    about as much again at a time.
    """

    def make(rows: Iterable[tuple]) -> Iterator[tuple]:
        markers = [m.encode() for m in MARKERS]
        for key, text in rows:
            n, form, (prefix, middle, suffix) = rearranged(text or b"", key, seed, rate, suffix_first)
            if form == "plain":
                yield key, n, form, None, None, prefix
                continue
            head = (markers[0], prefix, markers[1], suffix)
            output = b"".join((*(head if form == "psm" else head[2:] + head[:2]), markers[2], middle))
            yield key, n, form, code_points(prefix), code_points(middle), output

    texts = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string").cast("binary"))
    made = map_rows(texts, make, ROWS, OUTPUT_ROWS)
    return made.withColumn("output", F.col("output").cast("string"))


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made from. No marker's end is another's beginning, so the
    three markers cut the output at the same places again."""
    parts = F.split(output, "|".join(MARKERS), -1)
    return (
        F.when(form == "plain", output)
        .when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
        .otherwise(F.concat(parts[2], parts[3], parts[1]))
    )


def digests(made: DataFrame) -> DataFrame:
    """The rows with checksums of the output and of the text rebuilt from it, for the texts."""
    sha = [F.sha2(c.cast("binary"), 256) for c in (F.col("output"), restored(F.col("output"), F.col("form")))]
    return made.withColumns({"output_sha256": sha[0], "restored_sha256": sha[1]}).drop("output")


#: The digest columns in DuckDB, by cutting the list of units; for checks, not for speed.
SQL = """
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
         sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents),
drawn AS (
  SELECT *, len(units) AS n,
         ('0x' || h[1:8])::BIGINT % (len(units) + 1) AS c1, ('0x' || h[9:16])::BIGINT % (len(units) + 1) AS c2,
         ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
  FROM cut),
formed AS (
  SELECT *, least(c1, c2) AS a, greatest(c1, c2) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90
              THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn),
parts AS (
  SELECT *, coalesce(array_to_string(units[1:a], ''), '') AS p,
         coalesce(array_to_string(units[a + 1:b], ''), '') AS m,
         coalesce(array_to_string(units[b + 1:n], ''), '') AS s
  FROM formed)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(p)::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""
