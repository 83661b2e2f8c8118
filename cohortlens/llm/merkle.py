"""Merkle fingerprints of documents, and how alike a text is to an edit of it.

A text's sections are its lines, and a section's paragraphs are its stretches up to a
punctuation mark, at most 24 characters long, so that a change moves no boundary beyond the
next mark. Leaves hash paragraphs, inner nodes hash the leaves of a section, and the root
hashes the sections. Equal roots mean equal texts; where roots differ, the differing sections
and leaves say where. A fingerprint holds the root and the tree, so that two stored ones can be
compared without their texts. DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Callable
from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.shards import range_of
from cohortlens.sources.scratch import written

SECTION = r"(?s)[^\n]*\n|[^\n]+"
PARAGRAPH = r"(?s)[^.,;:!?\n]{0,24}[.,;:!?\n]+ ?|[^.,;:!?\n]{1,24}"
#: Text in one range of the id order, about; ranges are neighbours' lookup units.
RANGE_BYTES = 16 << 20
#: What a row counts for beside its text.
ROW_BYTES = 64
_FIRST = -(1 << 63)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, also where ``use`` needs it in a lambda."""
    return F.get(F.transform(F.array(value), use), 0)


def leaves(text: Column) -> Column:
    """Leaf hashes of a text, by section."""
    sections = F.regexp_extract_all(text, F.lit(SECTION), F.lit(0))
    paragraphs = lambda s: F.regexp_extract_all(s, F.lit(PARAGRAPH), F.lit(0))
    return F.transform(sections, lambda s: F.transform(paragraphs(s), lambda p: F.xxhash64(p)))


def nodes(tree: Column) -> Column:
    """Hashes of the sections."""
    return F.transform(tree, lambda section: F.xxhash64(section))


def root(tree: Column) -> Column:
    return F.sha2(F.array_join(F.transform(nodes(tree), lambda n: n.cast("string")), ","), 256)


def short(tree: Column) -> Column:
    """The tree with the upper 32 bits of each leaf, as a fingerprint holds it."""
    return F.transform(tree, lambda section: F.transform(section, lambda leaf: F.shiftrightunsigned(leaf, 32)))


def fingerprint(root: Column, tree: Column) -> Column:
    """The root, and after a slash for each section its leaves, eight hex digits each."""
    digits = lambda leaf: F.lpad(F.lower(F.hex(leaf)), 8, "0")
    sections = F.transform(tree, lambda section: F.array_join(F.transform(section, digits), ""))
    return F.array_join(F.concat(F.array(root), sections), "/")


def tree_of(fingerprint: Column) -> Column:
    """The tree that a fingerprint holds, as :func:`short` gives it."""
    sections = F.regexp_extract_all(fingerprint, F.lit("/([0-9a-f]+)"), F.lit(1))
    digits = lambda s: F.regexp_extract_all(s, F.lit("[0-9a-f]{8}"), F.lit(0))
    return F.transform(sections, lambda s: F.transform(digits(s), lambda d: F.conv(d, 16, 10).cast("long")))


def root_of(fingerprint: Column) -> Column:
    return F.substring(fingerprint, 1, 64)


def counted(values: Column) -> Column:
    """Hashes of the values with the number of the repeat, so that sets of them are multisets."""

    def runs(s: Column) -> Column:
        places = F.transform(s, lambda _, i: i)
        starts = F.filter(places, lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))

        def spread(begin: Column) -> Column:
            length = lambda i, j: F.coalesce(F.get(begin, j + 1), F.size(s)) - i
            repeats = lambda i, j: F.transform(
                F.sequence(F.lit(0), length(i, j) - 1), lambda k: F.xxhash64(F.get(s, i), k)
            )
            return F.flatten(F.transform(begin, repeats))

        return bound(starts, spread)

    return bound(F.sort_array(values), runs)


def likeness(one: Column, other: Column, same: Column) -> Column:
    """Twice the shared nodes over all nodes of both trees, from root to leaves.

    1 if ``same``, that is, if the roots are equal, and below 1 otherwise. Leaves and sections
    are counted as often as both trees hold them; leaves in another order cost their section
    and the root, sections in another order the root.
    """
    pairs = [(F.flatten(one), F.flatten(other)), (nodes(one), nodes(other))]
    shared = sum(F.size(F.array_intersect(counted(a), counted(b))) for a, b in pairs)
    every = sum(F.size(a) + F.size(b) for a, b in pairs) + 2
    return F.when(same, F.lit(1.0)).otherwise(2.0 * shared / every)


def first_difference(one: Column, other: Column) -> Column:
    """Place of the first element of ``one`` that differs from ``other``'s; its size if none does."""

    def first(a: Column, b: Column) -> Column:
        differing = F.filter(F.transform(a, lambda _, i: i), lambda i: ~F.get(a, i).eqNullSafe(F.get(b, i)))
        return F.coalesce(F.array_min(differing), F.size(a))

    return bound(one, lambda a: bound(other, lambda b: first(a, b)))


def with_next(docs: DataFrame) -> DataFrame:
    """Adds ``next_text`` to rows ``(at, digest, text, ...)``: the text of the next row by ``at``
    and ``digest``, after the last row that of the first. ``digest`` is the text's hash.

    Rows are dealt into ranges of about ``RANGE_BYTES``, cut by ``at`` in two steps of about
    equal numbers, and by ``digest`` where one ``at`` alone fills several. The first row of
    each range is also sent to the range before it, so each range finds its rows' successors by
    itself; texts are shuffled once. The driver gets the cuts of the first step, as many as the
    square root of the ranges; the others are one number for each range and stay in Spark.
    """
    weight = (F.octet_length("text") + ROW_BYTES).cast("long")
    total = docs.agg(F.sum(weight)).first()[0] or 0
    steps = isqrt(total // RANGE_BYTES) + 1
    shares = [i / steps for i in range(1, steps)]
    quantiles = lambda: F.percentile_approx("at", shares, 100 * steps)
    cuts = sorted(set(docs.agg(quantiles()).first()[0] or [])) if shares else []
    dealt = docs.withColumn("part", range_of(F.col("at"), cuts))
    if shares:
        # An id found at several cuts fills ranges alone: its end is a cut too.
        inner = dealt.groupBy("part").agg(quantiles().alias("found"))
        ends = F.filter("found", lambda v: F.size(F.filter("found", lambda w: w == v)) > 1)
        ends = F.transform(ends, lambda v: F.when(v < (1 << 63) - 1, v + 1).otherwise(v))
        inner = written(inner.select("part", F.array_distinct(F.concat("found", ends)).alias("cuts")), "cuts")
        dealt = dealt.join(F.broadcast(inner), "part")
        dealt = dealt.withColumn("range", F.size(F.filter("cuts", lambda v: v <= F.col("at")))).drop("cuts")
    else:
        dealt = dealt.withColumn("range", F.lit(0))
    sizes = dealt.groupBy("part", "range").agg(F.sum(weight).alias("b"), F.min("at").alias("l"), F.max("at").alias("h"))
    hot = sizes.filter((F.col("l") == F.col("h")) & (F.col("b") > 2 * RANGE_BYTES))
    hot = written(hot.select("part", "range", F.ceil(F.col("b") / RANGE_BYTES).alias("pieces")), "hot-ids")
    height = F.col("digest") / float(1 << 64) + 0.5
    piece = F.least(F.floor(height * F.col("pieces")), F.col("pieces") - 1).cast("int")
    dealt = dealt.join(F.broadcast(hot), ["part", "range"], "left")
    dealt = dealt.withColumn("piece", F.coalesce(piece, F.lit(0))).drop("pieces")

    firsts = dealt.groupBy("part", "range", "piece").agg(F.min(F.struct("at", "digest")).alias("first"))
    order = "order by part, range, piece"
    place = "struct(part, range, piece)"
    before = F.expr(f"coalesce(lag({place}) over ({order}), first({place}) over (order by part desc, range desc, piece desc))")
    firsts = written(firsts.select("first.at", "first.digest", before.alias("to")), "firsts")
    # Rows equal in both are equal, and one of them is sent.
    sent = docs.join(firsts, ["at", "digest"]).groupBy("at", "digest", "to").agg(F.min("text").alias("text"))
    sent = sent.select("at", "digest", "text", "to.*", F.lit(1).alias("extra"))
    rows = dealt.withColumn("extra", F.lit(0)).unionByName(sent, allowMissingColumns=True)
    following = F.expr("lead(text) over (partition by part, range, piece order by extra, at, digest)")
    return rows.withColumn("next_text", following).filter("extra = 0").select(*docs.columns, "next_text")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: fingerprints of its text and of its edited text.

    The edited text is the text with its last ``floor(n_chars / 4)`` code points replaced by as
    many from the start of the next document (or all it has), by ascending id; after the last
    comes the first. A null text is empty; a null id comes first; rows with equal ids are
    ordered by the hash of their texts. A single document is its own next one. ``first_changed``
    is the number of the first section the edit changed, ``changed_from`` and ``changed_to``
    bound the text's leaves that it changed (half open, counted over all sections); null if
    nothing did. Other columns are not read; an empty table gives an empty table. Texts are
    shuffled once.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(_FIRST)).alias("at"),
        F.xxhash64(text).alias("digest"),
        text.alias("text"),
    )
    paired = with_next(rows).withColumn("n_chars", F.length("text").cast("long"))
    tail = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(
        F.substr("text", F.lit(1), F.col("n_chars").cast("int") - tail), F.substr("next_text", F.lit(1), tail)
    )
    made = paired.select("doc_id", "n_chars", "text", "next_text", edited.alias("edited"))
    trees = {"tree": "text", "edited_tree": "edited", "next_tree": "next_text"}
    digest = F.sha2("edited", 256).alias("edited_sha256")
    made = made.select("doc_id", "n_chars", digest, *(leaves(F.col(c)).alias(t) for t, c in trees.items()))
    made = made.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        *(root(F.col(t)).alias(f"{t}_root") for t in trees),
        *(short(F.col(t)).alias(t) for t in trees),
    )
    unchanged = F.col("tree_root") == F.col("edited_tree_root")
    flat, changed = F.flatten("tree"), F.flatten("edited_tree")
    start = first_difference(flat, changed)
    end = F.size(flat) - first_difference(F.reverse(flat), F.reverse(changed))
    return made.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprint(F.col("tree_root"), F.col("tree")).alias("fingerprint"),
        fingerprint(F.col("edited_tree_root"), F.col("edited_tree")).alias("edited_fingerprint"),
        likeness(F.col("tree"), F.col("edited_tree"), unchanged).alias("near_edited"),
        likeness(F.col("tree"), F.col("next_tree"), F.col("tree_root") == F.col("next_tree_root")).alias("near_next"),
        F.when(~unchanged, first_difference(nodes(F.col("tree")), nodes(F.col("edited_tree")))).alias("first_changed"),
        F.when(~unchanged, start).alias("changed_from"),
        F.when(~unchanged, F.greatest(start, end)).alias("changed_to"),
    )
