"""Packing, sharding, fingerprints and mixing against brute force on small tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from itertools import combinations_with_replacement

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortlens.llm import merkle, mixture, packing, shards
from cohortlens.llm.common import numbered, table
from tests.llm.test_matching import documents

# --- op6 -------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def ids():
    return packing.Ids(packing.default_vocabulary())


FORMS = ["a", "b", "é", " ", "  ", "\n", "\t", " \n", "\n ", "1", "23", "'s", "!", "…", "漢", "\xa0", "<|endoftext|>", "word", "\x1c", "ѐ", "🙂", "\r\n"]


@given(st.lists(st.sampled_from(FORMS), max_size=14))
@settings(max_examples=500, deadline=None)
def test_ids_are_the_tokenizers(ids, parts):
    text = "".join(parts)
    assert ids(text) == ids.exact(text)


def test_ids_of_whole_table(spark, small, ids):
    for row in table(spark, small, "documents").collect():
        assert ids(row["text"]) == ids.exact(row["text"])


def test_ids_with_few_known_forms(ids, monkeypatch):
    monkeypatch.setattr(packing, "KNOWN_FORMS", 0)
    other = packing.Ids(packing.default_vocabulary())
    assert other("some words and some more words") == ids.exact("some words and some more words")


@given(st.integers(0, 9000))
def test_cut(tokens):
    found = list(packing.cut(tokens))
    assert sum(n for _, n in found) == tokens
    assert [s for s, _ in found] == [sum(n for _, n in found[:i]) for i in range(len(found))]
    assert all(n == 2048 for _, n in found[1:])


@given(st.dictionaries(st.integers(1, 20), st.integers(1, 12), max_size=10))
@settings(max_examples=300, deadline=None)
def test_plan_uses_each_piece_once_and_fits(counts):
    found = packing.plan(counts, 20)
    used = Counter()
    for combination, times in found:
        assert sum(combination) <= 20 and times > 0
        for n in combination:
            used[n] += times
    assert used == Counter(counts)


def slow_filling(left, first, size):
    """All combinations tried: fewest pieces first, then the longest ones."""
    others = sorted((n for n in left if left[n] > 0), reverse=True)
    if first == size:
        return (first,)
    for many in (1, 2, 3):
        for more in combinations_with_replacement(others, many):
            used = Counter((first, *more))
            if sum(more) == size - first and all(left[n] >= c for n, c in used.items()):
                return first, *more
    return None


@given(st.dictionaries(st.integers(1, 30), st.integers(1, 3), min_size=1, max_size=12), st.randoms())
@settings(max_examples=200, deadline=None)
def test_sums_find_what_fills_exactly(counts, chance):
    sums, left = packing.Sums(counts, 30), dict(counts)
    while any(left.values()):
        for first in [n for n in left if left[n]]:
            assert sums.filling(first) == slow_filling(left, first, 30)
        gone = chance.choice([n for n in left if left[n]])
        times = chance.randint(1, left[gone])
        sums.take(gone, times)
        left[gone] -= times
        for total in range(31):
            there = [a for a in left if left[a] and left.get(total - a, 0) > (2 * a == total) and 2 * a >= total]
            assert sums.live[total] == len(there)


def test_lengths_that_never_fill_cost_one_look_each(monkeypatch):
    looks, pair = [], packing.Sums.pair
    monkeypatch.setattr(packing.Sums, "pair", lambda self, *given: looks.append(given) or pair(self, *given))
    counts = {n: 3 for n in range(5, 2048, 5)}
    found = packing.plan(counts)
    assert sum(times * len(combination) for combination, times in found) == 3 * len(counts)
    assert len(looks) == len(counts)


@given(st.dictionaries(st.integers(3, 12), st.integers(1, 2), min_size=1, max_size=4))
@settings(max_examples=60, deadline=None)
def test_plan_is_near_the_fewest(counts):
    pieces = sorted(Counter(counts).elements(), reverse=True)
    best = len(pieces)

    def place(at, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if at == len(pieces):
            best = len(bins)
            return
        for i in {b: i for i, b in enumerate(bins)}.values():
            if bins[i] + pieces[at] <= 12:
                place(at + 1, [*bins[:i], bins[i] + pieces[at], *bins[i + 1 :]])
        place(at + 1, [*bins, pieces[at]])

    place(0, [])
    assert sum(times for _, times in packing.plan(counts, 12)) <= best + 1


def check_packing(rows, texts, ids, size):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(texts)
    for key, parts in by_doc.items():
        data = ids.exact(texts[key] or "") + b"\0\0\0\0"
        parts.sort(key=lambda r: r["piece"])
        assert [(r["start"], r["length"]) for r in parts] == list(packing.cut(len(data) // 4, size))
        assert [r["piece"] for r in parts] == list(range(len(parts)))
        for r in parts:
            assert r["ids_crc32"] == zlib.crc32(data[4 * r["start"] : 4 * (r["start"] + r["length"])])
    for parts in by_sequence.values():
        parts.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in parts] == [sum(p["length"] for p in parts[:i]) for i in range(len(parts))]
        assert sum(p["length"] for p in parts) <= size
    return len(by_sequence)


def test_packing_of_whole_table(spark, small, ids):
    docs = table(spark, small, "documents")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = packing.pack(docs).collect()
    sequences = check_packing(rows, texts, ids, 2048)
    assert sequences <= 1.03 * math.ceil(sum(r["length"] for r in rows) / 2048) + 1
    assert sorted(map(tuple, packing.pack(docs).collect())) == sorted(map(tuple, rows))


def test_packing_of_odd_rows(spark, ids):
    texts = [None, "", "a", "word " * 500, "word " * 500]
    rows = packing.pack(documents(spark, texts), size=64).collect()
    check_packing(rows, dict(enumerate(texts)), ids, 64)
    again = packing.pack(documents(spark, ["a", "a", "b"], [3, 3, None])).collect()
    assert Counter(r["doc_id"] for r in again) == Counter([3, 3, None])
    assert packing.pack(documents(spark, [])).count() == 0


def test_numbers_have_no_gaps(spark, monkeypatch):
    monkeypatch.setattr("cohortlens.llm.common.BUCKET_ROWS", 7)
    rows = spark.range(100).selectExpr("if(id < 80, 1, 2) as g", "id")
    found = {}
    for r in numbered(rows, ["g"], ["id"], 100).collect():
        found.setdefault(r["g"], []).append(r["number"])
    assert {g: sorted(n) for g, n in found.items()} == {1: list(range(80)), 2: list(range(20))}


# --- op7 -------------------------------------------------------------------------------


def check_shards(rows, texts):
    assert Counter(r["doc_id"] for r in rows) == Counter(k for k, _ in texts)
    expected = Counter((k, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t in texts)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == expected
    by_shard = {}
    for r in rows:
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < 16
        by_shard.setdefault(r["shard"], []).append(r)
    for found in by_shard.values():
        assert sorted(r["slot"] for r in found) == list(range(len(found)))
    return {s: sum(r["size"] for r in found) for s, found in by_shard.items()}


def test_shards_of_whole_table(spark, small):
    docs = table(spark, small, "documents")
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    sizes = check_shards(shards.shards(docs).collect(), texts)
    longest = max(len(t.encode()) for _, t in texts) + 1
    share = sum(sizes.values()) / 16
    assert all(abs(size - share) <= longest + share / 50 for size in sizes.values())


def test_shards_with_a_hot_text(spark):
    chance = random.Random(1)
    texts = [(i, "same text " * 8 if i % 3 == 0 else "".join(chance.choices("abcdef ", k=chance.randint(0, 160)))) for i in range(6000)]
    sizes = check_shards(shards.shards(documents(spark, [t for _, t in texts])).collect(), texts)
    share = sum(sizes.values()) / 16
    assert len(sizes) == 16 and max(sizes.values()) < 1.05 * share and min(sizes.values()) > 0.95 * share


@pytest.mark.parametrize("key", [None, 7])
@pytest.mark.parametrize("text", [None, "the same text again and again"])
def test_shards_with_a_hot_id_and_text(spark, key, text):
    chance = random.Random(3)
    texts = [(i, "".join(chance.choices("abcdef ", k=chance.randint(0, 20)))) for i in range(10_000)] + [(key, text)] * 10_000
    sizes = check_shards(shards.shards(documents(spark, [t for _, t in texts], [k for k, _ in texts])).collect(), texts)
    share = sum(sizes.values()) / 16
    assert len(sizes) == 16 and max(sizes.values()) < 1.02 * share and min(sizes.values()) > 0.98 * share


def test_shards_of_odd_rows(spark):
    texts = [(None, None), (None, ""), (3, "a"), (3, "a"), (4, "é" * 50_000)]
    check_shards(shards.shards(documents(spark, [t for _, t in texts], [k for k, _ in texts])).collect(), texts)
    assert shards.shards(documents(spark, [])).count() == 0


def test_range_of_is_a_bisection(spark):
    cuts = sorted(random.Random(2).sample(range(-1000, 1000), 37))
    rows = spark.range(-1100, 1100).select("id", shards.range_of(__import__("pyspark").sql.functions.col("id"), cuts).alias("r"))
    assert all(r["r"] == sum(c <= r["id"] for c in cuts) for r in rows.collect())


# --- op8 -------------------------------------------------------------------------------


def digest(text):
    return int.from_bytes(xxhash.xxh64(text.encode(), seed=42).digest(), "big", signed=False) ^ (1 << 63)


def edits(pairs):
    pairs = sorted(pairs, key=lambda p: (p[0] is not None, p[0] or 0, digest(p[1] or "")))
    for i, (key, text) in enumerate(pairs):
        text, following = text or "", pairs[(i + 1) % len(pairs)][1] or ""
        tail = len(text) // 4
        yield key, text, text[: len(text) - tail] + following[:tail], following


def tree(text):
    sections = re.findall(r"(?s)[^\n]*\n|[^\n]+", text)
    return [tuple(re.findall(r"(?s)[^.,;:!?\n]{0,24}[.,;:!?\n]+ ?|[^.,;:!?\n]{1,24}", s)) for s in sections]


def alike(a, b):
    if a == b:
        return 1.0
    a, b = tree(a), tree(b)
    shared = every = 0
    for one, other in ((a, b), (sum(a, ()), sum(b, ()))):
        shared += sum((Counter(one) & Counter(other)).values())
        every += len(one) + len(other)
    return 2 * shared / (every + 2)


def changed(a, b):
    if a == b:
        return None, None
    a, b = sum(tree(a), ()), sum(tree(b), ())
    same = lambda x, y: next((i for i, v in enumerate(x) if i >= len(y) or v != y[i]), len(x))
    start = same(a, b)
    return start, max(start, len(a) - same(a[::-1], b[::-1]))


def check_fingerprints(rows, pairs):
    expected = Counter(
        (k, len(t), hashlib.sha256(e.encode()).hexdigest(), round(alike(t, e), 9), round(alike(t, n), 9), *changed(t, e))
        for k, t, e, n in edits(pairs)
    )
    found = Counter(
        (r["doc_id"], r["n_chars"], r["edited_sha256"], round(r["near_edited"], 9), round(r["near_next"], 9), r["changed_from"], r["changed_to"])
        for r in rows
    )
    assert found == expected
    for r in rows:
        assert (r["fingerprint"] == r["edited_fingerprint"]) == (r["first_changed"] is None) == (r["near_edited"] == 1)


@pytest.mark.parametrize("size", [20_000, 16 << 20])
def test_fingerprints_of_whole_table(spark, small, monkeypatch, size):
    monkeypatch.setattr(merkle, "RANGE_BYTES", size)
    docs = table(spark, small, "documents")
    pairs = [(r["doc_id"], r["text"]) for r in docs.collect()]
    made = merkle.fingerprints(docs).cache()
    rows = made.collect()
    check_fingerprints(rows, pairs)
    roots = {}
    texts = dict(pairs)
    for r in rows:
        assert roots.setdefault(texts[r["doc_id"]], r["fingerprint"]) == r["fingerprint"]
    assert len(set(roots.values())) == len(roots)
    # What two stored fingerprints say is what the texts' trees say.
    one, other = F.col("fingerprint"), F.col("edited_fingerprint")
    same = merkle.root_of(one) == merkle.root_of(other)
    stored = made.select("near_edited", merkle.likeness(merkle.tree_of(one), merkle.tree_of(other), same).alias("again"))
    assert stored.filter("near_edited <> again").count() == 0
    made.unpersist()


def test_fingerprints_of_odd_rows(spark):
    pairs = [(None, None), (5, ""), (2, "One, two.\nthree"), (2, "One, two.\nthree"), (9, "x" * 100_000), (11, "é. ü? \n\n"), (12, "abc")]
    check_fingerprints(merkle.fingerprints(documents(spark, [t for _, t in pairs], [k for k, _ in pairs])).collect(), pairs)
    one = merkle.fingerprints(documents(spark, ["abcdefgh"])).first()
    assert one["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest() and one["near_next"] == 1
    assert merkle.fingerprints(documents(spark, [])).count() == 0


def test_fingerprints_of_repeats_and_order(spark):
    pairs = [(1, "aa, bb.\naa, bb.\n"), (2, "aa, bb.\n"), (3, "bb.aa, \n"), (4, "one two three four five six seven"), (5, "b\na\n"), (6, "a\nb\n")]
    rows = merkle.fingerprints(documents(spark, [t for _, t in pairs], [k for k, _ in pairs])).collect()
    check_fingerprints(rows, pairs)
    near = {r["doc_id"]: r["near_next"] for r in rows}
    assert 0 < near[1] < 1 and near[2] < 1 and 0.5 < near[5] < 1
    assert {r["doc_id"]: r["near_edited"] for r in rows}[4] > 0


def test_fingerprints_with_hot_ids(spark, monkeypatch):
    monkeypatch.setattr(merkle, "RANGE_BYTES", 2_000)
    chance = random.Random(4)
    pairs = [(None if i % 3 == 0 else 40 if i % 3 == 1 else chance.randint(0, 80), chance.choice(["", None, "same, text.", f"text {i}, {i % 7}.\nend"])) for i in range(900)]
    docs = documents(spark, [t for _, t in pairs], [k for k, _ in pairs])
    check_fingerprints(merkle.fingerprints(docs).collect(), pairs)


# --- op10 ------------------------------------------------------------------------------


def test_targets_by_hand():
    assert mixture.targets([("a", 100), ("b", 100), (None, 100)]) == {"a": 200.0, "b": pytest.approx(250 / 3), None: pytest.approx(500 / 3)}
    assert mixture.targets([]) == {}
    assert mixture.targets([("a", 0), ("b", 10)]) == {"a": 0.0, "b": 15.0}


@given(st.lists(st.tuples(st.integers(1, 12), st.integers(0, 4)), min_size=1, max_size=6, unique_by=lambda x: x[0]), st.integers(0, 60))
@settings(max_examples=200, deadline=None)
def test_knapsack_is_the_best(items, budget):
    lengths, counts = (np.array(x, np.int64) for x in zip(*items, strict=True))
    chosen = mixture.knapsack(lengths, counts, budget)
    assert (chosen >= 0).all() and (chosen <= counts).all()
    reach = {0}
    for n, c in items:
        reach = {r + n * k for r in reach for k in range(c + 1)}
    assert int((chosen * lengths).sum()) == min(reach, key=lambda r: (abs(r - budget), r))


@given(st.lists(st.tuples(st.integers(0, 3000), st.integers(1, 50)), min_size=1, max_size=30, unique_by=lambda x: x[0]), st.floats(0, 1.2))
@settings(max_examples=60, deadline=None)
def test_fit_is_near(items, part):
    lengths, counts = (np.array(x, np.int64) for x in zip(*items, strict=True))
    total = int((lengths * counts).sum())
    budget = int(part * total)
    chosen = mixture.fit(lengths, counts, budget)
    assert (chosen >= 0).all() and (chosen <= counts).all()
    wanted = min(budget, total)
    assert abs(int((chosen * lengths).sum()) - wanted) <= max(lengths)


def check_mixture(rows, docs):
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert Counter(r["doc_id"] for r in rows) == Counter(k for k, _, _ in docs)
    sums = Counter()
    for _, source, text in docs:
        sums[source] += words(text)
    goal = mixture.targets(list(sums.items()))
    taken, least = Counter(), {}
    for r in rows:
        assert r["source_size"] == sums[r["source"]] and r["target"] == pytest.approx(goal[r["source"]])
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 2
        taken[r["source"]] += r["taken"]
        least[r["source"]] = min(least.get(r["source"], math.inf), r["size"] or math.inf)
    assert Counter((r["doc_id"], r["size"]) for r in rows) == Counter((k, words(t)) for k, _, t in docs)
    return [(goal[s], taken[s], least[s]) for s in sums]


def test_mixture_of_whole_table(spark, small):
    docs = table(spark, small, "documents")
    found = mixture.mixture(docs)
    rows = found.collect()
    for goal, taken, _ in check_mixture(rows, [(r["doc_id"], r["source"], r["text"]) for r in docs.collect()]):
        assert abs(goal - taken) <= 0.01 * goal + 20
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mixture.mixture(docs.repartition(5)).collect()))


def test_mixture_with_a_hot_source_and_length(spark, monkeypatch):
    monkeypatch.setattr("cohortlens.llm.common.BUCKET_ROWS", 20)
    rows = [(i, "a b c d" if i % 3 else "word " * (i % 40), "hot" if i % 3 else ["x", "y", None, ""][i % 4]) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixture.mixture(docs).collect()
    for goal, taken, least in check_mixture(found, [(k, s, t) for k, t, s in rows]):
        assert abs(goal - taken) < least + 1
    copies = Counter({r["doc_id"]: r["copies"] for r in found})
    mixed = mixture.mixed(docs)
    assert mixed.columns == docs.columns
    assert Counter(r["doc_id"] for r in mixed.collect()) == +copies


def test_mixture_of_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, None), (1, "a b", None), (1, "c d", None), (None, "x y z", "s"), (7, "", "s")], "doc_id long, text string, source string"
    )
    found = mixture.mixture(docs).collect()
    check_mixture(found, [(r["doc_id"], r["source"], r["text"]) for r in docs.collect()])
    assert mixture.mixed(docs).count() == sum(r["copies"] for r in found)
    empty = spark.createDataFrame([], docs.schema)
    assert mixture.mixture(empty).count() == 0 and mixture.mixed(empty).columns == docs.columns
