"""Licence scan, SimHash groups and shared passages against brute force on small tables."""

import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortlens.llm import licenses, simhash, suffixes
from cohortlens.llm.common import components, table

DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp string, id int, gone int"
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def documents(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en", None, None if t is None else len(t), "x", 1, 2) for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, DOCS)


def lower_ascii(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# --- op1 -------------------------------------------------------------------------------


def slow_scan(text):
    words = WORDS.findall(lower_ascii(text))
    places = [
        (i, label)
        for phrase, label in licenses.BASE.items()
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


NOTES = ["MIT", "License", "gnu", "General", "public", "Apache", "cc", "by", "nc", "é", "\x00", "-", " ", "\n", "x", "SPDX", "licence"]


@given(st.lists(st.sampled_from(NOTES), max_size=60))
@settings(max_examples=300, deadline=None)
def test_scan_is_brute_force(parts):
    text = " ".join(parts)
    assert licenses.scan(text)[:5] == slow_scan(text)


def test_scan_of_whole_table(spark, small):
    docs = table(spark, small, "documents")
    found = {r["doc_id"]: tuple(r)[1:6] for r in licenses.license_scan(docs).collect()}
    assert found == {r["doc_id"]: slow_scan(r["text"]) for r in docs.collect()}


def test_scan_edges(spark):
    long = "x " * 200_000 + "MIT license mit license"
    rows = licenses.license_scan(documents(spark, [None, "", "CC-BY 4.0", long, long])).orderBy("doc_id").collect()
    assert [r["n_words"] for r in rows] == [0, 0, 4, 200_004, 200_004]
    assert [r["n_base"] for r in rows] == [0, 0, 1, 2, 2]
    assert rows[3]["first_word"] == 200_000 and rows[3]["last_word"] == 200_002
    assert rows[0]["score"] == 0 and 0 < rows[2]["score"] <= 1
    assert licenses.license_scan(documents(spark, [])).count() == 0


@pytest.mark.parametrize(
    ("expression", "ordered", "labels", "freedom"),
    [
        ("MIT", ["MIT"], {"mit"}, 1.0),
        ("MIT OR GPL-2.0-only AND BSD-3-Clause", ["MIT", "GPL-2.0-only", "BSD-3-Clause", "and", "or"], {"mit", "gpl", "bsd"}, 1.0),
        ("(MIT OR GPL-2.0) AND GPL-3.0", ["MIT", "GPL-2.0", "or", "GPL-3.0", "and"], {"mit", "gpl"}, 0.4),
        ("GPL-2.0 WITH Classpath-exception-2.0 */ rest", ["GPL-2.0", "Classpath-exception-2.0", "with"], {"gpl"}, 0.6),
        ("MIT OR", ["MIT"], {"mit"}, 1.0),
        ("((MIT", ["MIT"], {"mit"}, 1.0),
        (")", [], set(), None),
        ("", [], set(), None),
    ],
)
def test_expressions(expression, ordered, labels, freedom):
    assert licenses.postfix(expression) == ordered
    found, value = licenses.evaluate(ordered)
    assert found == labels and (value is None if freedom is None else value == pytest.approx(freedom))


def test_tag_adds_labels_and_keeps_base():
    found = licenses.scan("# SPDX-License-Identifier: (Apache-2.0 OR BSD-2-Clause)\nUnder the MIT License.")
    assert found[4] == "mit" and found[5] == "apache,bsd,mit"
    assert found[7] == ["Apache-2.0 BSD-2-Clause or"]


# --- op2 -------------------------------------------------------------------------------


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower_ascii(text))
    if not words:
        return 0
    parts = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@given(st.text(st.sampled_from("aB é\n\tÉ \x0b\xa0"), max_size=40))
@settings(max_examples=200, deadline=None)
def test_fingerprint_is_brute_force(text):
    assert simhash.fingerprint(text) == slow_fingerprint(text)


def slow_components(values, distance=2):
    group = list(range(len(values)))
    for i, j in combinations(range(len(values)), 2):
        if (values[i] ^ values[j]).bit_count() <= distance and group[i] != group[j]:
            old = group[j]
            group = [group[i] if g == old else g for g in group]
    return group


def partition_of(labels):
    first = {}
    return [first.setdefault(x, len(first)) for x in labels]


@given(st.lists(st.lists(st.integers(0, 63), max_size=5), min_size=2, max_size=40), st.integers(0, 3))
@settings(max_examples=150, deadline=None)
def test_trie_edges_connect_what_is_near(flips, seed):
    base = random.Random(seed).getrandbits(64)
    values = sorted({base ^ sum({1 << b for b in f}) for f in flips})
    found = list(simhash.trie_edges(np.array(values, np.uint64), 2))
    group = {v: v for v in values}
    for a, b in found:
        old, new = group[b], group[a]
        group = {v: new if g == old else g for v, g in group.items()}
    assert partition_of([group[v] for v in values]) == partition_of(slow_components(values))


def test_trie_walks_large_groups():
    chance = random.Random(4)
    values = sorted({(1 << 60) ^ sum(1 << b for b in chance.sample(range(16), 3)) for _ in range(900)} | {chance.getrandbits(64) for _ in range(900)})
    found = list(simhash.trie_edges(np.array(values, np.uint64), 2))
    groups = slow_components(values)
    assert len(found) == len(values) - len(set(groups))
    place = {v: i for i, v in enumerate(values)}
    assert all(groups[place[a]] == groups[place[b]] for a, b in found)


def test_trie_prunes_real_fingerprints(spark, small, monkeypatch):
    rows = table(spark, small, "documents").select("text").collect()
    real = {simhash.fingerprint(r["text"]) for r in rows}
    values = np.array(sorted(real | {v ^ (1 << v % 64) ^ (1 << v % 61) for v in real if v % 8 == 0}), np.uint64)
    walked, down = [], simhash._descend

    def counted(*given):
        walked.append(len(given[1]))
        return down(*given)

    monkeypatch.setattr(simhash, "_descend", counted)
    i, j = simhash.trie_links(values, np.array([0]), np.array([len(values)]), 2)
    near = {
        (a, b) for a in range(len(values)) for b in range(a) if (int(values[a]) ^ int(values[b])).bit_count() <= 2
    }
    assert near and {(max(p), min(p)) for p in zip(i.tolist(), j.tolist(), strict=True)} == near and len(i) == len(near)
    # One root; under a quarter of all pairs of values live to any one depth; few reach the last.
    assert walked[0] == 1 and max(walked) < len(values) * (len(values) - 1) / 8 and walked[-1] < 2 * len(near) + 2


def test_groups_walked_together_stay_apart():
    chance = random.Random(7)
    groups = [sorted({sum(1 << b for b in chance.sample(range(64), 2)) for _ in range(n)}) for n in (1, 2, 40, 3, 1, 25)]
    rows = [(0, k, simhash.signed(v)) for k, group in enumerate(groups) for v in sorted(group, key=simhash.signed)]
    edges = simhash._edges(np.array(rows, np.int64).T, 2).to_pydict()
    expected = set()
    for group in groups:
        firsts = slow_components(group)
        lowest = {}
        for v, first in zip(group, firsts, strict=True):
            lowest.setdefault(first, v)
            if lowest[first] != v:
                expected.add((simhash.signed(lowest[first]), simhash.signed(v)))
    assert set(zip(edges["a"], edges["b"], strict=True)) == expected


def test_groups_of_whole_table(spark, small):
    docs = table(spark, small, "documents")
    rows = sorted(docs.select("doc_id", "text").collect())
    values = [slow_fingerprint(r["text"]) for r in rows]
    groups = slow_components(values)
    smallest = {}
    for row, group in zip(rows, groups, strict=True):
        smallest.setdefault(group, row["doc_id"])
    expected = {(r["doc_id"], format(v, "016x"), smallest[g]) for r, v, g in zip(rows, values, groups, strict=True)}
    assert {tuple(r) for r in simhash.near_duplicates(docs).collect()} == expected


def test_large_groups_are_divided(spark, monkeypatch):
    monkeypatch.setattr(simhash, "GROUP", 5)
    chance = random.Random(9)
    values = sorted({sum(1 << b for b in chance.sample(range(64), 2)) for _ in range(150)} | {chance.getrandbits(64) for _ in range(50)})
    edges = simhash.links(spark.createDataFrame([(simhash.signed(v),) for v in values], "fp long"))
    roots = {r["node"]: r["root"] for r in components(edges).collect()}
    found = [roots.get(simhash.signed(v), simhash.signed(v)) for v in values]
    assert partition_of(found) == partition_of(slow_components(values))


def test_groups_of_odd_rows(spark):
    texts = [None, "", " \t", "a b c d", "a b c d", "A B c d", "one", None]
    found = {(r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(documents(spark, texts)).collect()}
    assert found == {(0, 0), (1, 0), (2, 0), (7, 0), (3, 3), (4, 3), (5, 3), (6, 6)}
    assert simhash.near_duplicates(documents(spark, [])).count() == 0
    empty = simhash.keep_one(documents(spark, []))
    assert empty.count() == 0 and empty.columns == documents(spark, []).columns


def test_one_of_each_group_stays(spark):
    texts = ["a b c", "a b c", "a b c", "d e f", "d e f", "g", None, ""]
    kept = simhash.keep_one(documents(spark, texts, [5, 2, 2, 2, 7, None, None, 9]))
    rows = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"]) for r in kept.collect())
    assert rows == [(False, 2, "a b c"), (False, 2, "d e f"), (False, 9, ""), (True, 0, "g")]


def test_components_of_chains(spark):
    edges = [(i + 1, i) for i in range(1, 60)] + [(100, 101), (-5, 101), (200, 200)]
    roots = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert roots == {i: 1 for i in range(1, 61)} | {-5: -5, 100: -5, 101: -5}


# --- op9 -------------------------------------------------------------------------------


def slow_shared(docs, size=50):
    """Covered words per document, and those an earlier document holds."""
    windows = {}
    words = {key: (text or "").encode().split() for key, text in docs}
    for key, ws in words.items():
        for i in range(len(ws) - size + 1):
            windows.setdefault(tuple(ws[i : i + size]), set()).add(key)
    shared, known = {}, {}
    for key, ws in words.items():
        for i in range(len(ws) - size + 1):
            owners = windows[tuple(ws[i : i + size])]
            if len(owners) > 1:
                shared.setdefault(key, set()).update(range(i, i + size))
                if min(owners) < key:
                    known.setdefault(key, set()).update(range(i, i + size))
    return shared, known


def found_shared(rows):
    shared, held = {}, {}
    for r in rows:
        shared.setdefault(r["doc_id"], set()).update(range(r["start_word"], r["start_word"] + r["n_words"]))
        held[r["doc_id"]] = held.get(r["doc_id"], 0) + r["known_words"]
    return shared, {k: v for k, v in held.items() if v}


def passages_table(seed, count=60):
    chance = random.Random(seed)
    word = lambda: chance.choice("abcdefghij") * chance.randint(1, 3) + str(chance.randint(0, 60))
    pool = [[word() for _ in range(n)] for n in (49, 50, 51, 64, 90, 200)]
    texts = []
    for _ in range(count):
        parts = []
        for _ in range(chance.randint(0, 4)):
            parts += [word() for _ in range(chance.randint(0, 30))]
            if chance.random() < 0.7:
                passage = list(chance.choice(pool))
                if chance.random() < 0.4:
                    passage[chance.randrange(len(passage))] = word()
                parts += passage
        texts.append(" ".join(parts))
    return texts + [texts[0], "w " * 120, "w " * 90, "", "short text"]


@pytest.mark.parametrize(("seed", "group"), [(1, 4096), (2, 4096), (3, 3)])
def test_shared_passages_are_brute_force(spark, monkeypatch, seed, group):
    monkeypatch.setattr(suffixes, "GROUP", group)  # 3: nearly all cores are compared by the aggregate
    texts = passages_table(seed)
    shared, known = slow_shared(list(enumerate(texts)))
    rows = suffixes.repeats(documents(spark, texts)).collect()
    assert found_shared(rows) == (shared, {k: len(v) for k, v in known.items()})
    assert all(r["first_doc_id"] <= r["doc_id"] for r in rows)


def test_shared_passages_of_whole_table(spark, small):
    docs = table(spark, small, "documents")
    shared, known = slow_shared([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert found_shared(suffixes.repeats(docs).collect()) == (shared, {k: len(v) for k, v in known.items()})


def test_cut_leaves_what_is_new(spark):
    texts = passages_table(5)
    _, known = slow_shared(list(enumerate(texts)))
    docs = documents(spark, [*texts, None])
    rows = {r["doc_id"]: r for r in suffixes.without_repeats(docs).collect()}
    assert len(rows) == len(texts) + 1 and rows[len(texts)]["text"] is None
    for i, text in enumerate(texts):
        gone = known.get(i, set())
        assert rows[i]["text"].split() == [w for k, w in enumerate(text.split()) if k not in gone]
        assert rows[i]["text"] == text or rows[i]["n_chars"] == len(rows[i]["text"])
        assert gone or rows[i]["text"] == text


def test_passages_of_odd_rows(spark):
    shared = " ".join(f"w{i}" for i in range(60))
    docs = documents(spark, [shared, shared, shared + " x", None, ""], [4, 4, None, 8, 9])
    rows = {(r["doc_id"], r["first_doc_id"], r["start_word"], r["n_words"], r["known_words"]) for r in suffixes.repeats(docs).collect()}
    assert rows == {(None, None, 0, 60, 0), (4, None, 0, 60, 60)}
    assert suffixes.repeats(documents(spark, [])).count() == 0
    assert suffixes.without_repeats(documents(spark, [])).columns == docs.columns


def test_texts_without_id_are_told_apart(spark):
    """Two texts without an id whose 32-bit hashes agree, and a document that holds one of them."""
    from pyspark.sql import functions as F

    body = " ".join(f"word{i}" for i in range(119))
    texts = spark.range(400_000).select(F.concat_ws(" ", F.lit(body), F.col("id").cast("string")).alias("text"))
    same = texts.groupBy(F.hash("text")).agg(F.min("text").alias("a"), F.max("text").alias("b")).filter("a <> b").first()
    pair = documents(spark, [same["a"], same["b"], "start " + same["a"].split(" ", 1)[1]], [None, None, 5])
    found = {(r["doc_id"], r["start_word"], r["n_words"]) for r in suffixes.repeats(pair).collect()}
    assert (5, 1, 119) in found
    kept = [r["text"] for r in suffixes.without_repeats(pair).orderBy("doc_id", "text").collect()]
    assert kept == [*sorted([same["a"], same["b"]]), "start "]
