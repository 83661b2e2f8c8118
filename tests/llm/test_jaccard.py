"""The Jaccard join against all pairs, and the tree against its bound."""

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortlens.llm import jaccard
from cohortlens.llm.common import table
from tests.compare import differences

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_set(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def slow_classes(rows):
    """Rows ``(doc_id, n_shingles, component_id)`` by comparing all pairs."""
    sets = [slow_set(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                one, other = group[i], group[j]
                group = [other if g == one else g for g in group]
    out = []
    for i, (key, _) in enumerate(rows):
        ids = [k for (k, _), g in zip(rows, group, strict=True) if g == group[i] and k is not None]
        out.append((key, len(sets[i]), min(ids, default=None)))
    return sorted(out, key=str)


def found_classes(spark, rows, parts=3):
    docs = spark.createDataFrame([(k, t, 1, "x") for k, t in rows], "doc_id long, text string, row int, n string").repartition(parts)
    return sorted(map(tuple, jaccard.classes(docs).collect()), key=str)


@given(st.text("aB \t\n\x0b\x1c\xa0é", max_size=60))
@settings(max_examples=300, deadline=None)
def test_set_sizes(text):
    assert len(jaccard.shingles(text.encode())) == len(slow_set(text))


@given(st.integers(0, 2**32 - 1), st.integers(1, 150), st.booleans())
@settings(max_examples=60, deadline=None)
def test_tree_loses_no_pair(seed, count, two):
    draw = np.random.default_rng(seed)
    centres = draw.poisson(3, (4, jaccard.GROUPS))
    points = (centres[draw.integers(0, 4, count)] + draw.integers(0, 2, (count, jaccard.GROUPS))).astype(np.uint8)
    sizes, labels = points.sum(axis=1).astype(np.int64), draw.integers(0, 40, count)
    half = count // 2 if two and count > 1 else count
    one = jaccard.Side(points[:half], sizes[:half], labels[:half])
    other = jaccard.Side(points[half:], sizes[half:], labels[half:]) if half < count else one
    expected = set()
    for i in range(half):
        for j in range(half, count) if half < count else range(i + 1, half):
            if 180 * int(np.minimum(points[i], points[j]).sum()) >= 80 * int(sizes[i] + sizes[j]) and labels[i] != labels[j]:
                expected.add((i, j - half if half < count else j))
    p, q = jaccard.surviving(one, other)
    pairs = list(zip(p.tolist(), q.tolist(), strict=True))
    if one is other:
        pairs = [(min(x), max(x)) for x in pairs]
    assert len(pairs) == len(set(pairs)) and set(pairs) == expected


def test_tree_prunes():
    """Groups of near-equal points of like size: the tree looks at few of the pairs of leaves."""
    draw = np.random.default_rng(1)
    centres = draw.poisson(draw.uniform(0.5, 6, (64, 1)), (64, jaccard.GROUPS))
    points = np.repeat(centres, 32, axis=0) + (draw.random((64 * 32, jaccard.GROUPS)) < 0.01)
    points = points.astype(np.uint8)
    side = jaccard.Side(points, points.sum(axis=1).astype(np.int64), np.arange(len(points)))
    visits = []
    p, _ = jaccard.surviving(side, side, visits=visits)
    leaves = int((side.tree.child < 0).sum())
    assert len(p) >= 64 * 32 * 31 // 2
    assert sum(visits) < leaves * (leaves + 1) // 2 / 3


def texts(seed=5):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [" ".join(draw.choices(vocabulary, k=k)) for k in (3, 7, 40, 41, 120, 120, 300, 700)]
    passage = " ".join(draw.choices(vocabulary, k=60))
    out = [None, "", " \n\t", "one", "ONE", "one two three four", "a b c d e", "a b c d e f", "A b c d E"]
    for text in base:
        words = text.split()
        for _ in range(9):
            changed = list(words)
            for _ in range(draw.choice([0, 1, 1, 2, 5])):
                changed[draw.randrange(len(changed))] = draw.choice(vocabulary)
            out.append(" ".join(changed))
        out += [text, text.upper(), text + " " + passage, passage + "\n" + text]
    return out


@pytest.mark.parametrize(("large", "tile"), [(8, 512), (2, 8), (10_000, 8), (4, 3)])
def test_against_all_pairs(spark, monkeypatch, large, tile):
    monkeypatch.setattr(jaccard, "LARGE", large)
    monkeypatch.setattr(jaccard, "TILE", tile)
    rows = list(enumerate(texts()))
    rows += [(None, rows[20][1]), (None, "one"), (None, None), (4, "another text of six words"), (4, rows[30][1])]
    assert found_classes(spark, rows) == slow_classes(rows)


def test_edge_of_the_threshold(spark):
    words = [f"x{i}" for i in range(104)]
    nine = list(words)
    # 100 shingles; one changed word in the middle takes five away: 95/105, then 90/110, then 85/115.
    for at in (20, 50, 80):
        nine[at] = f"y{at}"
        rows = [(2, " ".join(words)), (1, " ".join(nine))]
        assert found_classes(spark, rows) == slow_classes(rows)
    # Exactly four fifths: the shorter of two texts is a beginning of the longer.
    for cut in (80, 79):
        rows = [(2, " ".join(words)), (1, " ".join(words[: cut + 4]))]
        assert found_classes(spark, rows) == slow_classes(rows)


def test_common_passage_and_many_copies(spark):
    draw = random.Random(2)
    passage = " ".join(draw.choices([f"p{i}" for i in range(90)], k=64))
    rows = [(i, f"{passage} " + " ".join(draw.choices([f"q{j}" for j in range(5000)], k=draw.randrange(5, 60)))) for i in range(250)]
    rows += [(1000 + i, rows[0][1]) for i in range(150)]
    assert found_classes(spark, rows, 8) == slow_classes(rows)


def test_classes_of_near_copies_meet_in_another_group(spark):
    """Two halves of near copies, each in a larger group with other texts, were left as 100 pairs."""
    draw = random.Random(3)
    words = [f"w{i}" for i in range(120)]
    rows = [" ".join([*words[: 6 * i], f"x{i}", *words[6 * i + 1 :]]) for i in range(20)]
    rows += [" ".join(draw.choices([f"q{j}" for j in range(5000)], k=120)) for _ in range(24)]
    sets = [(i, t.encode(), len(h := jaccard.shingles(t.encode())), jaccard.point(h).tobytes()) for i, t in enumerate(rows)]
    groups = {1: [*range(10), *range(20, 32)], 2: [*range(10, 20), *range(32, 44)]} | {s: range(20) for s in range(3, 13)}
    sets = spark.createDataFrame(sets, "row long, text binary, n long, point binary")
    members = spark.createDataFrame([(s, r) for s, own in groups.items() for r in own], "shingle long, row long")
    links, labels = jaccard._joined_first(members, sets, 5, 80)
    assert {(r.row, r.label) for r in labels.collect()} == {(i, 0) for i in range(20)}
    assert jaccard._candidates(members, labels, sets, 80).filter("a < 20 and b < 20").isEmpty()
    assert links.count() < 40


def test_empty(spark):
    assert found_classes(spark, []) == []
    assert found_classes(spark, [(5, None), (4, "")]) == [(4, 0, 4), (5, 0, 5)]


def test_whole_table(spark, small, duckdb_small):
    assert differences(jaccard.classes(table(spark, small, "documents")), duckdb_small, jaccard.SQL) == []
