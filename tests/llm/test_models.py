"""Toxicity, quality rules, page extraction and the pipeline on small tables."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from cohortlens.llm import dom, extraction, outliers, suffixes, toxicity
from cohortlens.llm.common import table
from tests.llm.test_matching import documents

# --- op3 -------------------------------------------------------------------------------


def made_documents(count, seed=0, stem="zorbl"):
    """Prose of invented words; every seventh document is toxic, by a lexicon word or by words
    that share a stem the lexicon does not know."""
    chance = random.Random(seed)
    word = lambda: "".join(chance.choice(["the", "an", "re", "on", "ti", "ing", "es"]) for _ in range(chance.randint(1, 4)))
    docs, labels = [], []
    for i in range(count):
        words = [word() for _ in range(chance.randint(30, 120))]
        toxic = i % 7 == 0
        if toxic:
            for _ in range(4):
                bad = "idiot" if i % 2 else stem + word()
                words.insert(chance.randrange(len(words)), bad)
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def label_table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_toxicity_on_held_out_rows(spark):
    docs, labels = made_documents(1500)
    frame = documents(spark, [t for _, t in docs])
    rows = toxicity.scores(frame, label_table(spark, labels)).collect()
    truth = {k: y for k, _, y in labels}
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 300
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.98 * len(held)


def test_held_out_labels_are_not_learnt(spark):
    docs, labels = made_documents(600)
    frame = documents(spark, [t for _, t in docs])
    turned = [(k, q, 1 - y if zlib.crc32(str(k).encode()) % 4 == 2 else y) for k, q, y in labels]
    one = sorted(map(tuple, toxicity.scores(frame, label_table(spark, labels)).collect()))
    other = sorted(map(tuple, toxicity.scores(frame, label_table(spark, turned)).collect()))
    assert [r[0] for r in one] == [r[0] for r in other]
    assert np.allclose([r[2] for r in one], [r[2] for r in other])


def test_toxicity_of_odd_rows(spark):
    docs = documents(spark, [None, "", "you idiot, worthless scum", "fine words", "long " * 100_000], [None, 1, 2, 2, 3])
    for rows in ([], [(2, 1, None), (None, 1, 1)], [(2, 1, 1), (2, 1, 1)]):
        found = toxicity.scores(docs, label_table(spark, rows))
        scores = {(r["doc_id"], r["predicted"]) for r in found.collect()}
        assert scores == {(None, 0), (1, 0), (2, 1), (2, 0), (3, 0)}
    kept = toxicity.not_toxic(docs, label_table(spark, []))
    assert kept.columns == docs.columns and kept.count() == 4
    assert toxicity.scores(documents(spark, []), label_table(spark, [])).count() == 0


def test_mined_forms_are_brute_force(spark):
    chance = random.Random(5)
    words = ["".join(chance.choices("abcé", k=chance.randint(1, 14))) for _ in range(60)]
    bad = ["vexorant", "vexorants", "vexo", "zu"]
    rows = []
    for i in range(400):
        toxic = i % 5 == 0
        rows.append((" ".join(chance.choices(words, k=20) + (chance.choices(bad, k=2) if toxic else [])), int(toxic)))
    rows += [(None, 0), ("", 1), ("x" * 5000, 0)]
    seen = {}
    for text, toxic in rows:
        found = set(re.findall(r"[^\W\d_]{2,}", (text or "").lower()))
        for form in found | {w[:n] + "-" for w in found for n in range(4, 13) if len(w) >= n}:
            seen.setdefault(form, [0, 0])[1 - toxic] += 1
    toxic = sum(t for _, t in rows)
    strong = {f: n for f, n in seen.items() if n[0] >= 4 and n[0] * (len(rows) - toxic) > 10 * n[1] * toxic}
    expected = {
        f
        for f, n in strong.items()
        if not f.endswith("-") or not any(strong.get(f[:k] + "-") == n for k in range(4, len(f) - 1))
    }
    mined = toxicity.mine_forms(spark.createDataFrame(rows, "text string, toxic int"))
    assert set(mined) == expected and {"vexorant", "vexorants", "vexo", "zu", "vexo-"} <= expected
    voters = toxicity.Voters.of(mined)
    fired = lambda text: {voters.names[i] for i in voters.fire(text)}
    assert {"1 mined words", "2 mined words", "zu", "vexo", "vexo-"} <= fired("Zu zu VEXO 1")
    assert "3 mined words" not in fired("Zu zu VEXO 1") and "vexo-" in fired("vexoring")
    assert fired(None) == fired("") == set()


def test_shouting_is_seen_without_marks():
    voters = toxicity.Voters.of([])
    assert [voters.names[i] for i in voters.fire("ALL OF THIS IS LOUD AND NOTHING ELSE")] == ["shouting"]


def test_most_toxic_rows_of_a_whole_table_are_found(spark):
    docs, labels = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    rows = [r for r in toxicity.scores(docs, labels).collect() if r["held_out"] and truth.get(r["doc_id"]) is not None]
    right = sum(truth[r["doc_id"]] for r in rows if r["predicted"])
    assert right >= 0.9 * sum(truth[r["doc_id"]] for r in rows)
    assert right >= 0.9 * sum(r["predicted"] for r in rows)


def test_label_model_finds_accuracies_and_correlations():
    chance = np.random.default_rng(0)
    truth = chance.random(4000) < 0.2
    fire = lambda yes, no: np.where(truth, chance.random(4000) < yes, chance.random(4000) < no).astype(float)
    good, weak, noise = fire(0.9, 0.01), fire(0.4, 0.1), fire(0.3, 0.3)
    votes = np.column_stack([good, good, weak, noise])  # the first two are one voter, given twice
    given = np.where(chance.random(4000) < 0.05, ~truth, truth).astype(float)
    posterior, yes, _ = toxicity.label_model(votes, given)
    assert ((posterior > 0.5) == truth).mean() > 0.94  # as good as the labels, whose errors are not believed at once
    assert yes[0] == pytest.approx(yes[1]) and yes[0] + yes[1] > 2 * yes[2] > 0
    assert abs(yes[3]) < 0.2
    alone = toxicity.label_model(votes[:, 1:], given)[1]
    assert alone[0] > 1.5 * yes[0]  # a voter given twice has about half the say each time


# --- op4 -------------------------------------------------------------------------------


def slow_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    again = sum(line in lines[:i] for i, line in enumerate(lines))
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(3)}
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, again, len(covered), failed


def test_counts_are_brute_force(spark, small):
    docs = table(spark, small, "documents")
    rows = outliers.quality(docs).collect()
    found = {r["doc_id"]: tuple(r)[1:7] for r in rows}
    assert found == {r["doc_id"]: slow_counts(r["text"]) for r in docs.collect()}
    assert all(not r["kept"] for r in rows if r["base_failed"])


@pytest.mark.parametrize("text", ["a b a b a b", "a a a a", "a b c", "é\xa0é x\x0by\n\n \nq\nq", "| * < \r\n* <\r\n"])
def test_counts_of_odd_texts(text):
    assert outliers.statistics(text)[0] == slow_counts(text)[:5]


def test_quality_agrees_with_labels(spark):
    folder = "/root/testdata/sf0.01"
    rows = {r["doc_id"]: r for r in outliers.quality(table(spark, folder, "documents")).collect()}
    labels = [(r["quality"], rows[r["doc_id"]]) for r in table(spark, folder, "labels").collect() if r["doc_id"] in rows]
    passed = [(q, r["kept"]) for q, r in labels if not r["base_failed"]]
    assert sum(kept for q, kept in passed if q == 1) >= 0.98 * sum(q == 1 for q, _ in passed)
    assert sum(not kept for q, kept in passed if q == 0) >= 0.95 * sum(q == 0 for q, _ in passed)


def test_estimates_resist_outliers(spark):
    """Cells of their own size: 30 of 100 rows far off leave the verdict on the others alone."""
    chance = random.Random(3)
    word = lambda: "".join(chance.choice("abcdefghijklmnop") for _ in range(chance.randint(3, 7)))
    clean = lambda: " ".join(word() + chance.choice(["", "", "", "", ",", "."]) for _ in range(chance.randint(60, 200)))
    texts = [clean() if i % 10 < 7 else " ".join(w + "%%% |" for w in clean().split()) for i in range(600)]
    rows = {r["doc_id"]: r for r in outliers.quality(documents(spark, texts)).collect()}
    wrong = sum(rows[i]["kept"] != (i % 10 < 7) for i in range(600))
    assert wrong <= 3


def test_verdict_follows_the_spread_of_the_cell(spark):
    """Marks per word spread widely in one language and hardly in another: the same rows with
    more marks are usual in the first and far off in the second."""
    chance = random.Random(5)
    word = lambda: "".join(chance.choice("abcdefghijklmnop") for _ in range(chance.randint(3, 7)))

    def text(share):
        return " ".join(w + "," * (i % 100 < 100 * share) for i, w in enumerate(word() for _ in range(200)))

    rows = [(i, text(chance.uniform(0.1, 0.5)), "wide") for i in range(300)]
    rows += [(300 + i, text(chance.uniform(0.19, 0.22)), "narrow") for i in range(300)]
    rows += [(600 + i, text(0.4), lang) for i, lang in enumerate(["wide"] * 5 + ["narrow"] * 5)]
    docs = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, lang string, source string")
    kept = {r["doc_id"]: r["kept"] for r in outliers.quality(docs).collect()}
    assert sum(kept[i] for i in range(600)) >= 594
    assert [kept[600 + i] for i in range(10)] == [True] * 5 + [False] * 5


def test_copies_leave_a_cell_its_scatter(spark):
    """A text that fills over half of a cell does not turn the others into outliers."""
    chance = random.Random(6)
    word = lambda: "".join(chance.choice("abcdefghijklmnop") for _ in range(chance.randint(3, 7)))
    texts = [" ".join(word() for _ in range(chance.randint(60, 200))) for _ in range(300)]
    rows = outliers.quality(documents(spark, texts + texts[:1] * 500)).collect()
    assert sum(r["kept"] for r in rows) >= 795


def test_guards_only_stand_in_for_a_scatter_of_zero():
    guard = np.full(outliers.SIZE, 0.1)
    wide = np.diag(np.arange(1.0, outliers.SIZE + 1))
    wide[0, 1] = wide[1, 0] = 0.5
    assert np.allclose(outliers.guarded(wide, guard), wide, atol=1e-3)
    wide[2] = wide[:, 2] = 0.0
    assert outliers.guarded(wide, guard)[2, 2] == pytest.approx(0.01)
    assert outliers.chi_square(0.99999) == pytest.approx(36.1, abs=0.3)


def test_quality_of_odd_rows(spark):
    rows = outliers.quality(documents(spark, [None, "", "a " * 60, " ".join(f"w{i}" for i in range(70))], [None, 1, 2, 2])).collect()
    assert Counter((r["base_failed"], r["kept"], r["distance"] is None) for r in rows) == Counter([(True, False, True)] * 3 + [(False, True, True)])
    assert outliers.quality(documents(spark, [])).count() == 0


# --- op5 -------------------------------------------------------------------------------

LOREM = (
    "Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor incididunt ut labore et dolore "
    "magna aliqua. Ut enim ad minim veniam, quis nostrud."
)


@pytest.fixture(scope="module")
def trees(spark):
    return extraction.fit(table(spark, "/root/testdata/sf0.01", "pages"))


def text_of(trees, source):
    page = dom.read(source)
    return extraction.main_text(source, trees.odds(extraction.features(page)), page)


def test_articles_of_whole_table(spark, small):
    """On these pages the article element is the main text."""
    for r in extraction.extract(table(spark, small, "pages")).join(table(spark, small, "pages"), "page_id").collect():
        inner = re.search(r"(?s)<article>(.*?)</article>", r["html"])[1]
        blocks = (" ".join(dom.html.unescape(re.sub(r"<[^>]+>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner))
        assert r["text"] == "\n\n".join(b for b in blocks if b)
        assert r["n_chars"] == len(r["text"])


def whole(body):
    return f"<html><head><title>T</title><style>p {{}}</style></head><body>{body}</body></html>"


@pytest.mark.parametrize(
    ("body", "expected"),
    [
        (f"<nav><a href=a>Home</a></nav><article><h1>Title</h1><p>{LOREM}</p></article><footer>&copy; X</footer>", ["Title", LOREM]),
        (
            f"<div id=header><a href=/>Site</a></div><div class=menu><ul><li><a href=a>A</a><li><a href=b>B</a></ul></div>"
            f"<div class=post><h2>Title</h2><p>{LOREM}<p>{LOREM}<div class=ad>Buy now</div><p>{LOREM}</div>"
            f"<div class=sidebar><h3>Popular</h3><p>{LOREM}</p></div><div class=footer>Contact us</div>",
            ["Title", LOREM, LOREM, LOREM],
        ),
        (
            f"<main><article><h1>Title</h1><p>{LOREM}</p></article></main><section class=comments><h2>Comments</h2>"
            f"<div class=comment><p>{LOREM} nice</p></div></section>",
            ["Title", LOREM],
        ),
        (
            f"<div class=cookie-banner><p>We use cookies. {LOREM}</p><button>OK</button></div><div class=entry-content>"
            f"<p>{LOREM}</p><ul><li>one&nbsp;thing<li>two   things</ul></div><form class=newsletter><p>Sign up</p><input></form>",
            [LOREM, "one thing", "two things"],
        ),
    ],
)
def test_markups_not_in_the_table(trees, body, expected):
    assert text_of(trees, whole(body)) == "\n\n".join(expected)


def test_links_and_marks_inside_paragraphs_stay(trees):
    first = LOREM.replace("dolor sit", "<a href=/d>dolor sit</a>").replace("magna aliqua", "<a href=/m><em>magna aliqua</em></a>")
    second = LOREM.replace("elit", "<code>elit</code>").replace("Ut enim", "<span>Ut enim</span>").replace("veniam", "<a href=/v>veniam</a>")
    items = "".join(f"<li><a href=/{i}>{LOREM[:50]}</a> {LOREM}</li>" for i in range(2))
    page = (
        f"<nav><ul><li><a href=a>Home</a></li><li><a href=b>News</a></li></ul></nav><article><h1>Title</h1><p>{first}</p>"
        f"<p>{second}</p><ul>{items}</ul><pre>{LOREM}</pre><p>{first}</p></article><footer><a href=/c>&copy; X</a></footer>"
    )
    item = f"{LOREM[:50]} {LOREM}"
    assert text_of(trees, whole(page)).split("\n\n") == ["Title", LOREM, LOREM, item, item, LOREM, LOREM]


def test_held_out_built_pages(spark, trees):
    chance = random.Random("other")
    right = found = wanted = 0
    for r in table(spark, "/root/testdata/sf0.1", "pages").filter("page_id % 40 = 7").collect():
        long, short = extraction.pieces(r["html"])
        if not long:
            continue
        page = dom.read(extraction.build(long, short, chance))
        inside = extraction.truth(page)
        gold = Counter(extraction.assemble(page, inside.astype(bool)).split())
        got = Counter(extraction.main_text("", trees.odds(extraction.features(page)), page).split())
        right += sum((gold & got).values())
        found += sum(got.values())
        wanted += sum(gold.values())
    assert right / found > 0.9 and right / wanted > 0.9


def test_decoding_is_the_best_choice():
    chance = random.Random(1)
    for _ in range(60):
        count = chance.randint(1, 9)
        parent = [-1] + [chance.randrange(i) for i in range(1, count)]
        odds = np.array([chance.uniform(-2, 2) for _ in range(count)])
        best = 0.0
        for choice in range(1 << count):
            if all(not choice >> i & 1 or choice >> parent[i] & 1 for i in range(1, count)):
                best = max(best, sum(odds[i] for i in range(count) if choice >> i & 1))
        kept = extraction.decode(parent, odds)
        assert all(kept[parent[i]] for i in range(1, count) if kept[i])
        assert float(odds[kept].sum()) == pytest.approx(best)


def test_pages_that_are_broken():
    for source in ("", "<", "<<<>>", "<p", "<a href='x", "<!-- never closed", "<script>x", "</p></div>", "<p>a<p>b<li>c", "&#xZ; &amp &lt;p>"):
        page = dom.read(source)
        assert len(page.tag) == len(page.parent) == len(extraction.features(page))
    page = dom.read("<p>a <b>b</b>c<br>d</p>e<script>no</script>f &eacute;&nbsp;&#8212;")
    assert extraction.assemble(page, np.ones(len(page.tag), bool)) == "a bc d\n\nef é —"


def test_extraction_of_odd_rows(spark):
    rows = [(1, None, None), (1, "u", ""), (None, "u", "<p>" + "x y, " * 60_000), (2, "v", "<p>short</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = extraction.extract(pages.selectExpr("*", "'a' as text", "1 as n_chars")).collect()
    assert Counter((r["page_id"], r["url"]) for r in found) == Counter((a, b) for a, b, _ in rows)
    assert {r["n_chars"] for r in found if r["page_id"] == 1} == {0}
    assert extraction.extract(spark.createDataFrame([], pages.schema)).count() == 0


# --- pipeline --------------------------------------------------------------------------


def test_pipeline_stages(spark, small):
    docs = table(spark, small, "documents")
    columns = docs.columns
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, small)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == columns
        after = after.cache()
        if name == "toxicity":
            scores = {r["doc_id"]: r["predicted"] for r in toxicity.scores(before, table(spark, small, "labels")).collect()}
            assert {r["doc_id"] for r in after.collect()} == {k for k, v in scores.items() if not v}
        elif name == "simhash_near_dedup":
            from tests.llm.test_matching import slow_components, slow_fingerprint

            rows = sorted(before.select("doc_id", "text").collect())
            groups = slow_components([slow_fingerprint(r["text"]) for r in rows])
            first = {}
            for r, g in zip(rows, groups, strict=True):
                first.setdefault(g, r["doc_id"])
            assert sorted(r["doc_id"] for r in after.collect()) == sorted(first.values())
        elif name == "suffix_array_dedup":
            assert after.count() == before.count()
            assert suffixes.repeats(after).filter("known_words > 0").count() == 0
        elif name == "source_mixture":
            words = lambda rows: sum(len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) for r in rows.collect())
            assert words(after) == pytest.approx(1.5 * words(before), rel=0.03)
            copies = Counter(r["doc_id"] for r in after.collect())
            assert set(copies.values()) <= {1, 2}
        before = after
    assert before.columns[:4] == ["doc_id", "piece", "start", "length"]
    assert not math.isnan(before.count())
