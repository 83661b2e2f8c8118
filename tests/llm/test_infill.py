"""Fill-in-the-middle against a plain reading of the rule, and against SQL."""

import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortlens.llm import infill
from cohortlens.llm.common import table
from tests.compare import differences

CHARACTERS = list("aZzA@[`{0 \n\x00\x7f") + ["é", "ß", "中", "߿", "￿", "🙂", "\U0010ffff"]
UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]")


@given(st.lists(st.sampled_from(CHARACTERS), max_size=70).map("".join))
@settings(max_examples=400, deadline=None)
def test_units(text):
    units = UNIT.findall(text)
    found = infill.Units(text.encode())
    assert found.count == len(units)
    lengths = [len("".join(units[:k]).encode()) for k in range(len(units) + 1)]
    assert [found.byte_after(k) for k in range(len(units) + 1)] == lengths


def test_blocks_do_not_show(monkeypatch):
    text = "some words, und Wörter, 漢字 " * 40
    whole = infill.Units(text.encode())
    monkeypatch.setattr(infill, "BLOCK", 3)
    parts = infill.Units(text.encode())
    assert (whole.until == parts.until).all()
    assert [whole.byte_after(k) for k in range(whole.count + 1)] == [parts.byte_after(k) for k in range(parts.count + 1)]


def plainly(text, key):
    """The rule, read word by word."""
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return key, n, "plain", None, None, text, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 20:
        return key, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}", text
    return key, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}", text


def test_rows(spark):
    texts = [None, "", "a", "<P> marked", "two words\n", "<", "<S <M P>", "Grüße, 世界! 🙂 once more", "x" * 50_000, "a. " * 50_000]
    rows = [(i, t, -i) for i, t in enumerate(texts * 12)] + [(None, "no id here", 0), (3, "<P> marked", 0), (3, "again", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n long")
    made = infill.fill_in_middle(docs)
    found = made.withColumn("text", infill.restored(F.col("output"), F.col("form"))).collect()
    assert sorted(map(tuple, found), key=str) == sorted((plainly(t, k) for k, t, _ in rows), key=str)
    assert {r["form"] for r in found} == {"plain", "psm", "spm"}


def test_parameters(spark):
    docs = spark.createDataFrame([(i, "one two three four") for i in range(300)], "key int, body string")
    forms = [r["form"] for r in infill.fill_in_middle(docs, "key", "body", 7, 50, 100).collect()]
    assert set(forms) == {"plain", "spm"} and 100 < forms.count("spm") < 200


def test_empty(spark):
    assert infill.digests(infill.fill_in_middle(spark.createDataFrame([], "doc_id long, text string"))).collect() == []


def test_whole_table(spark, small, duckdb_small):
    made = infill.digests(infill.fill_in_middle(table(spark, small, "documents")))
    assert differences(made, duckdb_small, infill.SQL) == []
