"""Licence notices and identifier tags in whole texts, found with an Aho-Corasick automaton.

A text is reduced to its words; the automaton finds the words of every phrase wherever they
stand one after the other. The place of an identifier tag is then read as a licence
expression: a shunting-yard parser orders its ``and``, ``or`` and ``with``, and the ordered
form is evaluated to labels and to a freedom between 0 and 1.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import cache

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.llm.common import map_rows, utf8

# Fixed by the contract: phrase and label.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Notice phrases beyond the base: phrase, label and how strongly it tells of a licence.
NOTICES = {
    "gnu lesser general public license": ("lgpl", 0.9),
    "gnu library general public license": ("lgpl", 0.9),
    "gnu affero general public license": ("agpl", 0.9),
    "gnu free documentation license": ("gfdl", 0.9),
    "mozilla public license": ("mpl", 0.9),
    "eclipse public license": ("epl", 0.9),
    "european union public licence": ("eupl", 0.9),
    "common development and distribution license": ("cddl", 0.9),
    "boost software license": ("bsl", 0.9),
    "bsd license": ("bsd", 0.8),
    "bsd 2 clause license": ("bsd", 0.9),
    "bsd 3 clause license": ("bsd", 0.9),
    "redistribution and use in source and binary forms": ("bsd", 0.8),
    "permission is hereby granted free of charge to any person obtaining a copy": ("mit", 0.8),
    "isc license": ("isc", 0.9),
    "zlib license": ("zlib", 0.9),
    "artistic license": ("artistic", 0.8),
    "creative commons attribution": ("cc-by", 0.8),
    "creative commons zero": ("cc0", 0.9),
    "cc0": ("cc0", 0.7),
    "cc by sa": ("cc-by-sa", 0.9),
    "cc by nc": ("cc-by-nc", 0.9),
    "cc by nd": ("cc-by-nd", 0.9),
    "cc by nc sa": ("cc-by-nc-sa", 0.9),
    "cc by nc nd": ("cc-by-nc-nd", 0.9),
    "unlicense": ("unlicense", 0.6),
    "released into the public domain": ("public-domain", 0.7),
    "dedicated to the public domain": ("public-domain", 0.7),
    "all rights reserved": ("proprietary", 0.5),
    "licensed under": ("", 0.3),
    "released under": ("", 0.2),
}
BASE_STRENGTH = 0.8
TAG = "spdx license identifier"
TAG_STRENGTH = 0.95

#: Families of identifiers by the words they begin with: label and freedom of use.
FAMILIES = {
    "mit": ("mit", 1.0),
    "apache": ("apache", 1.0),
    "bsd": ("bsd", 1.0),
    "isc": ("isc", 1.0),
    "zlib": ("zlib", 1.0),
    "bsl": ("bsl", 1.0),
    "unlicense": ("unlicense", 1.0),
    "0bsd": ("bsd", 1.0),
    "cc0": ("cc0", 1.0),
    "cc-by-nc-nd": ("cc-by-nc-nd", 0.1),
    "cc-by-nc-sa": ("cc-by-nc-sa", 0.2),
    "cc-by-nc": ("cc-by-nc", 0.2),
    "cc-by-nd": ("cc-by-nd", 0.2),
    "cc-by-sa": ("cc-by-sa", 0.6),
    "cc-by": ("cc-by", 0.9),
    "agpl": ("agpl", 0.3),
    "lgpl": ("lgpl", 0.6),
    "gpl": ("gpl", 0.4),
    "gfdl": ("gfdl", 0.5),
    "mpl": ("mpl", 0.7),
    "epl": ("epl", 0.7),
    "eupl": ("eupl", 0.6),
    "cddl": ("cddl", 0.6),
    "artistic": ("artistic", 0.8),
}
#: What a ``with`` exception adds to the freedom of the licence before it.
EXCEPTION = 0.2

_CLEAN = bytes(
    c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20
    for c in range(256)
)
_WORD = re.compile(rb"[^\x20]+")
_TOKEN = re.compile(r"\(|\)|[A-Za-z0-9][A-Za-z0-9.+-]*|[^\s]")
_RANK = {"or": 1, "and": 2, "with": 3}


def postfix(expression: str) -> list[str]:
    """Shunting-yard: the expression's operands and operators in evaluation order.

    ``with`` binds closest, then ``and``, then ``or``; equal ones from the left. Reading stops
    where two operands follow each other or a sign stands that no expression holds, so prose
    after an expression is not taken in. Brackets left open are closed at the end; an operator
    without its operand is left out.
    """
    out: list[str] = []
    held: list[str] = []
    want = True  # an operand is due
    for token in _TOKEN.findall(expression):
        word = token.lower()
        if want:
            if token == "(":
                held.append(token)
            elif word in _RANK or not token[0].isalnum():
                break
            else:
                out.append(token)
                want = False
        elif word in _RANK:
            while held and held[-1] != "(" and _RANK[held[-1]] >= _RANK[word]:
                out.append(held.pop())
            held.append(word)
            want = True
        elif token == ")" and "(" in held:
            while held[-1] != "(":
                out.append(held.pop())
            held.pop()
        else:
            break
    if want:  # nothing follows the last operator and the brackets after it
        while held and held[-1] == "(":
            held.pop()
        if held:
            held.pop()
    return out + [token for token in reversed(held) if token != "("]


def family(identifier: str) -> tuple[str, float]:
    """Label and freedom of one identifier; unknown ones keep their name and count half."""
    name = identifier.lower().rstrip("+.")
    parts = name.split("-")
    for size in range(len(parts), 0, -1):
        if (known := FAMILIES.get("-".join(parts[:size]))) is not None:
            return known
    return name, 0.5


def evaluate(ordered: list[str]) -> tuple[set[str], float | None]:
    """Labels and freedom of a postfix expression: ``or`` takes the freer side, ``and`` the
    stricter, ``with`` eases the licence before it. Nothing gives no labels and None."""
    stack: list[tuple[set[str], float]] = []
    for token in ordered:
        if token not in _RANK:
            label, freedom = family(token)
            stack.append(({label}, freedom))
            continue
        if len(stack) < 2:
            break
        right, left = stack.pop(), stack.pop()
        if token == "with":
            stack.append((left[0], min(1.0, left[1] + EXCEPTION)))
        else:
            pick = max if token == "or" else min
            stack.append((left[0] | right[0], pick(left[1], right[1])))
    return stack[-1] if stack else (set(), None)


@cache
def automaton() -> ahocorasick.Automaton:
    machine = ahocorasick.Automaton()
    phrases: dict[str, tuple[str, str, float]] = {p: ("notice", *rest) for p, rest in NOTICES.items()}
    phrases |= {p: ("base", label, BASE_STRENGTH) for p, label in BASE.items()}
    phrases[TAG] = ("tag", "", TAG_STRENGTH)
    for phrase, what in phrases.items():
        machine.add_word(f" {phrase} ", (phrase, *what))
    machine.make_automaton()
    return machine


def scan(text: str | None) -> tuple:
    """``(n_words, n_base, first_word, last_word, base_labels, labels, score, expressions, freedom)``."""
    raw = utf8(text)
    clean = raw.translate(_CLEAN)
    words = clean.split()
    line = (b" " + b" ".join(words) + b" ").decode("latin-1")
    starts: list[int] = []
    base: set[str] = set()
    labels: set[str] = set()
    weights: dict[str, float] = {}
    expressions: list[str] = []
    freedom: float | None = None
    places: list[int] = []
    seen, at = 0, 0
    for end, (phrase, kind, label, weight) in automaton().iter(line):
        weights[phrase] = weight
        if label:
            labels.add(label)
        if kind == "notice":
            continue
        start = end - len(phrase) - 1
        at += line.count(" ", seen, start) if start >= seen else -line.count(" ", start, seen)
        seen = start
        if kind == "base":
            starts.append(at)
            base.add(label)
            continue
        places = places or [m.start() for m in _WORD.finditer(clean)]
        after = at + len(TAG.split())
        found = postfix(_rest_of_line(raw, places[after])) if after < len(places) else []
        if found:
            more, free = evaluate(found)
            labels |= more
            expressions.append(" ".join(found))
            freedom = free if freedom is None else min(freedom, free)
    missing = 1.0
    for weight in weights.values():
        missing *= 1 - weight
    return (
        len(words),
        len(starts),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted(base)),
        ",".join(sorted(labels)),
        round(1 - missing, 9),
        expressions,
        freedom,
    )


def _rest_of_line(raw: bytes, start: int) -> str:
    """The line from that place on, with the brackets that stand before it."""
    while start and raw[start - 1 : start] == b"(":
        start -= 1
    end = raw.find(b"\n", start)
    return raw[start : len(raw) if end < 0 else end].decode("utf-8", "replace")


SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_words", T.LongType()),
        T.StructField("n_base", T.LongType()),
        T.StructField("first_word", T.LongType()),
        T.StructField("last_word", T.LongType()),
        T.StructField("base_labels", T.StringType()),
        T.StructField("labels", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("expressions", T.ArrayType(T.StringType())),
        T.StructField("freedom", T.DoubleType()),
    ]
)


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs`` with its licence phrases, labels and expressions.

    ``n_base`` counts every place of a base phrase, overlapping ones included; ``first_word``
    and ``last_word`` are null without one. ``score`` is the chance that at least one of the
    distinct phrases found tells of a licence, were they independent; 0 without any.
    ``expressions`` holds the tagged expressions in postfix order and ``freedom`` the strictest
    of their values, null without a tag. A null or empty text has no words; a null id stays
    null; equal rows give equal rows; other columns are not read. No shuffle.
    """

    def make(rows: Iterable[tuple]) -> Iterator[tuple]:
        for key, text in rows:
            yield key, *scan(text)

    return map_rows(docs.select(F.col(id_col).cast("long"), F.col(text_col)), make, SCHEMA)
