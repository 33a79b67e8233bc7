"""Licence scans: base places against brute force, the parser by its cases."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import license_scan as L

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def slow_base(text):
    words = re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places = [(i, label) for phrase, label in L.BASE.items() for i in range(len(words))
              if words[i:i + len(phrase.split())] == phrase.split()]
    at = [i for i, _ in places]
    return (len(words), len(places), min(at, default=None), max(at, default=None),
            ",".join(sorted({label for _, label in places})))


pieces = st.sampled_from(["cc", "by", "CC BY", "BY-NC", "general", "General Public", "license", "License", "lesser",
                          "all rights", "reserved", "rights", "é", "ccé", "0", "license:", "SPDX-License-Identifier:",
                          "mit", "or", "(", ")", " "])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(pieces, st.sampled_from([" ", "-", "\n", "", ".", "\x00", " "])), max_size=25))
def test_base_places(parts):
    text = "".join(a + b for a, b in parts)
    r = L.scan(text)
    assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == slow_base(text)
    assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))
    assert 0 <= r["score"] <= 1 and r["labels"].split(",") == sorted(set(r["labels"].split(",")))


@pytest.mark.parametrize("text, postfix, labels, freedom", [
    ("MIT", "mit", {"mit"}, 0.95),
    ("MIT or GPL-2.0 and Apache-2.0", "mit gpl-2.0 apache-2.0 and or", {"mit", "gpl", "apache"}, 0.95),
    ("(MIT OR GPL-2.0) AND Apache-2.0", "mit gpl-2.0 or apache-2.0 and", {"mit", "gpl", "apache"}, 0.9),
    ("GPL-3.0-only WITH GCC-exception-3.1 OR AGPL-3.0", "gpl-3.0-only gcc-exception-3.1 with agpl-3.0 or",
     {"gpl", "agpl"}, (1 + 0.35) / 2),
    ("((LGPL-2.1+))", "lgpl-2.1+", {"lgpl"}, 0.5),
    ("CC-BY-NC-4.0. And more", "cc-by-nc-4.0", {"cc-by-nc"}, 0.2),
    ("MIT (see below)", "mit", {"mit"}, 0.95),
    ("BSD-3-Clause\nand GPL", "bsd-3-clause", {"bsd"}, 0.95),
])
def test_expressions(text, postfix, labels, freedom):
    e = L.parse(text.encode())
    assert " ".join(e.postfix) == postfix and e.labels == labels and e.freedom == pytest.approx(freedom)


@pytest.mark.parametrize("text", ["", "and MIT", "MIT or", "(MIT", "mystery-1.0", "MIT or mystery", "MIT with",
                                  "MIT or\nGPL", ")", "(MIT with GPL) with x with y or nothing"])
def test_no_expression(text):
    assert L.parse(text.encode()) is None


def by_recursion(tokens):
    """Freedom of a well-formed expression by recursive descent."""
    def operand():
        if tokens[0] == "(":
            tokens.pop(0)
            v = level("or")
            tokens.pop(0)
        else:
            v = L.FREEDOM[L.family(tokens.pop(0))]
        while tokens and tokens[0] == "with":
            del tokens[:2]
            v = (v + 1) / 2
        return v

    def level(op):
        below = operand if op == "and" else (lambda: level("and"))
        v = below()
        while tokens and tokens[0] == op:
            tokens.pop(0)
            v = (max if op == "or" else min)(v, below())
        return v

    return level("or")


expressions = st.recursive(
    st.sampled_from(["mit", "gpl-2.0", "apache-2.0", "cc-by-nc-4.0", "mpl with x-exception"]),
    lambda e: st.tuples(e, st.sampled_from(["and", "or"]), e).map(" ".join) | e.map(lambda x: f"( {x} )"), max_leaves=12)


@settings(max_examples=200, deadline=None)
@given(expressions)
def test_parser_agrees_with_recursive_descent(text):
    assert L.parse(text.encode()).freedom == pytest.approx(by_recursion(text.split()))


def test_notices_and_tags():
    r = L.scan("// SPDX-License-Identifier: MIT OR Apache-2.0\nReleased under the BSD License. CC BY-SA 4.0")
    assert r["labels"] == "apache,bsd,cc-by,cc-by-sa,mit" and r["base_labels"] == "cc-by"
    assert r["expressions"] == ["mit apache-2.0 or"] and r["score"] == L.SURE_TAG and r["freedom"] == 0.5
    assert L.scan("no licence here, a license to all")["score"] == 0


def test_table_edge_cases(spark):
    long = "word " * 200_000 + "All rights reserved"
    rows = [(1, "General Public License", 9, "a"), (1, "General Public License", 9, "a"), (None, None, None, None),
            (2, "", 0, "b"), (3, " \n", 0, "b"), (4, long, 1, "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words int, labels string").repartition(3)
    out = L.scan_licenses(df)
    got = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score)
                  for r in out.collect()), key=str)
    gpl = (1, 3, 1, 0, 0, "gpl", "gpl", L.SURE_BASE)
    none = [(d, 0, 0, None, None, "", "", 0.0) for d in (None, 2, 3)]
    assert got == sorted([gpl, gpl, *none, (4, 200_003, 1, 200_000, 200_000, "reserved", "reserved", L.SURE_BASE)],
                         key=str)
    assert L.scan_licenses(df.limit(0)).collect() == []
