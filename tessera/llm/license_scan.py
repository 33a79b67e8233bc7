"""Licence scans.

One Aho-Corasick automaton finds notice phrases and identifier tags among a
text's words; what follows a tag (``SPDX-License-Identifier: MIT OR (GPL-2.0
WITH ...)``) is read by a shunting-yard parser, which turns it to postfix order
and evaluates it: OR takes the freer side, AND the stricter one, WITH an
exception that frees a licence halfway.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tessera.llm.common import map_texts

#: Bytes of words stay (A-Z lower-cased), all others are a space.
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
               for c in range(256))

#: Phrases whose places are counted, and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Further notices, and their labels.
NOTICES = {
    "affero general public license": "agpl",
    "apache license": "apache",
    "apache software license": "apache",
    "attribution noncommercial": "cc-by-nc",
    "attribution sharealike": "cc-by-sa",
    "bsd license": "bsd",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by sa": "cc-by-sa",
    "cc0": "cc0",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "gnu gpl": "gpl",
    "isc license": "isc",
    "lesser general public license": "lgpl",
    "mit license": "mit",
    "mozilla public license": "mpl",
    "permission is hereby granted free of charge to any person": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "released into the public domain": "public-domain",
    "under the terms of the gpl": "gpl",
}

#: Words of a tag; an expression follows after a colon or an equals sign.
TAGS = ("spdx license identifier", "license expression", "licence expression", "license", "licence")

#: How freely a label's works may be used, from 0 to 1.
FREEDOM = {
    "agpl": 0.3, "apache": 0.9, "bsd": 0.95, "cc-by": 0.85, "cc-by-nc": 0.2, "cc-by-nd": 0.2, "cc-by-sa": 0.5,
    "cc0": 1.0, "gpl": 0.35, "isc": 0.95, "lgpl": 0.5, "mit": 0.95, "mpl": 0.6, "public-domain": 1.0,
    "reserved": 0.0, "unlicense": 1.0,
}

#: Families of licence identifiers, longest first: ``gpl-2.0-or-later`` is ``gpl``.
_FAMILY = re.compile(r"(%s)(?![a-z])" % "|".join(sorted(map(re.escape, FREEDOM), key=lambda f: (-len(f), f))))

#: How sure a finding of each kind is; a document's score is that of its surest.
SURE_TAG, SURE_NOTICE, SURE_BASE = 1.0, 0.9, 0.7

#: What may stand between a tag and its expression, and the expression's tokens.
_OPENING = re.compile(rb"[ \t\"']*[:=]")
_TOKEN = re.compile(rb"[()\n]|[A-Za-z0-9][A-Za-z0-9.+:-]*|\S")
_RANK = {"or": 1, "and": 2, "with": 3}


def family(name: str) -> str | None:
    """The label of a licence identifier, None if it isn't known."""
    m = _FAMILY.match(name.lower())
    return m[1] if m else None


@dataclass(frozen=True)
class Expression:
    postfix: tuple[str, ...]      # operands as written in lower case, operators and, or, with
    labels: frozenset[str]        # of its licences
    freedom: float


def parse(text: bytes, start: int = 0) -> Expression | None:
    """The licence expression at ``start``; None if there is none, its
    parentheses don't match or one of its licences isn't known.

    It ends before the line's end and before the first token that can't go on
    with it.  WITH binds
    closest, then AND, then OR; operators of one rank are taken from the left.
    """
    out: list[str] = []
    stack: list[str] = []
    operand = True                # an operand or ( is to come, else an operator or )
    for m in _TOKEN.finditer(text, start):
        token = m[0]
        t = token.decode("latin-1").lower().rstrip(".:")
        if operand and t == "(":
            stack.append(t)
        elif operand and t and t not in _RANK and t[0].isalnum():
            out.append(t)
            operand = False
        elif not operand and t in _RANK:
            while stack and _RANK.get(stack[-1], 0) >= _RANK[t]:
                out.append(stack.pop())
            stack.append(t)
            operand = True
        elif not operand and t == ")" and "(" in stack:
            while (top := stack.pop()) != "(":
                out.append(top)
        else:
            break
        if not operand and token.endswith(b"."):
            break
    if operand or "(" in stack:
        return None
    out += reversed(stack)
    return evaluate(tuple(out))


def evaluate(postfix: tuple[str, ...]) -> Expression | None:
    """Value of an expression in postfix order."""
    stack: list[float | str] = []
    labels = set()

    def value(x: float | str) -> float | None:
        if isinstance(x, float):
            return x
        label = family(x)
        if label is None:
            return None
        labels.add(label)
        return FREEDOM[label]

    for t in postfix:
        if t not in _RANK:
            stack.append(t)
            continue
        right, left = stack.pop(), value(stack.pop())
        if t == "with":
            if left is None or not isinstance(right, str):
                return None
            stack.append((left + 1) / 2)
            continue
        right = value(right)
        if left is None or right is None:
            return None
        stack.append(max(left, right) if t == "or" else min(left, right))
    freedom = value(stack.pop())
    return None if freedom is None or stack else Expression(postfix, frozenset(labels), freedom)


@lru_cache(maxsize=1)
def _automaton():
    """The automaton, and of each pattern its kind, label and number of words."""
    import ahocorasick

    patterns: dict[str, list] = {}
    for kind, names in (("base", BASE), ("notice", NOTICES), ("tag", dict.fromkeys(TAGS))):
        for phrase, label in names.items():
            patterns.setdefault(phrase, []).append((kind, label, len(phrase.split())))
    automaton = ahocorasick.Automaton()
    for phrase, found in patterns.items():
        automaton.add_word(f" {phrase} ", (len(phrase) + 1, found))
    automaton.make_automaton()
    return automaton


def _word_ends(raw: np.ndarray) -> np.ndarray:
    """Where each word of the text ends."""
    word = np.frombuffer(_WORDS, np.uint8)[raw] != 32
    return np.flatnonzero(word & ~np.append(word[1:], False)) + 1


def scan(text: str | None) -> dict:
    """What one text holds; see ``scan_licenses``."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.translate(_WORDS).split()
    base, base_labels, labels, expressions = [], set(), set(), []
    score, freedom = 0.0, None
    found = []
    if words:
        line = b" ".join([b"", *words, b""])
        # one character a byte, so that offsets are those of the bytes
        found = [(end - back, f) for end, (back, fs) in _automaton().iter(line.decode("latin-1")) for f in fs]
    if found:
        spaces = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
        at = np.searchsorted(spaces, [f[0] for f in found]).tolist()
        ends = None
        for word, (_, (kind, label, n)) in zip(at, found):
            if kind == "base":
                base.append(word)
                base_labels.add(label)
                score = max(score, SURE_BASE)
            elif kind == "notice":
                labels.add(label)
                score = max(score, SURE_NOTICE)
            else:
                if ends is None:
                    ends = _word_ends(np.frombuffer(raw, np.uint8))
                opened = _OPENING.match(raw, int(ends[word + n - 1]))
                got = parse(raw, opened.end()) if opened else None
                if got:
                    expressions.append(got)
    for e in expressions:
        labels |= e.labels
        score = SURE_TAG
    stated = [e.freedom for e in expressions]
    stated += [FREEDOM[x] for x in (labels | base_labels) if not any(x in e.labels for e in expressions)]
    if stated:
        freedom = min(stated)
    return {"n_words": len(words), "n_base": len(base), "first_word": min(base, default=None),
            "last_word": max(base, default=None), "base_labels": ",".join(sorted(base_labels)),
            "labels": ",".join(sorted(labels | base_labels)), "score": score, "freedom": freedom,
            "expressions": [" ".join(e.postfix) for e in expressions]}


FIELDS = [T.StructField("n_words", T.LongType()), T.StructField("n_base", T.LongType()),
          T.StructField("first_word", T.LongType()), T.StructField("last_word", T.LongType()),
          T.StructField("base_labels", T.StringType()), T.StructField("labels", T.StringType()),
          T.StructField("score", T.DoubleType()), T.StructField("freedom", T.DoubleType()),
          T.StructField("expressions", T.ArrayType(T.StringType()))]


def scan_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score, freedom, expressions) of every row of ``df``; no shuffle.

    ``n_base``: places of the ``BASE`` phrases, overlapping ones included,
    ``first_word`` and ``last_word`` the smallest and largest number of the word
    they start at (from 0; null without one).  ``labels``: those of the base
    phrases, of ``NOTICES`` and of expressions after ``TAGS``; sorted, distinct,
    joined by commas, empty without one.  ``score``: how sure the surest
    finding is, 0 without one.  ``freedom``: of the strictest statement, a
    label within an expression counting as the expression does; null without
    one.  ``expressions``: in postfix order, in order of their ends.

    Null and empty texts have no words and no findings.  A text is worked on
    whole, by itself: repeated rows and ids, null ids and other columns change
    nothing; an empty table gives no rows.
    """

    def work(texts: list) -> dict[str, object]:
        rows = [scan(t) for t in texts]
        return {f.name: [r[f.name] for r in rows] for f in FIELDS}

    return map_texts(df, text_col, {"doc_id": id_col}, FIELDS, work)
