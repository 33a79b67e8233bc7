"""Phrase collocations against brute force, with small blocks and tries."""

import re
from collections import Counter, defaultdict
from random import Random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import collocations as C

FIELDS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
SCHEMA = "phrase string, n int, lang string, text string, block int"


def slow(rows, least, top, cover=80):
    f, n = defaultdict(Counter), Counter()
    for _, _, lang, text, _ in rows:
        folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0A-\x0D]", folded):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            f[lang or "und"].update(tuple(w[i:i + k]) for k in range(1, 5) for i in range(len(w) - k + 1))
    out = []
    for lang, count in f.items():
        cand = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        gone = {p[i:j] for p, a in cand.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
                if j - i < len(p) and 100 * a >= cover * count[p[i:j]]}
        rows_ = []
        for p, a in cand.items():
            if p not in gone:
                s, k = min((2_000_000 * a // (count[p[:k]] + count[p[k:]]), k) for k in range(1, len(p)))
                rows_.append((-s, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(rows_)[:top])]
    return sorted(out)


def got(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted(tuple(r[c] for c in FIELDS) for r in C.mine(df, **options).collect())


def test_brute_force_and_edge_cases(spark, monkeypatch):
    monkeypatch.setattr(C, "BLOCK_WORDS", 400)                   # several blocks a task
    rnd = Random(12)
    words = ["New", "york", "City", "of", "the", "été", "日本", "a\x85b", "x\xa0y", "c\x1cd", "$5", "Q"]
    rows = []
    for _ in range(150):
        sep = rnd.choice([" ", "\t", "  "])
        text = "".join(rnd.choice(words) + rnd.choice([sep, sep, sep, ". ", ",", "\n", "\x0b"])
                       for _ in range(rnd.randrange(30)))
        rows.append(("x", 1, rnd.choice(["en", "en", "fr", None]), text + " New York City of the", 5))
    rows += [("x", 1, "en", None, 5), (None, None, None, "", None), ("x", 1, "xx", " .. ", 5),
             ("x", 1, "en", "la " * 3000 + "end", 5)] + rows[:10]
    want = slow(rows, 6, 40)
    assert {r[0] for r in want} == {"en", "fr", "und"} and any(r[2] == "la la la la" for r in want)
    assert got(spark, rows, least=6, top=40) == want
    monkeypatch.setattr(C, "PARCEL_WORDS", 500)
    assert got(spark, rows, least=6, top=40, trie_phrases=25) == want
    # Hashes that many phrases share: all blocks name theirs.
    assert got(spark, rows, least=6, top=40, spare_bits=-6) == want


@pytest.mark.parametrize("rows", [[], [("x", 1, None, None, 1)], [("x", 1, "en", "one two one two", 1)]])
def test_without_frequent_phrases(spark, rows):
    assert got(spark, rows) == []


@given(st.lists(st.integers(0, 2 ** 62), max_size=50))
def test_packed_ascending(x):
    x = np.sort(np.array(x, np.int64))
    assert C.ascending(C.packed_ascending(x)).tolist() == x.tolist()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 12), min_size=1, max_size=5), max_size=60, unique_by=tuple))
def test_double_array(rows):
    lengths = np.array([len(r) for r in rows], np.int64)
    padded = np.array([r + [-1] * (5 - len(r)) for r in rows], np.int64).reshape(-1, 5)
    trie = C.DoubleArray(padded, lengths)
    prefixes = {()} | {tuple(r[:k]) for r in rows for k in range(len(r) + 1)}
    states = {(): trie.root}
    for depth in range(5):
        for p in [p for p in states if len(p) == depth]:
            for c in range(-1, trie.width):
                t = int(trie.step(np.array([states[p]]), np.array([c]))[0])
                assert (t >= 0) == (p + (c,) in prefixes)
                if t >= 0:
                    states[p + (c,)] = t
    assert len(set(states.values())) == len(prefixes)            # no two share a state
    assert {p: int(trie.accept[t]) for p, t in states.items() if trie.accept[t] >= 0} == {
        tuple(r): i for i, r in enumerate(rows)}


def test_double_array_of_large_families_stays_small():
    rnd = np.random.default_rng(3)
    rows = np.unique(np.column_stack([np.zeros(40_000, int), rnd.zipf(1.3, 40_000) % 9000,
                                      rnd.integers(0, 9000, 40_000)]), axis=0)
    trie = C.DoubleArray(rows, np.full(len(rows), 3))
    assert len(trie.base) < 8 * len(rows) + 4 * trie.width
