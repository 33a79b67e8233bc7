"""SimHash near-duplicates against brute force."""

import random
import re

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import simhash
from tessera.llm.components import local_roots, stars


def slow_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[i:i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abAÉé \t\n\x0b\x1f\x85 ", max_size=60))
def test_fingerprint(text):
    assert simhash.fingerprint(text) == slow_fingerprint(text)


def components(fps, ids, threshold):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= threshold:
                root[find(i)] = find(j)
    low = {}
    for i, d in enumerate(ids):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return [low.get(find(i)) for i in range(len(fps))]


def check(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string, component_id int").repartition(4)
    got = simhash.near_duplicates(df, **kw).collect()
    fps = [slow_fingerprint(r[1]) for r in rows]
    want = sorted((r[0] is None, r[0], f"{f:016x}", c)
                  for r, f, c in zip(rows, fps, components(fps, [r[0] for r in rows], 4)))
    assert sorted((r.doc_id is None, r.doc_id, r.fingerprint, r.component_id) for r in got) == want


def test_brute_force_and_edge_cases(spark):
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (4, "one"), (None, "one"), (None, "lonely words here ok"),
            (5, "One"), (6, "a b c d"), (7, "long " * 20000)]
    for g in range(12):
        base = rnd.choices(words, k=rnd.choice([30, 150, 300]))
        for _ in range(8):
            t = list(base)
            for _ in range(rnd.randrange(4)):
                t[rnd.randrange(len(t))] = rnd.choice(words)
            rows.append((100 + len(rows), " ".join(t)))
    check(spark, [(*r, "clash", 1) for r in rows])


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check(spark, [(r.doc_id, r.text, "x", 0) for r in docs.collect()])


def test_empty(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def planted(n, seed=0):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 63, n, dtype=np.uint64)
    out = [base]
    for _ in range(3):
        x = base.copy()
        for _ in range(5):
            x ^= np.uint64(1) << rng.integers(0, 64, n, dtype=np.uint64)
        out.append(x)
    return np.unique(np.concatenate(out))


def linked(spark, fps, **kw):
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    star = {r.u: r.v for r in stars(simhash.links(df, **kw)).collect()}
    return [star.get(x, x) for x in fps.view(np.int64).tolist()]


def brute(fps, threshold=4):
    i, j = np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= threshold)
    s = np.argsort(fps.view(np.int64), kind="stable")
    where = np.empty_like(s)
    where[s] = np.arange(len(s))
    return fps.view(np.int64)[s][local_roots(len(fps), where[i], where[j])][where].tolist()


def test_links_lose_none(spark):
    fps = planted(400)
    assert linked(spark, fps) == brute(fps)


def test_two_block_layout(spark):
    fps = planted(60)
    assert linked(spark, fps, layout=((31, 1), (31, 1))) == brute(fps)


def test_crowded_anchor_is_split(spark):
    """A dense ball: anchors fuller than a cell are compared on a grid."""
    rng = np.random.default_rng(3)
    x = np.full(1500, 0x0F0F0F0F12345678, np.uint64)
    for _ in range(3):
        x ^= np.uint64(1) << rng.integers(0, 64, len(x), dtype=np.uint64)
    fps = np.unique(np.concatenate([x, planted(50, 9)]))
    assert linked(spark, fps, cell=16) == brute(fps)


@settings(max_examples=100, deadline=None)
@given(st.integers(0, (1 << 21) - 1), st.integers(0, 20))
def test_covering(value, flip):
    """Any two block values within one bit share an anchor; homes lie within one."""
    b = simhash.Block(0, 15, 6, 1)
    x, y = np.array([value], np.uint64), np.array([value ^ (1 << flip)], np.uint64)
    home = b.home(x)
    assert np.bitwise_count(home ^ x)[0] <= 1 and b.home(home)[0] == home[0]
    reach = b.reach(y)[1]
    assert home[0] in reach and (np.bitwise_count(reach ^ y) <= 2).all()


def test_chain_of_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (501, 501)], "u long, v long")
    got = {(r.u, r.v) for r in stars(edges).collect()}
    assert got == {(i, 0) for i in range(1, 201)} | {(501, 500)}
