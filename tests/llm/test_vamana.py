"""Graph search against exact search."""

import numpy as np
import pytest

from tessera.llm import vamana
from tests.conftest import SF01


def exact(ids, v, k, every):
    out = {}
    for i, x in zip(ids, v):
        if i % every == 0:
            s = v @ x
            out[i] = sorted(((-s[j], c) for j, c in enumerate(ids) if c != i))[:k]
    return out


def recall(got, want):
    hit = sum(len({r.vec_id for r in got if r.query_id == q} & {c for _, c in w}) for q, w in want.items())
    return hit / sum(len(w) for w in want.values())


def test_recall_and_scores(spark):
    df = spark.read.parquet(f"{SF01}/embeddings.parquet")
    rows = df.collect()
    ids, v = [r.vec_id for r in rows], np.array([r.embedding for r in rows], float)
    got = vamana.search(df, shard_rows=200).collect()
    want = exact(ids, v, 20, 20)
    assert recall(got, want) >= 0.95
    at = dict(zip(ids, v))
    for r in got:
        assert abs(r.score - at[r.query_id] @ at[r.vec_id]) < 1e-12 and r.vec_id != r.query_id
    for q in want:
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 21))
        assert mine == sorted(mine, key=lambda r: (-r.score, r.vec_id))


def test_norms_that_differ(spark):
    rng = np.random.default_rng(0)
    v = rng.normal(size=(600, 8)) * rng.lognormal(0, 1, (600, 1))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    assert recall(vamana.search(df).collect(), exact(list(range(600)), v, 20, 20)) >= 0.9


@pytest.mark.parametrize("kind", ["equal", "lognormal", "outlier", "huge"])
def test_recall_over_a_full_shard(spark, kind):
    """10,000 points, as many as a shard has: unit vectors about 200 centres,
    of equal or very unequal norms, or with one vector of another size."""
    rng = np.random.default_rng(1)
    v = rng.normal(size=(200, 32))[rng.integers(0, 200, 10_000)] + 0.7 * rng.normal(size=(10_000, 32))
    v /= np.sqrt((v ** 2).sum(axis=1, keepdims=True))
    if kind == "lognormal":
        v *= rng.lognormal(0, 1, (10_000, 1))
    elif kind != "equal":
        v[77] *= 1e4 if kind == "outlier" else 1e160
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    got = vamana.search(df.repartition(4), every=50).collect()
    assert recall(got, exact(list(range(10_000)), v, 20, 50)) >= 0.9


def test_beam_widens_where_the_graph_is_hard():
    rng = np.random.default_rng(2)
    v = rng.normal(size=(3000, 64))
    x = vamana.euclidean(v)
    graph, start = vamana.build(x)
    beam = vamana.measured_width(x, v, graph, start, 20, 32)
    assert beam > 32
    q = vamana.units(v[5::60])
    found, _ = vamana.beam_search(x, graph, start, np.column_stack([q, np.zeros(len(q))]).astype(np.float32), beam)
    want = np.argsort(-(q @ v.T), axis=1)[:, :20]
    assert np.mean([len(set(a) & set(b)) / 20 for a, b in zip(found.tolist(), want.tolist())]) >= 0.9


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [1.0, 0.0]), (20, [1.0, 0.0]), (21, [0.5, 0.5]), (22, None), (40, []),
            (60, [0.0, 0.0]), (80, [nan, 1.0]), (100, [None, 1.0]), (120, [inf, 1.0]), (None, [1.0, 1.0]),
            (140, [1.0, 2.0, 3.0]), (7, [-1.0, 0.0])]
    df = spark.createDataFrame([(*r, 5) for r in rows], "vec_id long, embedding array<double>, rank int")
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in vamana.search(df, k=3).collect()}
    assert got == {(0, 1): (20, 1.0), (0, 2): (21, 0.5), (0, 3): (7, -1.0),
                   (20, 1): (0, 1.0), (20, 2): (21, 0.5), (20, 3): (7, -1.0)}
    assert vamana.search(spark.createDataFrame([], df.schema)).count() == 0


def test_very_common_vector(spark):
    rng = np.random.default_rng(4)
    v = rng.normal(size=(400, 16))
    v[:150] = v[0]
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    got = vamana.search(df).collect()
    assert [r.vec_id for r in sorted((r for r in got if r.query_id == 40), key=lambda r: r["rank"])] == list(range(20))
    assert recall(got, exact(list(range(400)), v, 20, 20)) >= 0.9


def test_pruning_keeps_diverse_edges():
    x = np.array([[0, 0], [1, 0], [1.1, 0], [0, 2], [0, 2.1]], np.float32)
    out = vamana.prune(x, np.array([0]), np.array([[1, 2, 3, 4, 0, -1]]), 4, 1.2)
    assert out.tolist() == [[1, 3, -1, -1]]


def test_a_crowd_of_near_copies_is_reached():
    rng = np.random.default_rng(5)
    v = rng.normal(size=(2500, 64))
    v[:400] = v[0] + 0.02 * rng.normal(size=(400, 64))
    x = vamana.euclidean(v)
    graph, medoid = vamana.build(x)
    seen, front = np.zeros(len(x), bool), np.array([medoid])
    while len(front):
        seen[front] = True
        front = np.unique(graph[front])
        front = front[(front >= 0) & ~seen[front]]
    assert seen.all()
