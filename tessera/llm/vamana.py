"""Approximate nearest neighbours (largest inner product) on a robust-pruned
directed graph.

Vectors are dealt into bands of norms within a factor of two, and at random
into shards of bounded size, so that a few long vectors don't crowd the others
of a shard together.  A task builds its shard's graph: points enter in growing batches, a greedy beam search from the
medoid proposes neighbours, and relaxed distance pruning keeps a nearest
candidate only if no neighbour kept before is closer to it by the factor
``alpha``, which leaves edges in many directions.  Points that no walk from the
medoid reaches get an edge from a near one.  It then searches some of its own points
and widens the beam until they find nearly all that an exact search finds.
Queries, in blocks, are beam searched in every shard at its width, and the
shards' findings are merged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import keep


#: Queries searched side by side hold so many places of beams together at most.
SLICE = 100_000


def beam_search(x: np.ndarray, graph: np.ndarray, start: int, queries: np.ndarray, width: int,
                step: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """(ids, squared distances) of the ``width`` nearest points that a greedy
    search finds per query, nearest first; -1 and inf where there are fewer.
    Each round expands the ``step`` nearest points not yet expanded."""
    n = len(queries)
    ids = np.full((n, width), -1, np.int64)
    dist = np.full((n, width), np.inf, np.float32)
    done = np.ones((n, width), bool)
    seen = np.zeros((n, len(x)), bool)
    norms = np.einsum("ij,ij->i", x, x)
    ids[:, 0], done[:, 0], seen[:, start] = start, False, True
    dist[:, 0] = ((queries - x[start]) ** 2).sum(axis=1)
    live = np.arange(n)
    own = np.einsum("ij,ij->i", queries, queries)
    while len(live):
        todo = ~done[live]
        rank = np.cumsum(todo, axis=1)
        take = todo & (rank <= step)
        rows, cols = np.nonzero(take)
        done[live[rows], cols] = True
        # Up to step expanded points a query, their neighbours side by side.
        new = np.full((len(live), step, graph.shape[1]), -1, np.int64)
        new[rows, rank[rows, cols] - 1] = graph[ids[live[rows], cols]]
        new = np.sort(new.reshape(len(live), -1), axis=1)
        fresh = new >= 0
        fresh[:, 1:] &= new[:, 1:] != new[:, :-1]
        fresh &= ~seen[live[:, None], new]
        r, c = np.nonzero(fresh)
        p = new[r, c]
        seen[live[r], p] = True
        d = np.full(new.shape, np.inf, np.float32)
        d[r, c] = own[live[r]] + norms[p] - 2 * np.einsum("ij,ij->i", x[p], queries[live[r]])
        all_d = np.concatenate([dist[live], d], axis=1)
        best = np.argsort(all_d, axis=1, kind="stable")[:, :width]
        dist[live] = np.take_along_axis(all_d, best, 1)
        ids[live] = np.take_along_axis(np.concatenate([ids[live], new], axis=1), best, 1)
        done[live] = np.take_along_axis(np.concatenate(
            [done[live], np.zeros(new.shape, bool)], axis=1), best, 1)
        gone = ~np.isfinite(dist[live])
        ids[live] = np.where(gone, -1, ids[live])
        done[live] |= gone
        live = live[~done[live].all(axis=1)]
    return ids, dist


def prune(x: np.ndarray, points: np.ndarray, cand: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Out-neighbours (rows of at most ``degree``, -1 beyond) of ``points`` out
    of their candidate rows (-1 beyond; repeats and the point itself drop out)."""
    cand = np.sort(cand, axis=1)
    ok = (cand >= 0) & (cand != points[:, None])
    ok[:, 1:] &= cand[:, 1:] != cand[:, :-1]
    v = x[cand]
    norm = np.einsum("bkd,bkd->bk", v, v)
    d = norm + np.einsum("bd,bd->b", x[points], x[points])[:, None] \
        - 2 * np.einsum("bkd,bd->bk", v, x[points])
    d = np.where(ok, np.maximum(d, 0), np.inf)
    by = np.argsort(d, axis=1, kind="stable")
    cand, d, v, norm = (np.take_along_axis(cand, by, 1), np.take_along_axis(d, by, 1),
                        np.take_along_axis(v, by[..., None], 1), np.take_along_axis(norm, by, 1))
    between = norm[:, :, None] + norm[:, None, :] - 2 * (v @ v.transpose(0, 2, 1))
    alive = np.isfinite(d)
    out = np.full((len(points), degree), -1, np.int64)
    rows = np.arange(len(points))
    for k in range(degree):
        some = alive.any(axis=1)
        if not some.any():
            break
        first = alive.argmax(axis=1)
        out[some, k] = cand[rows, first][some]
        alive[rows, first] = False
        alive &= ~(alpha * alpha * between[rows, first] <= d)
    return out


def build(x: np.ndarray, degree: int = 32, width: int = 64, alpha: float = 1.2,
          batch: int = 512) -> tuple[np.ndarray, int]:
    """(graph, medoid): out-neighbours of every point, -1 beyond."""
    n = len(x)
    graph = np.full((n, degree), -1, np.int64)
    medoid = int(((x - x.mean(axis=0)) ** 2).sum(axis=1).argmin())
    order = np.random.default_rng(n).permutation(n)
    order = np.concatenate([[medoid], order[order != medoid]])
    at = 1
    while at < n:
        new = order[at:at + min(batch, at)]
        at += len(new)
        found, _ = beam_search(x, graph, medoid, x[new], width)
        graph[new] = prune(x, new, found, degree, alpha)
        # Edges back, pruned where a point has too many.
        to = graph[new].ravel()
        src = np.repeat(new, degree)[to >= 0]
        to = to[to >= 0]
        by = np.argsort(to, kind="stable")
        to, src = to[by], src[by]
        first = np.flatnonzero(np.append(True, to[1:] != to[:-1])) if len(to) else np.empty(0, int)
        rank = np.arange(len(to)) - np.repeat(first, np.diff(np.append(first, len(to))))
        for lo in range(0, int(rank.max()) + 1 if len(rank) else 0, degree):
            here = (rank >= lo) & (rank < lo + degree)
            points, row = np.unique(to[here], return_inverse=True)
            cand = np.full((len(points), 2 * degree), -1, np.int64)
            cand[:, :degree] = graph[points]
            cand[row, degree + rank[here] - lo] = src[here]
            for i in range(0, len(points), 1024):
                c = cand[i:i + 1024]
                full = (c >= 0).sum(axis=1) > degree
                p = points[i:i + 1024]
                graph[p[~full]] = -np.sort(-c[~full], axis=1)[:, :degree]
                if full.any():
                    graph[p[full]] = prune(x, p[full], c[full], degree, alpha)
    return connect(x, graph, medoid, width), medoid


def connect(x: np.ndarray, graph: np.ndarray, start: int, width: int, each: int = 8) -> np.ndarray:
    """``graph`` with edges added until every point is reached from ``start``:
    pruning may leave points, of crowds of near copies above all, without a way
    in, which no width of beam finds.  Points not reached hang on the nearest
    one that a search for them finds, up to ``each`` more a round."""
    reached = np.zeros(len(x), bool)

    def walk(front: np.ndarray) -> None:
        while len(front):
            reached[front] = True
            front = np.unique(graph[front])
            front = front[(front >= 0) & ~reached[front]]

    walk(np.array([start]))
    while not reached.all():
        lost = np.flatnonzero(~reached)[:512]
        to = beam_search(x, graph, start, x[lost], width)[0][:, 0]
        by = np.argsort(to, kind="stable")
        to, lost = to[by], lost[by]
        rank = np.arange(len(to)) - np.searchsorted(to, to)
        to, lost, rank = to[rank < each], lost[rank < each], rank[rank < each]
        at = (graph[to] >= 0).sum(axis=1) + rank
        if at.max() >= graph.shape[1]:
            graph = np.pad(graph, ((0, 0), (0, int(at.max()) + 1 - graph.shape[1])), constant_values=-1)
        graph[to, at] = lost
        walk(lost)
    return graph


def euclidean(v: np.ndarray) -> np.ndarray:
    """Points whose Euclidean order about (q, 0) is that of inner products with q."""
    norms = np.sqrt((v ** 2).sum(axis=1))
    top = norms.max()
    return np.column_stack([v / top, np.sqrt(np.maximum(0, 1 - (norms / top) ** 2))]).astype(np.float32)


def units(v: np.ndarray) -> np.ndarray:
    """Unit vectors, whatever the size of finite components."""
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v ** 2).sum(axis=1, keepdims=True))


def measured_width(x: np.ndarray, v: np.ndarray, graph: np.ndarray, start: int, k: int, width: int,
                   target: float = 0.97, asked: int = 64) -> int:
    """The beam width, doubled from ``width`` on, at which ``asked`` points of
    the shard find ``target`` of their ``k`` nearest."""
    q = units(v[np.linspace(0, len(v) - 1, min(asked, len(v))).astype(int)])
    k = min(k, len(v))
    want = np.argsort(-(q @ v.T), axis=1, kind="stable")[:, :k]
    flat = np.column_stack([q, np.zeros(len(q))]).astype(np.float32)
    while width < len(v):
        found, _ = beam_search(x, graph, start, flat, width)
        near = np.argsort(-np.where(found >= 0, np.einsum("qd,qcd->qc", q, v[found]), -np.inf), axis=1)[:, :k]
        near = np.take_along_axis(found, near, 1)
        if np.mean([len(np.intersect1d(a, b)) / k for a, b in zip(want, near)]) >= target:
            break
        width *= 2
    return min(width, max(len(v), 1))


def band() -> "F.Column":
    """The power of two at or below the norm of ``v``."""
    top = F.array_max(F.transform("v", F.abs))
    parts = F.aggregate("v", F.lit(0.0), lambda s, e: s + F.pow(e / top, F.lit(2.0)))
    return F.floor(F.log2(top) + F.log2(parts) / 2).cast("int")


def valid(vectors: str) -> "F.Column":
    """Neither null nor empty nor zero, all components finite."""
    c = F.col(vectors)
    bad = F.exists(c, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    return c.isNotNull() & (F.size(c) > 0) & ~F.coalesce(bad, F.lit(True)) & F.exists(c, lambda e: e != 0)


def search(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", *, k: int = 20,
           every: int = 20, shard_rows: int = 10_000, block_rows: int = 4096, degree: int = 32,
           width: int = 96, alpha: float = 1.2) -> DataFrame:
    """(query_id, rank, vec_id, score): of every vector whose id is divisible by
    ``every`` the ``k`` nearest found by inner product, nearest first, ties to
    the smaller id; ``score`` is the inner product in double precision.

    Vectors that are null, empty or zero, or hold null or non-finite components,
    and rows without an id take no part; vectors of another length are no
    candidates.  Equal vectors are one point of the index, from which the k + 1
    smallest ids are read back (no more can be among the k nearest); a row
    repeated with its id counts once.  An empty table gives no rows.

    A shard holds at most about ``shard_rows`` points, whatever the table's
    size, of norms within a factor of two; each block of queries meets each
    shard in one task.  ``width`` is the beam's width to begin with.
    """
    rows = (df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
            .where(F.col("id").isNotNull()).where(valid("v"))
            .select("id", F.transform("v", lambda e: e.cast("double") + F.lit(0.0)).alias("v")))
    same = Window.partitionBy("v")
    ids = (rows.distinct().withColumn("n", F.row_number().over(same.orderBy("id")))
           .where(F.col("n") <= k + 1).withColumn("point", F.min("id").over(same)))
    ids = keep(ids)
    points = ids.where("n = 1").select("id", "v", F.size("v").alias("dim"))
    # A query is any of its vector's ids, so queries come from the table itself.
    queries = rows.where(F.col("id") % every == 0).distinct().withColumn("dim", F.size("v"))
    points = points.withColumn("band", band())
    # A few dimensions, and no more bands than a double has exponents.
    shards: dict[int, dict[int, int]] = {}
    for r in points.groupBy("dim", "band").agg(F.count("*").alias("n")).collect():
        shards.setdefault(r["dim"], {})[r["band"]] = -(-r["n"] // shard_rows)
    asked = {r["dim"]: -(-r["n"] // block_rows) for r in
             queries.groupBy("dim").agg(F.count("*").alias("n")).collect()}

    def by_dim(values: dict) -> F.Column:
        return F.create_map(*[F.lit(x) for kv in sorted((values or {0: 1}).items()) for x in kv])[F.col("dim")]

    of_band = F.create_map(*[F.lit(x) for d, bands in sorted(shards.items()) for e, n in sorted(bands.items())
                             for x in (f"{d}|{e}", n)] or [F.lit(""), F.lit(1)])
    dealt = points.withColumn("shard", F.pmod(F.xxhash64("id"), of_band[F.concat_ws("|", "dim", "band")]).cast("int"))

    def scaled(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """The vectors, and those over their band's power of two."""
        v = np.array(t["v"].combine_chunks().flatten()).reshape(len(t), -1)
        return v, np.ldexp(v, -t["band"][0].as_py())

    def make(t: pa.Table) -> pa.Table:
        t = t.sort_by("id")
        _, v = scaled(t)
        x = euclidean(v)
        graph, medoid = build(x, degree, min(width, 64), alpha)
        beam = measured_width(x, v, graph, medoid, k, max(width, k + 1))
        return pa.table({"dim": t["dim"], "band": t["band"], "shard": t["shard"],
                         "pos": pa.array(np.arange(len(t)), pa.int32()),
                         "id": t["id"], "v": t["v"], "first": pa.array(np.arange(len(t)) == medoid),
                         "beam": pa.array(np.full(len(t), beam), pa.int32()),
                         "near": pa.array([g[g >= 0].tolist() for g in graph], pa.list_(pa.int32()))})

    index = keep(dealt.groupBy("dim", "band", "shard").applyInArrow(
        make, "dim int, band int, shard int, pos int, id long, v array<double>, first boolean, beam int, near array<int>"))

    def find(q: pa.Table, t: pa.Table) -> pa.Table:
        if not len(q) or not len(t):
            return pa.table({"query_id": pa.array([], pa.int64()), "point": pa.array([], pa.int64()),
                             "score": pa.array([], pa.float64())})
        t = t.sort_by("pos")
        v, near_one = scaled(t)
        qv = np.array(q["v"].combine_chunks().flatten()).reshape(len(q), -1)
        lists = t["near"].to_pylist()
        graph = np.full((len(t), max(map(len, lists)) or 1), -1, np.int64)
        for i, near in enumerate(lists):
            graph[i, :len(near)] = near
        start = int(np.argmax(t["first"].to_numpy()))
        flat = np.column_stack([units(qv), np.zeros(len(qv))]).astype(np.float32)
        x, beam = euclidean(near_one), t["beam"][0].as_py()
        pid, qid = t["id"].to_numpy(), q["id"].to_numpy()
        out = []
        beam = max(beam, k + 1)
        some = max(16, min(512, SLICE // beam))
        for i in range(0, len(flat), some):
            found, _ = beam_search(x, graph, start, flat[i:i + some], beam)
            r, c = np.nonzero(found >= 0)
            p = found[r, c]
            score = np.einsum("ij,ij->i", v[p], qv[i + r])
            by = np.lexsort([pid[p], -score, r])
            r, p, score = r[by], p[by], score[by]
            place = np.arange(len(r)) - np.searchsorted(r, r)
            best = place <= k
            out.append((qid[i + r[best]], pid[p[best]], score[best]))
        return pa.table({n: pa.array(np.concatenate([o[i] for o in out]))
                         for i, n in enumerate(("query_id", "point", "score"))})

    bands = F.create_map(*[x for d, of in sorted(shards.items()) for x in (F.lit(d), F.array(*[
        F.struct(F.lit(e).alias("band"), F.lit(n).alias("n")) for e, n in sorted(of.items())]))] or
        [F.lit(0), F.array(F.struct(F.lit(0).alias("band"), F.lit(1).alias("n")))])
    sent = (queries.where(F.col("dim").isin(list(shards)))
            .withColumn("block", F.pmod(F.xxhash64("id"), by_dim(asked)).cast("int"))
            .withColumn("b", F.explode(bands[F.col("dim")]))
            .select("*", F.col("b.band").alias("band"), F.explode(F.sequence(F.lit(0), F.col("b.n") - 1)).alias("shard"))
            .drop("b"))
    met = index.where(F.col("dim").isin(list(asked))).withColumn(
        "block", F.explode(F.sequence(F.lit(0), by_dim(asked) - 1)))
    keys = ["dim", "band", "shard", "block"]
    found = (sent.groupBy(*keys).cogroup(met.groupBy(*keys))
             .applyInArrow(find, "query_id long, point long, score double"))
    per_query = Window.partitionBy("query_id")
    near = (found.withColumn("n", F.row_number().over(per_query.orderBy(F.desc("score"), "point")))
            .where(F.col("n") <= k + 1).drop("n"))
    named = near.join(ids.select("point", F.col("id").alias("vec_id")), "point")
    return (named.where("vec_id != query_id")
            .withColumn("rank", F.row_number().over(per_query.orderBy(F.desc("score"), "vec_id")))
            .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
