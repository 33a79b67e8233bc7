"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import keep


def _mark(e: DataFrame) -> tuple:
    h = F.xxhash64("u", "v")
    return tuple(e.agg(F.count("*"), F.bit_xor(h), F.sum(h % 1_000_003)).first())


def stars(edges: DataFrame) -> DataFrame:
    """(u, v): every node u of ``edges`` (columns u, v) that isn't the smallest
    of its component, with that smallest node v.

    Each round hangs a node's larger neighbours, then its smaller ones, on the
    smallest; rounds grow with the logarithm of the component's size.  The
    minima are partial aggregates and the joins are splittable, so a node with
    very many neighbours is no single task's work.
    """
    e = keep(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
             .where("u != v").distinct())
    mark = _mark(e)
    while mark[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Kept, so that AQE may split a joined node that has very many neighbours.
        low = keep(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = (both.where("v > u").join(low, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = keep(large)
        least = keep(large.groupBy("u").agg(F.min("v").alias("m")))
        small = (large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        e = keep(small)
        before, mark = mark, _mark(e)
        if mark == before:
            break
    return e


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest node of each node's component, over nodes 0..n-1 and the
    links a[i] - b[i]."""
    root = np.arange(n)
    while len(a):
        ra, rb = root[a], root[b]
        open_ = ra != rb
        if not open_.any():
            break
        a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    return root
