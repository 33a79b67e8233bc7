"""Sort, pagination and top-k (K1-K6).

Ordering is always total: callers give a unique tie-break, and NULLs sort
last in both directions (explicit ``*_nulls_last``), so pages and top-k rows
are reproducible across runs and engines.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import scratch_path

_CLAUSE = re.compile(r"^\s*(?P<col>.+?)(?:\s+(?P<dir>asc|desc))?\s*$", re.IGNORECASE)


def sort_key(spec) -> Column:
    """``"price DESC"`` / ``("price", "desc")`` / Column -> Column, NULLS LAST."""
    if isinstance(spec, Column):
        return spec
    if isinstance(spec, tuple):
        name, direction = spec
    else:
        m = _CLAUSE.match(spec)
        name, direction = m.group("col"), (m.group("dir") or "asc")
    c = F.col(name)
    return c.desc_nulls_last() if direction.lower() == "desc" else c.asc_nulls_last()


def order_by(df: DataFrame, *specs) -> DataFrame:          # K1 / K3
    return df.orderBy(*[sort_key(s) for s in specs])


def page(df: DataFrame, order, limit: int | None = 100, offset: int = 0) -> DataFrame:   # K2
    """LIMIT/OFFSET over a total order (``limit=None``: all rows after the offset).

    Plans as one TakeOrderedAndProject (each task keeps its best
    ``offset + limit`` rows).  For deep pages use ``page_after``.
    """
    out = df.orderBy(*[sort_key(s) for s in order])
    if offset:
        out = out.offset(int(offset))
    return out if limit is None else out.limit(int(limit))


class RankIndex:
    """K2 for any offset: rows written in ranges of a total order, with their
    counts, so that a page reads the ranges that hold it and no other."""

    def __init__(self, df: DataFrame, order, path: str | None = None, rows: int = 100_000):
        """Write ``df`` in ranges of about ``rows`` rows to ``path`` (by default
        the scratch folder).  The driver keeps a count per range."""
        self._order = [sort_key(s) for s in order]
        self._path = path or scratch_path(df.sparkSession, "rank-index")
        self._columns = df.columns
        parts = max(1, -(-df.count() // rows))
        (df.repartitionByRange(parts, *self._order).withColumn("_range", F.spark_partition_id())
         .sortWithinPartitions(*self._order).write.partitionBy("_range").parquet(self._path))
        self._rows = df.sparkSession.read.parquet(self._path)
        counts = self._rows.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).collect()
        self.counts = sorted((r["_range"], r["n"]) for r in counts)

    def page(self, offset: int, limit: int) -> DataFrame:
        """``limit`` rows after the first ``offset``, in order."""
        held, before, start = [], 0, 0
        for part, n in self.counts:
            if before + n > offset and before < offset + limit:
                start = start if held else before
                held.append(part)
            before += n
        rows = self._rows.where(F.col("_range").isin(held) if held else F.lit(False))
        return rows.orderBy(*self._order).offset(max(0, offset - start)).limit(limit).select(*self._columns)


def page_after(df: DataFrame, keys: list[str], after: tuple | None, limit: int = 100) -> DataFrame:
    """Keyset pagination: rows strictly after ``after`` in ascending ``keys``
    order, NULLs last (``after`` may hold None for a NULL key).  Cost does not
    grow with the page number."""
    out = df
    if after is not None:
        cond = None
        for i in reversed(range(len(keys))):
            if after[i] is None:                       # nothing sorts after NULL
                continue
            here = (F.col(keys[i]) > F.lit(after[i])) | F.col(keys[i]).isNull()
            for j in range(i):
                same = F.col(keys[j]).isNull() if after[j] is None else F.col(keys[j]) == F.lit(after[j])
                here = same & here
            cond = here if cond is None else (cond | here)
        out = out.where(F.lit(False) if cond is None else cond)
    return out.orderBy(*[F.col(k).asc_nulls_last() for k in keys]).limit(int(limit))


def top_n(df: DataFrame, order, n: int) -> DataFrame:      # K4 single group
    return df.orderBy(*[sort_key(s) for s in order]).limit(int(n))


def top_n_per_group(df: DataFrame, group, order, n: int, rank_col: str | None = "rank") -> DataFrame:
    """K4 for every group at once: ``row_number() <= n`` per group.

    Spark plans this as a WindowGroupLimit: every map task keeps only its best
    ``n`` rows per group before the shuffle, so a hot group ships at most
    ``n`` rows per task instead of all of its rows.
    """
    group = [group] if isinstance(group, str) else list(group)
    w = Window.partitionBy(*group).orderBy(*[sort_key(s) for s in order])
    name = rank_col or "_rank"
    out = df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= F.lit(int(n)))
    return out if rank_col else out.drop(name)


def point_lookup(df: DataFrame, key: str, value) -> DataFrame:   # K6
    return df.where(F.col(key) == F.lit(value)).limit(1)


def bulk_lookup(df: DataFrame, key: str, keys: DataFrame, keys_col: str | None = None) -> DataFrame:
    """K6 for many keys: a join against a key table (no IN-list on the driver)."""
    k = keys_col or keys.columns[0]
    return df.join(keys.select(F.col(k).alias(key)).distinct(), key, "inner")
