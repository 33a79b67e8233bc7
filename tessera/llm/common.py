"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import checkpoint_dir, table_path

#: Texts are worked on in slices of about so many characters (one text at
#: least), so that a task's memory follows its longest text, not its batch.
SLICE_CHARS = 2_000_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def keep(df: DataFrame) -> DataFrame:
    """Cut the lineage: write ``df`` once to the shared checkpoint folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def fold(id_col: str | Column, n: int) -> Column:
    """crc32 of the id's text modulo ``n`` (null for a null id)."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(c.cast("string").cast("binary")) % n


def slices(texts: list) -> Iterator[tuple[int, int]]:
    """(start, end) runs of ``texts`` holding about SLICE_CHARS characters."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= SLICE_CHARS:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def map_texts(df: DataFrame, text_col: str, keep_cols: dict[str, str | Column],
              fields: list[T.StructField],
              work: Callable[[list], dict[str, object]]) -> DataFrame:
    """One row per row of ``df``: the columns ``keep_cols`` and what ``work``
    makes of the texts (a list of str or None in, arrays by field name out)."""
    src = df.select(*[(F.col(c) if isinstance(c, str) else c).alias(n)
                      for n, c in keep_cols.items()],
                    F.col(text_col).cast("string").alias("__text"))
    kept = list(keep_cols)
    schema = T.StructType([src.schema[n] for n in kept] + fields)
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("__text").to_pylist()
            for i, j in slices(texts):
                out = work(texts[i:j])
                part = b.slice(i, j - i)
                cols = [part.column(n).cast(arrow.field(n).type) for n in kept]
                cols += [pa.array(out[f.name], arrow.field(f.name).type) for f in fields]
                yield pa.RecordBatch.from_arrays(cols, schema=arrow)

    return src.mapInArrow(run, schema)


def filter_texts(df: DataFrame, text_col: str,
                 keeps: Callable[[list], np.ndarray]) -> DataFrame:
    """The rows of ``df``, all columns, whose text ``keeps`` marks True."""
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(at).to_pylist()
            for i, j in slices(texts):
                yield b.slice(i, j - i).filter(pa.array(np.asarray(keeps(texts[i:j]), bool)))

    return df.mapInArrow(run, df.schema)


def arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)


def hashed_sample(df: DataFrame, key: str | Column, n: int) -> DataFrame:
    """At most ``n`` rows, the same ones whatever the partitioning: those with
    the smallest hash of ``key``."""
    k = F.col(key) if isinstance(key, str) else key
    return df.orderBy(F.xxhash64(k.cast("string")), k).limit(n)


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, n: int,
                    learn: Column, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, text, y): documents of a bounded sample of the labelled ids.

    Per label value (0 and 1), the at most ``n`` ids with the smallest hash
    among those ``learn`` allows.  An id with several label rows counts with
    its largest label; null ids and labels are left out.  The id list, at most
    2n rows, is what is broadcast; of an id with several texts the smallest
    counts, so there are at most 2n documents.
    """
    ids = (labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull())
           .groupBy(F.col(id_col).alias("__id")).agg(F.max(label).cast("int").alias("y"))
           .where(learn))
    picked = None
    for v in (0, 1):
        part = hashed_sample(ids.where(F.col("y") == v), "__id", n)
        picked = part if picked is None else picked.unionByName(part)
    docs = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return (docs.join(F.broadcast(picked), F.col("doc_id") == F.col("__id"))
            .groupBy("doc_id", "y").agg(F.min(F.col("text").cast("string")).alias("text"))
            .select("doc_id", "text", "y"))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))
