"""Packed id matrices by best-fit decreasing.

The bins of a block are found through a segment tree over remaining
capacities: leaf c counts the open bins with c ids left, and the smallest
occupied leaf at or above a piece's size is the best fit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import arrow_schema
from tessera.llm.tokens import encode


class CapacityTree:
    """Open bins by remaining capacity, searched for the smallest that fits."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, bin_: int) -> None:
        self.bins[room].append(bin_)
        i = room + self.leaves
        while i:
            self.count[i] += 1
            i >>= 1

    def take(self, size: int) -> tuple[int, int] | None:
        """Remove and return (room, bin) of the tightest bin with room for
        ``size``; None if there is none.  Of equals, the one added last."""
        count, i = self.count, size + self.leaves
        if not count[i]:
            while i > 1 and (i & 1 or not count[i + 1]):   # up to a subtree on the right
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.leaves:                         # down to its smallest leaf
                i = 2 * i if count[2 * i] else 2 * i + 1
        room = i - self.leaves
        while i:
            count[i] -= 1
            i >>= 1
        return room, self.bins[room].pop()


def best_fit_decreasing(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins (lists of item numbers) of items of 1 to ``capacity``; ties go to
    the earlier item."""
    tree, bins = CapacityTree(capacity), []
    for item in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        found = tree.take(sizes[item])
        if found is None:
            bins.append([])
            found = capacity, len(bins) - 1
        room, b = found
        bins[b].append(item)
        if room > sizes[item]:
            tree.add(room - sizes[item], b)
    return bins


def pack_matrices(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                  capacity: int = 1024, block_pieces: int = 8192, end_id: int = 50256,
                  pad_id: int = 50256, tokenizer_path: str | None = None) -> DataFrame:
    """Rows of packed id matrices.

    Returns per sequence: ``sequence_id``; ``input_ids`` (binary: ``capacity``
    little-endian unsigned 32-bit ids, padded with ``pad_id``); ``n_tokens``
    (ids before the padding); ``cu_seqlens`` (0, then the running segment
    lengths); ``position_ids`` (binary as ``input_ids``: counts from 0 anew in
    every segment, and over the padding); ``doc_ids`` and ``starts`` (each
    segment's document and how many of its ids lie before the segment).

    A document is its ids and ``end_id``.  Runs of ``capacity`` ids of an
    overlong document are rows of their own; what is left is packed whole,
    best-fit decreasing, within blocks of ``block_pieces`` documents of a
    task: memory is at most block_pieces * capacity ids and the longest text,
    and nothing is shuffled.  Concatenating a document's segments by start
    gives its ids again.

    Null and empty texts consist of the end id; repeated rows and null ids are
    packed like any other row; an empty table gives no rows.  ``sequence_id``
    is unique, not dense.
    """
    src = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([
        T.StructField("sequence_id", T.LongType()), T.StructField("input_ids", T.BinaryType()),
        T.StructField("n_tokens", T.IntegerType()),
        T.StructField("cu_seqlens", T.ArrayType(T.IntegerType())),
        T.StructField("position_ids", T.BinaryType()),
        T.StructField("doc_ids", T.ArrayType(src.schema["doc_id"].dataType)),
        T.StructField("starts", T.ArrayType(T.LongType()))])
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 40
        made = 0
        rows: list[tuple] = []
        block: list[tuple] = []                    # (doc, start, ids)
        one = np.arange(capacity, dtype=np.uint32).tobytes()

        def add(pieces: list[tuple]) -> None:
            nonlocal made
            lengths = [len(p[2]) for p in pieces]
            ends = np.cumsum([0, *lengths])
            n = int(ends[-1])
            if len(pieces) == 1 and n == capacity:
                ids, positions = pieces[0][2], one
            else:
                ids = np.full(capacity, pad_id, np.uint32)
                ids[:n] = np.concatenate([p[2] for p in pieces])
                bounds = np.append(ends, capacity) if n < capacity else ends
                positions = (np.arange(capacity, dtype=np.uint32) - np.repeat(
                    bounds[:-1], np.diff(bounds)).astype(np.uint32)).tobytes()
            rows.append((base + made, ids.tobytes(), n, ends.tolist(), positions,
                         [p[0] for p in pieces], [p[1] for p in pieces]))
            made += 1

        def flush() -> None:
            for members in best_fit_decreasing([len(p[2]) for p in block], capacity):
                add([block[i] for i in members])
            block.clear()

        def emit() -> Iterator[pa.RecordBatch]:
            for i in range(0, len(rows), 2048):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows[i:i + 2048]), arrow)],
                    schema=arrow)
            rows.clear()

        for batch in batches:
            docs = batch.column(0).to_pylist()
            texts = batch.column(1)
            for r, doc in enumerate(docs):
                ids = encode(texts[r].as_py(), end_id, tokenizer_path)
                whole = len(ids) - len(ids) % capacity
                for s in range(0, whole, capacity):
                    add([(doc, s, ids[s:s + capacity])])
                if whole < len(ids):
                    block.append((doc, whole, ids[whole:].copy()))
                if len(block) >= block_pieces:
                    flush()
                if len(rows) >= 2048:
                    yield from emit()
        flush()
        yield from emit()

    return src.mapInArrow(run, schema)
