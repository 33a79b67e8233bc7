"""Packing by Karmarkar-Karp multiway differencing.

Documents are tokenised and cut into pieces; a run of pieces worth about
``windows`` windows is differenced into that many near-equal windows.  Every
task packs the rows it already holds, block by block, so nothing is shuffled,
memory is one block plus the longest text, and a lost task is simply redone.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import arrow_schema
from tessera.llm.tokens import encode


def difference(sizes: np.ndarray, k: int) -> list[list[int]]:
    """Split items into ``k`` groups of near-equal total size.

    Items in falling order form partial partitions of ``k`` one-item groups.
    The two partitions of the largest spread (largest less smallest group) are
    merged again and again, the largest group of one with the smallest of the
    other, until one is left.  Ties go to the older partition.
    """
    order = np.argsort(-sizes, kind="stable")
    rows = max(1, -(-len(sizes) // k))
    sums = np.zeros(rows * k, np.int64)
    sums[:len(sizes)] = sizes[order]
    sums = sums.reshape(rows, k)
    # members[p][g]: the item of each merged row that stands in group g
    index = np.full(rows * k, -1, np.int64)
    index[:len(sizes)] = order
    index = index.reshape(rows, 1, k)
    parts = {i: (sums[i], index[i]) for i in range(rows)}
    heap = [(int(s[-1] - s[0]), i) for i, (s, _) in parts.items()]
    heapq.heapify(heap)
    new = rows
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        (sa, ia), (sb, ib) = parts.pop(a), parts.pop(b)
        total = sa + sb[::-1]
        by = np.argsort(-total, kind="stable")
        total = total[by]
        parts[new] = (total, np.concatenate([ia, ib[:, ::-1]])[:, by])
        heapq.heappush(heap, (int(total[-1] - total[0]), new))
        new += 1
    (_, members), = parts.values()
    return [[i for i in col if i >= 0] for col in members.T.tolist()]


def windows_for(sizes: np.ndarray, capacity: int, slack: int) -> list[list[int]]:
    """Near-equal windows of at most ``capacity``: the count starts at the
    total over capacity less slack and rises until no window is exceeded."""
    k = max(1, -(-int(sizes.sum()) // (capacity - slack)))
    while True:
        groups = difference(sizes, k)
        if max(int(sizes[g].sum()) for g in groups) <= capacity:
            return [g for g in groups if g]
        k += 1


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
         capacity: int = 1024, windows: int = 128, grain: int = 128, slack: int = 8,
         end_id: int | None = 0, tokenizer_path: str | None = None) -> DataFrame:
    """Pieces of all documents, packed into windows of at most ``capacity`` ids.

    Returns per piece: ``doc_id``, ``start`` (its document's ids before it),
    ``length``, ``ids`` (binary, little-endian unsigned 32 bit), ``doc_tokens``
    (the document's ids, the end id included), ``sequence_id`` and ``offset``
    (ids before it in the sequence, gapless from 0).

    Each run of ``capacity`` ids of a document fills a window of its own.  What
    is left of it is cut into pieces of ``grain`` ids and differenced with that
    of other documents; neighbouring pieces that meet in one window are joined
    again.  Blocks hold ``windows`` windows filled to ``capacity - slack`` on
    average (the slack is the spread that differencing leaves), so padding is
    slack / capacity, under one window more at the end of each task.

    A special token's string in a text is that token, as the vocabulary's own
    tokenizer reads it.  Null and empty texts consist of their end id (of
    nothing, and so give no row, if ``end_id`` is None).  Repeated rows and null ids are packed like
    any other row.  An empty table gives no rows.  ``sequence_id`` is unique,
    not dense: the task's number in the high bits.
    """
    src = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([
        src.schema["doc_id"], T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType()),
        T.StructField("doc_tokens", T.LongType()), T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType())])
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 40
        made = 0                                   # sequences so far
        rows: list[tuple] = []
        block: list[tuple] = []                    # (doc, start, ids, doc tokens)
        held = 0
        full = windows * (capacity - slack)

        def flush() -> None:
            nonlocal made
            sizes = np.array([len(p[2]) for p in block], np.int64)
            for group in windows_for(sizes, capacity, slack):
                at, last = 0, None
                for i in sorted(group):            # block order: a document's pieces adjoin
                    doc, start, ids, n = block[i]
                    if last is not None and last[0] == block_doc[i] and last[1] == start:
                        d, s, old, _, m = rows.pop()[:5]
                        rows.append((d, s, old + len(ids), last[2] + ids.tobytes(), m,
                                     base + made, at - old))
                        last = (block_doc[i], start + len(ids), rows[-1][3])
                    else:
                        rows.append((doc, start, len(ids), ids.tobytes(), n, base + made, at))
                        last = (block_doc[i], start + len(ids), rows[-1][3])
                    at += len(ids)
                made += 1

        def emit() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)
            rows.clear()
            return out

        block_doc: list[int] = []                  # which document of the task a piece is of
        seen = 0
        for batch in batches:
            docs = batch.column(0).to_pylist()
            texts = batch.column(1)
            for r, doc in enumerate(docs):
                ids = encode(texts[r].as_py(), end_id, tokenizer_path, special=True)
                n, seen = len(ids), seen + 1
                whole = n - n % capacity
                for s in range(0, whole, capacity):
                    rows.append((doc, s, capacity, ids[s:s + capacity].tobytes(), n,
                                 base + made, 0))
                    made += 1
                s = whole
                while s < n:
                    e = min(s + grain, n, s + full - held)
                    block.append((doc, s, ids[s:e], n))
                    block_doc.append(seen)
                    held += e - s
                    s = e
                    if held == full:
                        flush()
                        block, block_doc, held = [], [], 0
                if len(rows) >= 4096:
                    yield emit()
        if block:
            flush()
        if rows:
            yield emit()

    return src.mapInArrow(run, schema)
