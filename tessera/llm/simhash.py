"""SimHash near-duplicate detection by covering anchor points.

The 64 bits are cut into blocks.  Of two fingerprints at most ``threshold``
bits apart, some block differs in at most t = threshold // blocks bits.  Each
block has a covering code (a Hamming code, radius 1, beside bits taken as they
are) whose words are the anchors: a fingerprint's home is the anchor of its
block, and it is replicated to every anchor that is the home of a point within
t, none further than the covering radius plus t.  So any linked pair meets at
a home of the one, where it is compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import arrow_schema, keep, map_texts
from tessera.llm.components import local_roots, stars
from tessera.operators.sampling import salted_join

#: (Hamming code length, bits taken as they are) of each block; 64 bits in all.
LAYOUT = ((15, 6), (15, 6), (15, 7))
#: Homes that meet at one anchor in one task; a fuller anchor is split in a grid.
CELL = 2048


def fingerprint(text: str | None, width: int = 4) -> int:
    """64-bit fingerprint of the lower-cased (A-Z) words' ``width``-shingles."""
    words = (text or "").encode().lower().split()    # bytes split at \\x20 \\x09-\\x0D only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    n = max(1, len(words) - width + 1)
    starts = [0, *ends[:n - 1].tolist()]
    stops = (ends[-1:] if len(words) < width else ends[width - 1:]) - 1
    h = xxhash.xxh64_intdigest
    hashes = np.array([h(joined[a:b], 42) for a, b in zip(starts, stops.tolist())], ">u8")
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):
        ones += np.unpackbits(hashes[i:i + (1 << 16)].view(np.uint8).reshape(-1, 64 // 8),
                              axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 width: int = 4, carry: tuple = ()) -> DataFrame:
    """(doc_id, ``carry``, fp): fp holds the 64 bits as a signed long."""
    def work(texts: list) -> dict:
        return {"fp": np.array([fingerprint(t, width) for t in texts], np.uint64).view(np.int64)}

    return map_texts(df, text_col, {"doc_id": id_col} | {c: c for c in carry}, [T.StructField("fp", T.LongType())],
                     work)


class Block:
    """One block of the fingerprint and its covering code."""

    def __init__(self, low: int, hamming: int, plain: int, t: int):
        self.low, self.bits = low, hamming + plain
        self.checks = [sum(1 << (p - 1) for p in range(1, hamming + 1) if p >> j & 1)
                       for j in range(hamming.bit_length())]
        self.flips = np.array([sum(1 << i for i in c) for k in range(t + 1)
                               for c in combinations(range(self.bits), k)], np.uint64)

    def value(self, fp: np.ndarray) -> np.ndarray:
        return (fp >> np.uint64(self.low)) & np.uint64((1 << self.bits) - 1)

    def home(self, x: np.ndarray) -> np.ndarray:
        """The anchor of a block value: its code word, the plain bits kept."""
        syndrome = np.zeros(x.shape, np.uint64)
        for j, mask in enumerate(self.checks):
            odd = (np.bitwise_count(x & np.uint64(mask)) & 1).astype(np.uint64)
            syndrome |= odd << np.uint64(j)
        flip = np.where(syndrome > 0, np.uint64(1) << (np.maximum(syndrome, np.uint64(1)) - np.uint64(1)),
                        np.uint64(0))
        return x ^ flip

    def reach(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, anchor) of all anchors that are home to a point within t."""
        a = np.sort(self.home(x[:, None] ^ self.flips[None, :]), axis=1)
        new = np.ones(a.shape, bool)
        new[:, 1:] = a[:, 1:] != a[:, :-1]
        return np.nonzero(new)[0], a[new]


def blocks_of(layout: tuple, threshold: int) -> list[Block]:
    out, low = [], 0
    for hamming, plain in layout:
        out.append(Block(low, hamming, plain, threshold // len(layout)))
        low += hamming + plain
    if low != 64:
        raise ValueError("the layout's blocks must hold 64 bits")
    return out


def _mixed(fp: np.ndarray, salt: int) -> np.ndarray:
    x = (fp ^ np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _near(fp: np.ndarray, key: np.ndarray, home: np.ndarray, threshold: int
          ) -> tuple[np.ndarray, np.ndarray]:
    """Links within the runs of equal ``key``: (node, smallest node), stars."""
    links_a, links_b = [], []
    cuts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    sizes = np.diff(np.append(cuts, len(key)))
    small = np.repeat(sizes <= 64, sizes)
    at = np.flatnonzero(small)
    step = 1
    while len(at):                       # small runs: each row with the step-th after it
        at = at[at + step < len(key)]
        at = at[key[at] == key[at + step]]
        if not len(at):
            break
        ok = (home[at] | home[at + step]) & (np.bitwise_count(fp[at] ^ fp[at + step]) <= threshold)
        links_a.append(at[ok])
        links_b.append(at[ok] + step)
        step += 1
    a, b = (np.concatenate(x) if x else np.empty(0, int) for x in (links_a, links_b))
    root = local_roots(len(fp), a, b)
    for c, n in zip(cuts[sizes > 64].tolist(), sizes[sizes > 64].tolist()):
        seg = slice(c, c + n)
        homes = c + np.flatnonzero(home[seg])
        for i in range(0, len(homes), 256):
            for j in range(c, c + n, 4096):
                m = fp[j:min(j + 4096, c + n)]
                hit = np.bitwise_count(fp[homes[i:i + 256], None] ^ m[None, :]) <= threshold
                x, y = np.nonzero(hit)
                root = _merge(root, homes[i:i + 256][x], j + y)
    moved = np.flatnonzero(root != np.arange(len(fp)))
    return moved, root[moved]


def _merge(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``root`` after the links a - b, over the nodes that they touch only."""
    ra, rb = root[a], root[b]
    open_ = ra != rb
    if not open_.any():
        return root
    nodes, at = np.unique(np.concatenate([ra[open_], rb[open_]]), return_inverse=True)
    half = len(at) // 2
    new = nodes[local_roots(len(nodes), at[:half], at[half:])]
    to = np.arange(len(root))
    to[nodes] = new
    return to[root]


def links(fps: DataFrame, threshold: int = 4, layout: tuple = LAYOUT, cell: int = CELL) -> DataFrame:
    """(u, v): links between distinct fingerprints (column fp of ``fps``, each
    once), as stars per anchor: their components are those of all links."""
    blocks = blocks_of(layout, threshold)

    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            key = np.concatenate([(k << 58) | blk.home(blk.value(fp)).view(np.int64)
                                  for k, blk in enumerate(blocks)])
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64())], ["key"])

    # Anchors fuller than a cell: a fixed code has a fixed number of anchors.
    grids = {r["key"]: -(-r["n"] // cell) for r in
             fps.mapInArrow(homes, "key long").groupBy("key").agg(F.count("*").alias("n"))
             .where(F.col("n") > cell).collect()}
    split_keys = np.array(sorted(grids), np.int64)
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("cell", T.LongType()),
                           T.StructField("home", T.BooleanType()), T.StructField("fp", T.LongType())])
    arrow = arrow_schema(schema)

    def spread(key: np.ndarray, fp: np.ndarray, home: np.ndarray):
        """Rows (key, cell, home, fp); those of a split anchor once per row or
        column of its grid: homes by rows, members by columns."""
        hot = np.isin(key, split_keys)
        yield key[~hot], np.zeros((~hot).sum(), np.int64), home[~hot], fp[~hot]
        for k in np.unique(key[hot]).tolist():
            s = grids[k]
            at = key == k
            own = (_mixed(fp[at], 1) % np.uint64(s)).astype(np.int64)
            far = (_mixed(fp[at], 2) % np.uint64(s)).astype(np.int64)
            for i in range(s):
                yield key[at], i * s + far, np.zeros(at.sum(), bool), fp[at]
                h = home[at]
                yield key[at][h], own[h] * s + i, np.ones(h.sum(), bool), fp[at][h]

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 8192):
                fp = b.column(0).slice(i, 8192).to_numpy(zero_copy_only=False).view(np.uint64)
                for k, blk in enumerate(blocks):
                    x = blk.value(fp)
                    row, anchor = blk.reach(x)
                    key = (k << 58) | anchor.view(np.int64)
                    for cols in spread(key, fp[row], anchor == blk.home(x)[row]):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(cols[0]), pa.array(cols[1]), pa.array(cols[2]),
                             pa.array(cols[3].view(np.int64))], schema=arrow)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []      # rows whose cell may go on in the next batch

        def near(rows: np.ndarray) -> pa.RecordBatch:
            fp = rows["fp"].view(np.uint64)
            run = np.cumsum(np.append(False, (rows["key"][1:] != rows["key"][:-1])
                                      | (rows["cell"][1:] != rows["cell"][:-1])))
            a, b = _near(fp, run, rows["home"], threshold)
            u, v = rows["fp"][a], rows["fp"][b]
            pairs = np.unique(np.stack([u, v], 1)[u != v], axis=0) if len(u) else np.empty((0, 2), np.int64)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy(), pa.int64()),
                                               pa.array(pairs[:, 1].copy(), pa.int64())], ["u", "v"])

        for b in batches:
            rows = np.empty(b.num_rows, [("key", "i8"), ("cell", "i8"), ("home", "?"), ("fp", "i8")])
            for i, n in enumerate(("key", "cell", "home", "fp")):
                rows[n] = b.column(i).to_numpy(zero_copy_only=False)
            if not len(rows):
                continue
            held.append(rows)
            if sum(map(len, held)) < 1 << 17:
                continue
            rows = np.concatenate(held)
            last = (rows["key"] == rows["key"][-1]) & (rows["cell"] == rows["cell"][-1])
            cut = int(np.argmax(last))
            if cut:
                yield near(rows[:cut])
            held = [rows[cut:]]
        if held:
            yield near(np.concatenate(held))

    cells = (fps.mapInArrow(replicate, schema).repartition("key", "cell")
             .sortWithinPartitions("key", "cell"))
    return cells.mapInArrow(compare, "u long, v long")


def grouped(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, width: int = 4,
            threshold: int = 4, layout: tuple = LAYOUT, carry: tuple = ()) -> DataFrame:
    """(doc_id, ``carry``, fp, root, component_id) of every row of ``df``; rows
    of one component share their ``root``.  See ``near_duplicates``."""
    docs = keep(fingerprints(df, id_col, text_col, width, carry))
    fps = keep(docs.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    star = stars(links(fps.select("fp"), threshold, layout))
    members = (star.select(F.col("u").alias("fp"), F.col("v").alias("root"))
               .unionByName(star.select(F.col("v").alias("fp"), F.col("v").alias("root")).distinct()))
    # Only fingerprints with a link need another smallest id; a root that a
    # third of them share meets them in many tasks.
    named = keep(members.join(fps, "fp"))
    lowest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    linked = salted_join(named.select("fp", "root"), lowest, ["root"], "fp").withColumn("linked", F.lit(True))
    ids = fps.join(linked, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"),
        F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("first_id")).alias("component_id"))
    return docs.join(ids, "fp").select("doc_id", *carry, "fp", "root", "component_id")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                    width: int = 4, threshold: int = 4, layout: tuple = LAYOUT) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of ``df``.

    ``fingerprint``: 16 lower-case hex digits.  ``component_id``: the smallest
    doc_id reachable over links (at most ``threshold`` differing bits), the
    row's own included.  Texts without words (null, empty, white space) have
    fingerprint zero and link like any other.  Equal fingerprints are one node,
    so exact copies cost one row each however many there are.  Repeated rows
    and ids each keep their row; null ids never are a component's id (null
    where a component has no other).  An empty table gives no rows.

    Shuffled: 42 rows per distinct fingerprint in the default layout.  Two
    blocks of ((31, 1), (31, 1)) send 340 rows each, but compare 75 times
    fewer pairs; they suit corpora of billions of texts.
    """
    found = grouped(df, id_col, text_col, width=width, threshold=threshold, layout=layout)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
