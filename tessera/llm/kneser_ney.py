"""Toxicity by class-conditional Kneser-Ney models.

Two byte-level models, one of toxic and one of ordinary documents, predict
each byte of a word from up to ``ORDER - 1`` bytes before it (from the word's
leading space on).  Only the longest contexts are counted by class; all shorter
ones are continuation counts shared by both, so a rare expression leans on the
same backoff in either model.  The length-normalised difference of the two log
likelihoods, of the whole text and of its most toxic passages, is the evidence.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import arrow_schema, fold, keep, labelled_sample, sigmoid, slices
from tessera.session import scratch_path

ORDER = 7
DISCOUNT = 0.75
#: ASCII characters that end a word; bytes of other scripts belong to words.
_BREAKS = bytes(c for c in range(128) if not chr(c).isalpha())
_TO_SPACE = bytes(32 if c in _BREAKS else c for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(_TO_SPACE).split()


def codes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, code) of every predicted byte of space-joined words: the code
    holds the byte in its low bits and the bytes before it above, back to the
    space that leads the word or to ORDER bytes in all."""
    n = len(data)
    at = np.arange(n)
    space = np.maximum.accumulate(np.where(data == 32, at, -1))
    reach = at - np.append(-1, space[:-1])         # bytes since the leading space
    wide = data.astype(np.uint64)
    code = wide.copy()
    for j in range(1, ORDER):
        code[j:] |= np.where(reach[j:] >= j, wide[:-j], np.uint64(0)) << np.uint64(8 * j)
    return at[1:], code[1:]


def joined(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """The texts' words with a space before and after each, one text after the
    other, and where each text's bytes end."""
    parts = [b"".join([b" " + b" ".join(w), b" "]) if (w := words_of(t)) else b"" for t in texts]
    return (np.frombuffer(b"".join(parts), np.uint8),
            np.cumsum([len(p) for p in parts], dtype=np.int64))


def _predicted(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``codes`` without the space that starts each text."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    at, code = codes(data)
    first = np.zeros(len(data) + 1, bool)
    first[np.append(0, ends)] = True
    ok = ~first[at]
    return at[ok], code[ok]


def count_grams(docs: DataFrame, text_col: str, label_col: str, fold_col: str | None = None) -> DataFrame:
    """(code, n0, n1): how often each n-gram occurs in documents of label 0 and
    1; with ``fold_col`` (code, fold, n0, n1), by its whole numbers.  Tasks sum
    what they have read before anything is shuffled."""
    src = docs.select(F.col(text_col).cast("string").alias("text"), F.col(label_col).cast("int").alias("y"),
                      (F.col(fold_col) if fold_col else F.lit(0)).cast("int").alias("fold"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty((0, 4), np.int64)]

        def total() -> np.ndarray:
            rows = np.concatenate(held)
            rows = rows[np.lexsort([rows[:, 1], rows[:, 0]])]
            first = np.flatnonzero(np.append(True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1))[:len(rows)])
            out = rows[first]
            if len(out):
                out[:, 2:] = np.add.reduceat(rows[:, 2:], first)
            return out

        for b in batches:
            texts, ys = b.column(0).to_pylist(), b.column(1).to_numpy(zero_copy_only=False)
            folds = b.column(2).to_numpy(zero_copy_only=False)
            for i, j in slices(texts):
                for f, y in sorted({(int(g), int(v)) for g, v in zip(folds[i:j], ys[i:j]) if v in (0, 1)}):
                    some = [t for t, v, g in zip(texts[i:j], ys[i:j], folds[i:j]) if v == y and g == f]
                    code = _predicted(*joined(some))[1]
                    key, n = np.unique(code.view(np.int64), return_counts=True)
                    rows = np.zeros((len(key), 4), np.int64)
                    rows[:, 0], rows[:, 1], rows[:, 2 + y] = key, f, n
                    held.append(rows)
                if sum(map(len, held)) > 2_000_000:
                    held = [total()]
                    if len(held[0]) > 1_000_000:
                        yield _rows(held.pop())
        if held:
            yield _rows(total())

    def _rows(x: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x[:, i].copy()) for i in range(4)],
                                          ["code", "fold", "n0", "n1"])

    by = ["code", "fold"] if fold_col else ["code"]
    return (src.mapInArrow(run, "code long, fold long, n0 long, n1 long")
            .groupBy(*by).agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")))


def _bytes_in(c: Column) -> Column:
    out = F.lit(1)
    for m in range(2, ORDER + 1):
        out = out + (c >= F.lit(1 << (8 * (m - 1)))).cast("int")
    return out


def _stored(df: DataFrame, name: str) -> DataFrame:
    """``df``, written once to the shared scratch folder (a checkpoint's rows
    take several times the room).  What was shuffled for it is deleted when the
    table is there."""
    spark = df.sparkSession
    path = scratch_path(spark, f"op7-{name}")
    with _cleaning(spark):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


#: Fixed value: Spark's setting to delete shuffle files when a query has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _cleaning(spark: SparkSession) -> Iterator[None]:
    """What queries shuffle in here is deleted when they end."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def _dropped(*tables: DataFrame) -> None:
    """Delete scratch tables whose successors are written."""
    for t in tables:
        jvm = t.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(t.scratch)
        path.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def backoff(grams: DataFrame, discount: float = DISCOUNT) -> tuple[DataFrame, list[DataFrame]]:
    """(m, code, p), and the scratch tables it is read from: the probability that shared continuation counts give the
    last of the m bytes of ``code`` after the others, for every suffix of the
    counted n-grams that is shorter than they are."""
    once = grams.select("code").withColumn("m", _bytes_in(F.col("code")))
    longer = None
    for k in range(1, ORDER):
        part = once.where(F.col("m") > k).select(
            F.lit(k).alias("m"), F.col("code").bitwiseAND((1 << 8 * (k + 1)) - 1).alias("from"))
        longer = part if longer is None else longer.unionByName(part)
    mask = F.expr("shiftleft(1L, 8 * m) - 1")
    cont = (longer.distinct().groupBy("m", F.col("from").bitwiseAND(mask).alias("code"))
            .agg(F.count("*").alias("n"))
            .withColumn("ctx", F.shiftright("code", 8)))
    by_ctx = cont.groupBy("m", "ctx").agg(F.sum("n").alias("total"), F.count("*").alias("types"))
    cont = cont.join(by_ctx, ["m", "ctx"]).select(
        "m", "code", ((F.col("n") - discount) / F.col("total")).alias("own"),
        (discount * F.col("types") / F.col("total")).alias("rest"))
    cont = _stored(cont, "continuations")
    tables = [cont]
    lower = cont.where("m = 1").select("code", (F.col("own") + F.col("rest") / 256).alias("p"))
    probs = lower.withColumn("m", F.lit(1))
    for k in range(2, ORDER):
        lower = (cont.where(F.col("m") == k)
                 .withColumn("suffix", F.col("code").bitwiseAND((1 << 8 * (k - 1)) - 1))
                 .join(lower.select(F.col("code").alias("suffix"), F.col("p").alias("q")), "suffix")
                 .select("code", (F.col("own") + F.col("rest") * F.col("q")).alias("p")))
        lower = _stored(lower, "backoff")
        tables.append(lower)
        probs = probs.unionByName(lower.withColumn("m", F.lit(k)))
    return probs.select("m", "code", "p"), tables


def with_backoff(grams: DataFrame, discount: float = DISCOUNT) -> DataFrame:
    """The counted n-grams (code, ctx, n0, n1) with ``p``, that of their suffix;
    written once."""
    below, tables = backoff(grams, discount)
    below = below.select(F.col("m").alias("below"), F.col("code").alias("suffix"), "p")
    m = _bytes_in(F.col("code"))
    full = (grams.select("code", F.shiftright("code", 8).alias("ctx"), "n0", "n1", (m - 1).alias("below"))
            .withColumn("suffix", F.col("code").bitwiseAND(F.expr("shiftleft(1L, 8 * below) - 1")))
            .join(below, ["below", "suffix"]).select("code", "ctx", "n0", "n1", "p"))
    full = _stored(full, "grams")
    _dropped(*tables)
    return full


def contexts(grams: DataFrame) -> DataFrame:
    """(ctx, t0, t1, k0, k1): occurrences and kinds of what follows, by class."""
    seen = lambda c: F.sum((F.col(c) > 0).cast("long"))
    return grams.groupBy(F.shiftright("code", 8).alias("ctx")).agg(
        F.sum("n0").alias("t0"), F.sum("n1").alias("t1"), seen("n0").alias("k0"), seen("n1").alias("k1"))


def _rest(i: int, discount: float) -> Column:
    """The weight that class ``i`` leaves to the backoff after a context."""
    return F.when(F.col(f"t{i}") > 0, discount * F.col(f"k{i}") / F.col(f"t{i}")).otherwise(1.0)


def _gram_llr(discount: float) -> Column:
    def prob(i: int) -> Column:
        own = F.when(F.col(f"n{i}") > 0, (F.col(f"n{i}") - discount) / F.col(f"t{i}")).otherwise(0.0)
        return own + _rest(i, discount) * F.col("p")

    return F.log(prob(1) / prob(0))


def _context_llr(discount: float) -> Column:
    return F.log(_rest(1, discount) / _rest(0, discount))


def evidence(grams: DataFrame, discount: float = DISCOUNT) -> tuple[DataFrame, DataFrame]:
    """Log-likelihood ratios from the counts of ``count_grams``.

    Returns (code, llr, n) of every counted n-gram and (code, llr, n) of every
    counted context, the latter for continuations that were never counted: both
    models then give the shared backoff, times their own weight for it.
    """
    return _evidence(with_backoff(grams, discount), _stored(contexts(grams), "contexts"), discount)


def _evidence(full: DataFrame, ctx: DataFrame, discount: float) -> tuple[DataFrame, DataFrame]:
    return (full.join(ctx, "ctx").select("code", _gram_llr(discount).alias("llr"), (F.col("n0") + F.col("n1")).alias("n")),
            ctx.select(F.col("ctx").alias("code"), _context_llr(discount).alias("llr"),
                       (F.col("t0") + F.col("t1")).alias("n")))


def without_fold(asked: DataFrame, counted: DataFrame, full: DataFrame, ctx: DataFrame,
                 discount: float = DISCOUNT) -> DataFrame:
    """(fold, key, v): evidence for the keys that are ``asked`` (fold, key), from
    the class counts of the other folds: those of the fold (``counted``) are
    taken off the whole (``full``, ``ctx``).  The backoff, which knows no
    class, stays that of all folds."""
    own = counted.select("code", "fold", F.col("n0").alias("o0"), F.col("n1").alias("o1"))
    alone = lambda i: F.sum(((F.col(f"o{i}") > 0) & (F.col(f"o{i}") == F.col(f"n{i}"))).cast("long"))
    own_ctx = (own.join(full.select("code", "ctx", "n0", "n1"), "code").groupBy("ctx", "fold")
               .agg(F.sum("o0").alias("u0"), F.sum("o1").alias("u1"), alone(0).alias("a0"), alone(1).alias("a1")))

    def less(c: str, off: str) -> Column:
        return (F.col(c) - F.coalesce(F.col(off), F.lit(0))).alias(c)

    def left(rows: DataFrame, *cols: str) -> DataFrame:
        """``rows`` (with fold and ctx) with what the other folds have of the context."""
        return (rows.join(ctx, "ctx").join(own_ctx, ["ctx", "fold"], "left")
                .select(*cols, less("t0", "u0"), less("t1", "u1"), less("k0", "a0"), less("k1", "a1")))

    grams = (asked.where(F.col("key") < _CONTEXT).withColumnRenamed("key", "code").join(full, "code")
             .join(own, ["code", "fold"], "left")
             .select("fold", "code", "ctx", "p", less("n0", "o0"), less("n1", "o1")).where("n0 + n1 > 0"))
    after = asked.where(F.col("key") >= _CONTEXT).select("fold", F.col("key").bitwiseXOR(_CONTEXT).alias("ctx"))
    return (left(grams, "fold", "code", "n0", "n1", "p").select("fold", F.col("code").alias("key"),
                                                                _gram_llr(discount).alias("v"))
            .unionByName(left(after, "fold", "ctx").where("t0 + t1 > 0").select(
                "fold", F.col("ctx").bitwiseOR(_CONTEXT).alias("key"), _context_llr(discount).alias("v"))))


#: Marks a context's key among those of n-grams, which have 7 bytes at most.
_CONTEXT = 1 << 62
#: Evidence is summed in units of 2^-32, so that its order doesn't matter.
_UNIT = 2.0 ** 32
#: In whole units: no evidence.
_NONE = np.iinfo(np.int64).min
#: A chunk of documents ends after so many words, or bytes of distinct words.
CHUNK_WORDS, CHUNK_BYTES = 1_000_000, 4_000_000


def keyed(by_gram: DataFrame, by_context: DataFrame) -> DataFrame:
    """(key, v): the evidence of every n-gram and every context in one table,
    which grows with what was counted and never leaves the executors."""
    return (by_gram.select(F.col("code").alias("key"), F.col("llr").alias("v"))
            .unionByName(by_context.select(F.col("code").bitwiseOR(_CONTEXT).alias("key"), F.col("llr").alias("v"))))


def _grams_of(vocabulary: bytes) -> np.ndarray:
    """The n-grams of space-joined words, one for each byte after the first."""
    data = np.frombuffer(vocabulary, np.uint8)
    return codes(data)[1].view(np.int64) if len(data) else np.empty(0, np.int64)


def chunks(df: DataFrame, text_col: str, keep_cols: dict[str, str]) -> DataFrame:
    """``df`` as chunks of documents, written once: (chunk, keys, vocabulary,
    words, and the arrays ``keep_cols`` and n_words by document), all packed.

    ``vocabulary`` are the chunk's distinct words with a space before and after
    each, ``words`` the documents' words as numbers of these.  ``keys``
    (ascending) are the vocabulary's distinct n-grams, then their distinct
    contexts.  Which n-grams a word has is not stored: it would take more room
    than all else, and the vocabulary tells.
    """
    src = df.select(*[F.col(c).alias(name) for name, c in keep_cols.items()],
                    F.col(text_col).cast("string").alias("__text"))
    schema = T.StructType(
        [T.StructField("chunk", T.LongType()), T.StructField("keys", T.BinaryType()),
         T.StructField("vocabulary", T.BinaryType()), T.StructField("words", T.BinaryType()),
         T.StructField("n_words", T.ArrayType(T.LongType()))]
        + [T.StructField(name, T.ArrayType(src.schema[name].dataType)) for name in keep_cols])
    arrow = arrow_schema(schema)
    most_words, most_bytes = CHUNK_WORDS, CHUNK_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = TaskContext.get().partitionId() << 32
        seen: dict[bytes, int] = {}
        words: list[int] = []
        counts: list[int] = []
        held: list[list] = [[] for _ in keep_cols]
        size = 0

        def chunk() -> pa.RecordBatch:
            data = b"".join([b" ", b" ".join(seen), b" "]) if seen else b""
            own = np.unique(_grams_of(data))
            keys = np.concatenate([own, np.unique(own >> 8) | _CONTEXT])
            cols = [[made], [_shuffled_bytes(np.diff(keys, prepend=0))], [zstandard.compress(data)],
                    [_shuffled_bytes(np.array(words, np.int32))], [counts], *[[h] for h in held]]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, arrow)], schema=arrow)

        for b in batches:
            texts = b.column("__text").to_pylist()
            columns = [b.column(name).to_pylist() for name in keep_cols]
            for i, text in enumerate(texts):
                found = words_of(text)
                before = len(seen)
                words += [seen.setdefault(w, len(seen)) for w in found]
                if len(seen) > before:
                    size += sum(map(len, islice(reversed(seen), len(seen) - before)))
                counts.append(len(found))
                for h, c in zip(held, columns):
                    h.append(c[i])
                if len(words) + len(counts) >= most_words or size >= most_bytes:
                    yield chunk()
                    made, size, seen, words, counts = made + 1, 0, {}, [], []
                    held = [[] for _ in keep_cols]
        if counts:
            yield chunk()

    return _stored(src.mapInArrow(run, schema), "chunks")


#: Words of the passages whose evidence is averaged.
TOP = (1, 3, 8, 24)
N_STATS = 3 + len(TOP)


def _bucket(key: np.ndarray, buckets: int) -> np.ndarray:
    return (key ^ (key >> 17) ^ (key >> 31)) % buckets


def _bucket_column(key: str, buckets: int) -> Column:
    k = F.col(key)
    return (k.bitwiseXOR(F.shiftright(k, 17)).bitwiseXOR(F.shiftright(k, 31)) % buckets).cast("int")


def answers(parts: DataFrame, evidence: DataFrame, buckets: int) -> DataFrame:
    """(of, bucket, v): for the keys of a chunk that fall into a bucket, in
    order, their evidence in whole units (``_NONE`` where there is none),
    packed.  Keys are shuffled as packed parcels, so a key costs a few bytes a
    chunk."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                keys = _keys(b.column(1)[i].as_py())
                which = _bucket(keys, buckets)
                order = np.argsort(which, kind="stable")
                ends = np.cumsum(np.bincount(which, minlength=buckets))
                held = np.flatnonzero(np.diff(ends, prepend=0))
                rows = [keys[order[ends[k - 1] if k else 0:ends[k]]] for k in held]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(held, pa.int32()), pa.array([b.column(0)[i].as_py()] * len(held), pa.int64()),
                     pa.array([_shuffled_bytes(np.diff(r, prepend=0)) for r in rows], pa.binary())], ["bucket", "of", "keys"])

    def look_up(asked: pa.Table, known: pa.Table) -> pa.Table:
        key, v = (known[c].to_numpy() for c in ("key", "v"))
        order = np.argsort(key)
        key, v = np.append(key[order], -1), np.append(np.rint(v[order] * _UNIT).astype(np.int64), _NONE)
        out = []
        for b in asked["keys"]:
            want = _keys(b.as_py())
            at = np.searchsorted(key[:-1], want)
            out.append(_shuffled_bytes(np.where(key[at] == want, v[at], _NONE)))
        return pa.table({"of": asked["of"], "bucket": asked["bucket"], "v": pa.array(out, pa.binary())})

    dealt = parts.select("chunk", "keys").mapInArrow(deal, "bucket int, of long, keys binary")
    known = evidence.select("key", "v", _bucket_column("key", buckets).alias("in"))
    return dealt.groupBy("bucket").cogroup(known.groupBy("in")).applyInArrow(look_up, "of long, bucket int, v binary")


def _shuffled_bytes(x: np.ndarray) -> bytes:
    """Numbers, compressed with their first bytes first."""
    return zstandard.compress(np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.itemsize).T.tobytes())


def _from_bytes(b: bytes, kind: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(b), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _keys(b: bytes) -> np.ndarray:
    """Ascending keys from their packed differences."""
    return np.cumsum(_from_bytes(b, np.int64))


def exploded(parts: DataFrame) -> DataFrame:
    """The keys of all chunks, a row each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for keys in b.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(_keys(keys.as_py()))], ["key"])

    return parts.select("keys").mapInArrow(run, "key long")


def statistics(parts: DataFrame, evidence: DataFrame, keep_cols: list[str], buckets: int | None = None) -> DataFrame:
    """(``keep_cols``, x) of every document of ``chunks``.  A chunk asks once
    for each of its n-grams and contexts, however often it has them, so a key
    is asked for by as many chunks as there are at most."""
    buckets = buckets or max(1, parts.count())
    schema = T.StructType([T.StructField(c, parts.schema[c].dataType.elementType) for c in keep_cols]
                          + [T.StructField("x", T.ArrayType(T.DoubleType()))])
    arrow = arrow_schema(schema)

    def work(chunk: pa.Table, found: pa.Table) -> pa.Table:
        if not len(chunk):
            return arrow.empty_table()
        row = chunk.combine_chunks().to_batches()[0]

        def of(name: str) -> pa.Array:
            return row.column(name).flatten()

        keys = _keys(row.column("keys")[0].as_py())
        value, which = np.full(len(keys), _NONE), _bucket(keys, buckets)
        order = np.argsort(which, kind="stable")
        ends = np.cumsum(np.bincount(which, minlength=buckets))
        for k, v in zip(found["bucket"].to_pylist(), found["v"]):
            value[order[ends[k - 1] if k else 0:ends[k]]] = _from_bytes(v.as_py(), np.int64)
        first = np.searchsorted(keys, _CONTEXT)       # n-grams, then contexts
        back = np.where(value[first:] == _NONE, 0, value[first:])
        back = back[np.searchsorted(keys[first:], keys[:first] >> 8 | _CONTEXT)]
        llr = np.where(value[:first] == _NONE, back, value[:first])

        vocabulary = zstandard.decompress(row.column("vocabulary")[0].as_py())
        ends = np.flatnonzero(np.frombuffer(vocabulary[1:], np.uint8) == 32) + 1
        starts = np.append(0, ends[:-1])
        of_word = (np.add.reduceat(llr[np.searchsorted(keys[:first], _grams_of(vocabulary))], starts) / _UNIT
                   if len(ends) else np.empty(0))
        x = _stats(of_word, ends - starts[:len(ends)], _from_bytes(row.column("words")[0].as_py(), np.int32),
                   of("n_words").to_numpy(zero_copy_only=False))
        lists = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * N_STATS, pa.array(x.ravel()))
        cols = [of(c).cast(arrow.field(c).type) for c in keep_cols] + [lists.cast(arrow.field("x").type)]
        return pa.Table.from_arrays(cols, schema=arrow)

    whole = parts.select("chunk", "keys", "vocabulary", "words", "n_words", *keep_cols)
    return (whole.groupBy("chunk").cogroup(answers(parts, evidence, buckets).groupBy("of"))
            .applyInArrow(work, schema))


def _stats(of_word: np.ndarray, size: np.ndarray, words: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    """Per document: the length-normalised log-likelihood ratio, the share of
    words that speak for toxic, the logarithm of the number of words (chance
    evidence grows with it), and the mean evidence of its strongest words.
    Zeros for a text without words.  ``of_word`` and ``size``: evidence and
    bytes of each distinct word; ``words``: the documents' words."""
    out = np.zeros((len(n_words), N_STATS))
    start = 0
    for i, n in enumerate(n_words.tolist()):
        if n:
            w = words[start:start + n]
            v = of_word[w]
            k = min(max(TOP), n)
            top = -np.sort(-np.partition(v, n - k)[n - k:])
            out[i, 0] = v.sum() / size[w].sum()
            out[i, 1] = (v > 3).mean()
            out[i, 2] = np.log(n)
            out[i, 3:] = [top[:t].sum() / t for t in TOP]
        start += n
    return out


@dataclass
class Toxicity:
    evidence: DataFrame       # (key, v)
    weights: np.ndarray       # bias, then one per statistic


def calibrate(x: np.ndarray, y: np.ndarray, share: float, l2: float = 1e-2) -> np.ndarray:
    """Logistic weights (bias first) from statistics to the label, the classes
    weighed to the share of label 1.  Without both labels: no evidence."""
    if len(set(y.tolist())) < 2:
        return np.append(-3.0, np.zeros(N_STATS))
    scale = x.std(axis=0) + 1e-9
    z = np.column_stack([np.ones(len(x)), x / scale])
    w, reg = np.zeros(z.shape[1]), l2 * np.append(0, np.ones(N_STATS))
    weight = np.where(y == 1, share / (y == 1).mean(), (1 - share) / (y == 0).mean())
    for _ in range(50):
        p = sigmoid(z @ w)
        grad = z.T @ (weight * (p - y)) + reg * w
        hess = (z * (weight * p * (1 - p))[:, None]).T @ z + np.diag(reg + 1e-6)
        step = np.linalg.solve(hess, grad)
        w = w - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return np.append(w[0], w[1:] / scale)


#: Documents are cross-fitted by so many folds of their id.
CROSS = 5


def fold_counts(docs: DataFrame, known: DataFrame) -> list[DataFrame]:
    """(code, fold, n0, n1), a table for each fold: the n-grams of ``docs``
    (__id, __text) by the label that ``known`` (__id, __y) has.  Only the texts
    and counts of one fold lie in shuffle files at a time."""
    of = fold("__id", CROSS)
    folds = sorted(r["fold"] for r in known.select(of.alias("fold")).distinct().collect())
    return [_stored(count_grams(docs.where(of == f).join(known.where(of == f), "__id").withColumn("__fold", F.lit(f)),
                                "__text", "__y", "__fold"), "counts") for f in folds or [0]]


def fit(documents: DataFrame, labels: DataFrame, *, label: str = "toxic", learn: Column | None = None,
        calibration: Column | None = None, sample: int = 3000, id_col: str = "doc_id",
        text_col: str = "text") -> Toxicity:
    """Count over all labelled documents that ``learn`` allows, then calibrate
    on at most ``sample`` documents of each label that ``calibration`` (as
    ``learn``, if not given) allows; both are conditions on ``__id``.  Each of
    these is judged by the class counts of the other folds, worked out for the
    keys that it asks for, so that no document speaks for itself; the model
    then has the counts of all."""
    learn = (fold("__id", CROSS) != 0) if learn is None else learn
    calibration = learn if calibration is None else calibration
    known = (labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull())
             .groupBy(F.col(id_col).alias("__id")).agg(F.max(label).cast("int").alias("__y")))
    counts = fold_counts(documents.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text")).where(learn),
                         known.where(learn))
    counted = reduce(DataFrame.unionByName, counts)
    grams = _stored(counted.groupBy("code").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")), "all-counts")
    full = with_backoff(grams)
    _dropped(grams)
    ctx = _stored(contexts(full.select("code", "n0", "n1")), "contexts")
    by_key = _stored(keyed(*_evidence(full, ctx, DISCOUNT)), "evidence")
    held = keep(labelled_sample(documents, labels, label, sample, calibration, id_col, text_col)
                .withColumn("fold", fold("doc_id", CROSS)))
    folds = sorted(r["fold"] for r in held.select("fold").distinct().collect())
    parts = {f: chunks(held.where(F.col("fold") == f), "text", {"y": "y"}) for f in folds}
    asked = None
    for f, part in parts.items():
        some = exploded(part).select(F.lit(f).cast("long").alias("fold"), "key")
        asked = some if asked is None else asked.unionByName(some)
    got = held.select("y").limit(0).withColumn("x", F.array(F.lit(0.0))).toPandas()
    if asked is not None:
        others = _stored(without_fold(asked.distinct(), counted, full, ctx), "folds")
        _dropped(*counts, full, ctx)
        for f, part in parts.items():
            by_fold = others.where(F.col("fold") == f).select("key", "v")
            with _cleaning(documents.sparkSession):
                got = pd.concat([got, statistics(part, by_fold, ["y"]).toPandas()])
        _dropped(others, *parts.values())
    share = known.where(learn).agg(F.avg("__y")).first()[0]
    x = np.array(got["x"].tolist(), float).reshape(len(got), N_STATS)
    y = got["y"].to_numpy(int)
    order = np.lexsort([*x.T, y])
    return Toxicity(by_key, calibrate(x[order], y[order], float(share or 0.0)))


#: Chunks meet their evidence in so many portions, one after the other, so that
#: only a portion of them lies in shuffle files at a time.
PORTIONS = 4


def score(documents: DataFrame, model: Toxicity, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = 0.5) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row.

    ``held_out``: crc32 of the id's text is a multiple of 5 (false for a null
    id).  ``score`` in 0..1, higher for likelier toxic; null, empty and
    wordless texts have the score of no evidence.  ``predicted`` = score >=
    ``threshold``.  Repeated rows are scored alike; an empty table gives none.
    """
    w = model.weights
    total = F.lit(float(w[0]))
    for j in range(N_STATS):
        total = total + F.col("x")[j] * F.lit(float(w[j + 1]))
    total = F.greatest(F.lit(-40.0), F.least(F.lit(40.0), total))
    parts = chunks(documents, text_col, {"doc_id": id_col})
    buckets, x = max(1, parts.count()), None
    for i in range(PORTIONS):
        some = parts.where(F.pmod(F.xxhash64("chunk"), F.lit(PORTIONS)) == i)
        some = _stored(statistics(some, model.evidence, ["doc_id"], buckets), "statistics")
        x = some if x is None else x.unionByName(some)
    _dropped(parts)
    out = (x.select("doc_id", (1.0 / (1.0 + F.exp(-total))).alias("score")))
    return out.select("doc_id", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
                      "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
