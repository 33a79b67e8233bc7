"""Phrase collocation mining with broadcast double-array tries.

Texts are numbered words in blocks.  Level by level, the phrases of k words
whose two phrases of k - 1 words may both be frequent are counted by a hash of
some fifty bits, which can only count too many: those below the least count are
no candidates, and blocks go on with the rest.  The candidates (Apriori-safe:
all their parts are frequent) go into double-array tries of bounded size,
broadcast one after the other; tasks advance the states of all positions of a
block at once, word by word, and count the accepting states they reach.  These
exact counts, summed over the blocks, are scored.

Of the blocks that hold a hash one names its phrase.  Should phrases share a
hash, the exact counts of those named fall short of the hash's count; all
blocks then name theirs, and one more trie counts them.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import islice
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import arrow_schema, keep
from tessera.session import scratch_path

#: A task's blocks (one per language) end after so many words, or bytes of distinct ones.
BLOCK_WORDS, BLOCK_BYTES = 2_000_000, 16_000_000
#: Words of text for each parcel that a block's words and hashes are dealt into.
PARCEL_WORDS = 1_500_000
#: Bits of a hash beyond those of the number of all words.
SPARE_BITS = 20
#: A trie holds about so many phrases, or bytes of them; it is what is broadcast.
TRIE_PHRASES, TRIE_BYTES = 200_000, 32_000_000
#: Accepting states whose counts, one row a task, are summed in one place.
SHARD = 20_000
LONGEST = 4
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Breaks become a full stop, blanks a space, capitals lower case.
_FOLD = bytes(46 if c in b".,;:!?\n\x0b\x0c\r" else 32 if c in b" \t" else c + 32 if 65 <= c <= 90 else c
              for c in range(256))


def packed(x) -> bytes:
    """Numbers below 2^31."""
    return zstandard.compress(np.ascontiguousarray(x, np.int32).tobytes())


def numbers(b: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(b), np.int32)


def packed_lines(x: list[bytes]) -> bytes:
    """Byte strings without line ends."""
    return zstandard.compress(b"\n".join(x))


def lines(b: bytes) -> list[bytes]:
    raw = zstandard.decompress(b)
    return raw.split(b"\n") if raw else []


def packed_ascending(x: np.ndarray) -> bytes:
    """Ascending numbers below 2^63 by their differences, byte for byte."""
    steps = np.diff(x, prepend=0).astype("<i8")
    return zstandard.compress(steps.view(np.uint8).reshape(-1, 8).T.tobytes())


def ascending(b: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(b), np.uint8)
    return np.cumsum(np.ascontiguousarray(raw.reshape(8, -1).T).view("<i8").ravel())


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"op12-{name}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _fields(**types) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in types.items()])


def _table(rows: list[tuple], schema: T.StructType) -> pa.Table:
    arrow = arrow_schema(schema)
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(arrow), arrow)],
                    schema=arrow)


_BINARY, _LONG, _TEXT = T.BinaryType(), T.LongType(), T.StringType()
#: ``grams``: per position the number of the phrase that starts there, -1 for
#: none; neighbours that are no phrase are one -1.
BLOCK_SCHEMA = _fields(block=_LONG, lang=_TEXT, words=_BINARY, counts=_BINARY, n=_LONG, grams=_BINARY)
#: ``states``: the numbers (in ``words``) of every phrase's words; ``named``:
#: the phrases this block names, with their hash and its count.
LEVEL_SCHEMA = _fields(block=_LONG, lang=_TEXT, words=_BINARY, grams=_BINARY, states=_BINARY, named=T.ArrayType(
    _fields(phrase=_TEXT, key=_LONG, total=_LONG)))


def _squeezed(grams: np.ndarray) -> np.ndarray:
    none = grams < 0
    return grams[~(none & np.append(False, none[:-1]))]


def blocks(df: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """``df`` as blocks of one language each, with ``counts`` of all their
    ``words`` and ``n``, their sum; written once to the shared scratch folder."""
    src = df.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                    F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))
    most, most_bytes = BLOCK_WORDS, BLOCK_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = TaskContext.get().partitionId() << 32
        held: dict[str, tuple[dict, list]] = {}
        size = distinct = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal made, size, distinct
            for lang, (seen, words) in held.items():
                names = list(seen)[1:]
                order = pc.sort_indices(pa.array(names, pa.binary())).to_numpy()
                rank = np.full(len(names) + 1, -1, np.int64)         # a break is -1
                rank[order.astype(np.int64) + 1] = np.arange(len(names))
                seq = rank[np.array(words, np.int64)]
                counts = np.bincount(seq[seq >= 0], minlength=len(names))
                yield from _table([(made, lang, packed_lines([names[i] for i in order.tolist()]), packed(counts),
                                    int(counts.sum()), packed(_squeezed(seq)))], BLOCK_SCHEMA).to_batches()
                made += 1
            held.clear()
            size = distinct = 0

        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if lang not in held:
                    held[lang] = ({b".": 0}, [])
                seen, words = held[lang]
                before = len(seen)
                found = text.translate(_FOLD).replace(b".", b" . ").split()
                words += [seen.setdefault(w, len(seen)) for w in found]
                words.append(0)
                size += len(found) + 1
                if len(seen) > before:
                    distinct += sum(map(len, islice(reversed(seen), len(seen) - before)))
                if size >= most or distinct >= most_bytes:
                    yield from flush()
        yield from flush()

    return _stored(src.mapInArrow(run, BLOCK_SCHEMA), "blocks")


def frequent_words(parts: DataFrame, least: int, parcels: int) -> DataFrame:
    """Per block and parcel: ``at``, the numbers of its words that occur at
    least ``least`` times in their language; ``named`` those words that no
    earlier block has, with their count."""
    dealt = _fields(parcel=T.IntegerType(), of=_LONG, lang=_TEXT, at=_BINARY, words=_BINARY, counts=_BINARY)
    answer = _fields(of=_LONG, lang=_TEXT, at=_BINARY, named=T.ArrayType(_fields(text=_TEXT, f=_LONG)))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                names, counts = np.array(lines(r["words"]), object), numbers(r["counts"])
                which = np.fromiter((crc32(w) for w in names), np.int64, len(names)) % parcels
                order = np.argsort(which, kind="stable")
                rows = [(int(which[at[0]]), r["block"], r["lang"], packed(at), packed_lines(names[at].tolist()),
                         packed(counts[at]))
                        for at in np.split(order, np.flatnonzero(np.diff(which[order])) + 1) if len(at)]
                yield from _table(rows, dealt).to_batches()

    def choose(t: pa.Table) -> pa.Table:
        rows = t.sort_by("of").to_pylist()
        seen: dict[tuple, int] = {}
        codes = [[seen.setdefault((r["lang"], w), len(seen)) for w in lines(r["words"])] for r in rows]
        f = np.bincount(np.concatenate(codes).astype(np.int64), np.concatenate([numbers(r["counts"]) for r in rows]),
                        len(seen)).astype(np.int64)
        names, met, out = list(seen), 0, []
        for r, code in zip(rows, codes):
            code = np.array(code)
            new = code[(code >= met) & (f[code] >= least)]           # numbered here for the first time
            met = max(met, int(code.max()) + 1)
            out.append((r["of"], r["lang"], packed(numbers(r["at"])[f[code] >= least]),
                        [{"text": names[i][1].decode(), "f": int(f[i])} for i in new]))
        return _table(out, answer)

    return _stored(parts.select("block", "lang", "words", "counts").mapInArrow(deal, dealt)
                   .groupBy("parcel").applyInArrow(choose, answer), "words")


def only_frequent(parts: DataFrame, words: DataFrame) -> DataFrame:
    """The blocks with their frequent words only."""
    def work(block: pa.Table, found: pa.Table) -> pa.Table:
        out = []
        for r in block.to_pylist():
            at = np.sort(np.concatenate([np.empty(0, np.int32), *[numbers(b.as_py()) for b in found["at"]]]))
            names = lines(r["words"])
            new = np.full(len(names) + 1, -1, np.int32)              # the last is for -1
            new[at] = np.arange(len(at))
            out.append((r["block"], r["lang"], packed_lines([names[i] for i in at]),
                        packed(_squeezed(new[numbers(r["grams"])])), packed(np.arange(len(at))), []))
        return _table(out, LEVEL_SCHEMA)

    of = words.select("of", "at").groupBy("of")
    return _stored(parts.select("block", "lang", "words", "grams").groupBy("block").cogroup(of)
                   .applyInArrow(work, LEVEL_SCHEMA), "level-1")


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class _Level:
    """A row of LEVEL_SCHEMA for phrases of ``k`` words, and those one word longer."""

    def __init__(self, row: dict, k: int, bits: int):
        self.block, self.lang, self.words, self.k = row["block"], row["lang"], lines(row["words"]), k
        self.states = numbers(row["states"]).reshape(-1, k)
        self.grams = numbers(row["grams"])
        prefix = self.lang.encode() + b"\0"
        h = np.array([xxhash.xxh64_intdigest(prefix + w) for w in self.words], np.uint64)
        whole = h[self.states[:, 0]]
        for j in range(1, k):
            whole = _mixed(whole, h[self.states[:, j]])
        self._hashes, self._of_word, self._shift = whole, h, np.uint64(64 - bits)

    def keys(self) -> np.ndarray:
        """The hash of every phrase."""
        return (self._hashes >> self._shift).astype(np.int64)

    def extend(self) -> None:
        """Phrases one word longer: where they are (``at``), the number of each
        there, and of each number its parts, count and hash."""
        n = max(len(self.states), 1)
        self.at = np.flatnonzero((self.grams[:-1] >= 0) & (self.grams[1:] >= 0))
        pair, self.number, self.count = np.unique(
            self.grams[self.at].astype(np.int64) * n + self.grams[self.at + 1], return_inverse=True,
            return_counts=True)
        self.left, self.right = np.divmod(pair, n)
        last = self._of_word[self.states[self.right, -1]] if len(pair) else np.empty(0, np.uint64)
        self.key = (_mixed(self._hashes[self.left], last) >> self._shift).astype(np.int64)

    def phrases(self, states: np.ndarray) -> list[str]:
        return [b" ".join([self.words[i] for i in s]).decode() for s in states.tolist()]


def longer(level: DataFrame, k: int, least: int, bits: int, parcels: int) -> DataFrame:
    """The blocks of ``level`` with its phrases of ``k`` words made one longer:
    those both of whose parts are there and whose hash counts ``least`` at least."""
    dealt = _fields(parcel=T.IntegerType(), of=_LONG, keys=_BINARY, counts=_BINARY)
    answer = _fields(of=_LONG, parcel=T.IntegerType(), n=_LONG, good=_BINARY, first=_BINARY, totals=_BINARY)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                v = _Level(r, k, bits)
                v.extend()
                key, back = np.unique(v.key, return_inverse=True)
                count = np.bincount(back, v.count, len(key)).astype(np.int64)
                # Ascending keys fall into ascending parcels.
                cuts = np.searchsorted(key, [(p << bits) // parcels for p in range(parcels + 1)])
                rows = [(p, v.block, packed_ascending(key[i:j]), packed(count[i:j]))
                        for p, (i, j) in enumerate(zip(cuts[:-1], cuts[1:])) if j > i]
                yield from _table(rows, dealt).to_batches()

    def choose(t: pa.Table) -> pa.Table:
        rows = t.sort_by("of").to_pylist()
        keys = [ascending(r["keys"]) for r in rows]
        ends = np.cumsum([len(x) for x in keys])
        distinct, first, back = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
        total = np.bincount(back, np.concatenate([numbers(r["counts"]) for r in rows]), len(distinct)).astype(np.int64)
        good = total[back] >= least
        names = np.zeros(len(back), bool)
        names[first] = True
        out = []
        for r, j, size in zip(rows, ends, map(len, keys)):
            here = slice(j - size, j)
            own = good[here] & names[here]
            out.append((r["of"], r["parcel"], size, np.packbits(good[here]).tobytes(), np.packbits(own).tobytes(),
                        total[back[here]][own].tobytes()))
        return _table(out, answer)

    def work(block: pa.Table, found: pa.Table) -> pa.Table:
        out = []
        for r in block.to_pylist():
            v = _Level(r, k, bits)
            v.extend()
            rows = found.sort_by("parcel").to_pylist()
            good, own = (np.concatenate([np.empty(0, bool)] + [
                np.unpackbits(np.frombuffer(a[c], np.uint8), count=a["n"]).astype(bool) for a in rows])
                for c in ("good", "first"))
            total = np.zeros(len(own), np.int64)
            total[own] = np.frombuffer(b"".join(a["totals"] for a in rows), np.int64)
            back = np.unique(v.key, return_inverse=True)[1]          # answers are in the keys' order
            go, mine, total = good[back], own[back], total[back]
            new = np.where(go, np.cumsum(go) - 1, -1).astype(np.int32)
            grams = np.full(len(v.grams), -1, np.int32)
            grams[v.at] = new[v.number]
            states = np.column_stack([v.states[v.left], v.states[v.right, -1]])
            named = [{"phrase": p, "key": key, "total": n} for p, key, n in
                     zip(v.phrases(states[mine]), v.key[mine].tolist(), total[mine].tolist())]
            out.append((v.block, v.lang, r["words"], packed(_squeezed(grams)), packed(states[go]), named))
        return _table(out, LEVEL_SCHEMA)

    of = level.mapInArrow(deal, dealt).groupBy("parcel").applyInArrow(choose, answer).groupBy("of")
    return _stored(level.drop("named").groupBy("block").cogroup(of).applyInArrow(work, LEVEL_SCHEMA), f"level-{k + 1}")


def all_named(level: DataFrame, k: int, bits: int) -> DataFrame:
    """(k, key, lang, phrase) of every block's phrases of ``k`` words."""
    schema = _fields(k=T.IntegerType(), key=_LONG, lang=_TEXT, phrase=_TEXT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                v = _Level(r, k, bits)
                for i in range(0, len(v.states), 100_000):
                    some = v.phrases(v.states[i:i + 100_000])
                    yield from _table([(k, key, v.lang, p) for key, p in zip(v.keys()[i:].tolist(), some)],
                                      schema).to_batches()

    return level.drop("named").mapInArrow(run, schema)


class DoubleArray:
    """A trie over rows of codes: state s goes on with code c to t = base[s] + c
    if check[t] is s; accept[t] is the number of the row that ends there, or -1.

    The arrays begin and end with room for any code, so t needs no bounds.
    """

    def __init__(self, rows: np.ndarray, lengths: np.ndarray):
        self.width = width = int(rows.max(initial=0)) + 1
        node = np.zeros(len(rows), np.int64)
        parents, codes, ends = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.full(1, -1)]
        made = 1
        for depth in range(rows.shape[1]):
            live = lengths > depth
            key, back = np.unique(node[live] * width + rows[live, depth], return_inverse=True)
            node[live] = made + back
            parents.append(key // width)
            codes.append(key % width)
            end = np.full(len(key), -1)
            last = np.flatnonzero(lengths == depth + 1)
            end[node[last] - made] = last
            ends.append(end)
            made += len(key)
        parent, code, end = (np.concatenate(x) for x in (parents, codes, ends))
        slot, base = self._placed(parent, code, made)
        size = int(slot.max()) + 1 + 2 * width
        self.root = width
        self.base = np.zeros(size, np.int32)
        self.base[slot + width] = base + width
        self.check = np.full(size, -1, np.int32)
        self.check[slot[1:] + width] = slot[parent] + width
        self.accept = np.full(size, -1, np.int32)
        self.accept[slot + width] = end

    @staticmethod
    def _placed(parent: np.ndarray, code: np.ndarray, made: int) -> tuple[np.ndarray, np.ndarray]:
        """(slot, base) of every node: large families first, at the first place
        where all fit; single children fill the gaps."""
        first = np.flatnonzero(np.append(True, parent[1:] != parent[:-1])) if len(parent) else np.empty(0, int)
        family = np.diff(np.append(first, len(parent)))
        slot, base = np.zeros(made, np.int64), np.zeros(made, np.int64)
        used = np.zeros(2 * made + 1024, bool)
        used[0] = True
        low = 1
        for g in np.argsort(-family, kind="stable")[:int((family > 1).sum())]:
            child = np.arange(first[g], first[g] + family[g])
            away = code[child] - code[child[0]]
            while True:
                if low + 64 + away[-1] >= len(used):
                    used = np.append(used, np.zeros(len(used) + away[-1], bool))
                place = low + np.flatnonzero(~used[low:low + 64])
                fits = place[~used[place[:, None] + away].any(axis=1)]
                if len(fits):
                    break
                low += 64
            used[fits[0] + away] = True
            slot[child + 1] = fits[0] + away
            base[parent[child[0]]] = fits[0] - code[child[0]]
        single = first[family == 1]
        free = np.flatnonzero(~used)[:len(single)]
        free = np.append(free, len(used) + np.arange(len(single) - len(free)))
        slot[single + 1] = free
        base[parent[single]] = free - code[single]
        return slot, base

    def step(self, state: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The states reached, -1 for none; a code below 0 reaches none."""
        t = self.base[state] + code
        return np.where((code >= 0) & (self.check[t] == state), t, -1)


def build_trie(langs: list[str], phrases: list[str]) -> dict:
    """The trie of a bundle of phrases, its first code being their language."""
    held = sorted(set(langs))
    split = [p.split(" ") for p in phrases]
    # Frequent words have small codes, so that large families lie close.
    words = [w for w, _ in sorted(Counter(w for s in split for w in s).items(), key=lambda x: (-x[1], x[0]))]
    number, lang_number = {w: i for i, w in enumerate(words)}, {x: i for i, x in enumerate(held)}
    rows = np.full((len(split), LONGEST + 1), -1, np.int64)
    rows[:, 0] = [lang_number[x] for x in langs]
    for i, s in enumerate(split):
        rows[i, 1:len(s) + 1] = [number[w] for w in s]
    return {"langs": held, "words": pa.array(words, pa.string()), "trie": DoubleArray(rows, (rows >= 0).sum(axis=1)),
            "lang": pa.array(langs, pa.string()), "phrase": pa.array(phrases, pa.string())}


def accepted(bundle: dict, lang: str, words: list[bytes], grams: np.ndarray) -> np.ndarray:
    """How often each phrase of the bundle occurs in a block."""
    trie, n = bundle["trie"], len(bundle["phrase"])
    counts = np.zeros(n, np.int64)
    if lang not in bundle["langs"] or not len(grams):
        return counts
    known = pc.fill_null(pc.index_in(pa.array(words, pa.binary()).cast(pa.string()), bundle["words"]), -1).to_numpy(zero_copy_only=False)
    codes = np.append(known, -1)[grams]                       # -1 stays -1
    codes = np.append(codes, np.full(LONGEST, -1)).astype(np.int64)
    at = np.flatnonzero(codes >= 0)
    start = trie.step(np.array([trie.root]), np.array([bundle["langs"].index(lang)]))[0]
    state = np.full(len(at), start)
    for depth in range(LONGEST):
        state = trie.step(state, codes[at + depth])
        at, state = at[state >= 0], state[state >= 0]
        row = trie.accept[state]
        counts += np.bincount(row[row >= 0], minlength=n)
    return counts


def _counting(bundle) -> tuple:
    """The work of a task (counts of its blocks, in shards) and of a shard (their sum)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = bundle.value
        counts = np.zeros(len(b["phrase"]), np.int64)
        for batch in batches:
            for r in batch.to_pylist():
                counts += accepted(b, r["lang"], lines(r["words"]), numbers(r["grams"]))
        yield from _table([(i, packed(counts[i:i + SHARD])) for i in range(0, len(counts), SHARD)],
                          _fields(start=_LONG, counts=_BINARY)).to_batches()

    def add(t: pa.Table) -> pa.Table:
        b, start = bundle.value, t["start"][0].as_py()
        total = sum(numbers(c.as_py()).astype(np.int64) for c in t["counts"])
        here = pa.array(start + np.flatnonzero(total))
        return pa.table([b["lang"].take(here), b["phrase"].take(here), total[total > 0]], ["lang", "phrase", "a"])

    return count, add


def count_phrases(level: DataFrame, candidates: DataFrame, trie_phrases: int, trie_bytes: int) -> DataFrame:
    """(lang, phrase, a): exact counts of the candidates in the blocks."""
    spark = level.sparkSession
    total = candidates.agg(F.count("*").alias("n"), F.sum(F.octet_length("phrase")).alias("size")).first()
    bundles = max(1, -(-total["n"] // trie_phrases), -(-(total["size"] or 0) // trie_bytes))
    dealt = candidates.withColumn("bundle", F.pmod(F.xxhash64("lang", "phrase"), F.lit(bundles)).cast("int"))
    dealt = keep(dealt.repartition("bundle"))
    out = None
    for k in range(bundles):
        # One bundle of bounded size at a time passes the driver.
        held = dealt.where(F.col("bundle") == k).select("lang", "phrase").toPandas()
        held = held.sort_values(["lang", "phrase"])
        bundle = spark.sparkContext.broadcast(build_trie(held["lang"].tolist(), held["phrase"].tolist()))
        del held

        count, add = _counting(bundle)
        part = _stored(level.select("lang", "words", "grams").mapInArrow(count, "start long, counts binary")
                       .groupBy("start").applyInArrow(add, "lang string, phrase string, a long"), "counts")
        bundle.unpersist()
        out = part if out is None else out.unionByName(part)
    return out


def _joined(words: Column, start, length) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def mine(df: DataFrame, *, text_col: str = "text", lang_col: str = "lang", least: int = 30, top: int = 2000,
         cover: int = 80, trie_phrases: int = TRIE_PHRASES, trie_bytes: int = TRIE_BYTES,
         spare_bits: int = SPARE_BITS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of every language.

    Texts are folded (A-Z), cut into pieces at ``.,;:!?`` and line ends, and
    these into words at spaces and tabs.  ``n``: words of the language; ``a``:
    occurrences of a phrase of 2 to 4 words within pieces, at least ``least``.
    Cut after its first words into a part that occurs l times and one that
    occurs r times it has the score floor(2,000,000 a / (l + r)); of its cuts
    the lowest counts, then the first.  A phrase within a longer one that
    occurs at least ``cover`` percent as often is dropped.  Order: score and a
    descending, then the phrase's UTF-8 bytes.

    Null texts are empty, a null language is ``und``.  Repeated rows and ids
    count each; a text of any length is within one block; an empty table and
    one without frequent phrases give no rows.
    """
    parts = blocks(df, text_col, lang_col)
    size = parts.agg(F.sum("n")).first()[0] or 0
    parcels = 1 + size // PARCEL_WORDS
    bits = min(63, spare_bits + size.bit_length())
    words = frequent_words(parts, least, parcels)
    level = first = only_frequent(parts, words)
    levels, named = {}, None
    for k in range(2, LONGEST + 1):
        levels[k] = level = longer(level, k - 1, least, bits, parcels)
        some = level.select(F.lit(k).alias("k"), "lang", F.explode("named").alias("x")).select("k", "lang", "x.*")
        named = some if named is None else named.unionByName(some)
    named = _stored(named, "named")
    counts = count_phrases(first, named.select("lang", "phrase"), trie_phrases, trie_bytes)
    shared = keep(named.join(counts, ["lang", "phrase"]).groupBy("k", "key", "total").agg(F.sum("a").alias("a"))
                  .where("a < total").select("k", "key"))
    if not shared.isEmpty():
        others = None
        for k, level in levels.items():
            some = all_named(level, k, bits).join(shared.where(F.col("k") == k), ["k", "key"], "left_semi")
            others = some if others is None else others.unionByName(some)
        others = keep(others.select("lang", "phrase").distinct().join(counts, ["lang", "phrase"], "left_anti"))
        counts = counts.unionByName(count_phrases(first, others, trie_phrases, trie_bytes))
    counts = keep(counts.where(F.col("a") >= least).withColumn("w", F.split("phrase", " ")))
    total = parts.groupBy("lang").agg(F.sum("n").alias("n"))
    times = (words.select("lang", F.explode("named").alias("x")).select("lang", "x.*")
             .unionByName(counts.select("lang", F.col("phrase").alias("text"), F.col("a").alias("f"))))
    cuts = (counts.select("lang", "phrase", "w", "a", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k"))
            .withColumn("left", _joined(F.col("w"), F.lit(1), F.col("k")))
            .withColumn("right", _joined(F.col("w"), F.col("k") + 1, F.size("w") - F.col("k"))))
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(times.select("lang", F.col("text").alias(side), F.col("f").alias(name)), ["lang", side])
    cuts = cuts.withColumn("score", F.expr("cast(2000000 as decimal(7,0)) * cast(a as decimal(19,0)) div (l + r)"))
    scored = (cuts.groupBy("lang", "phrase", "a")
              .agg(F.min_by(F.struct("l", "r", "score"), F.struct("score", "k")).alias("c"))
              .select("lang", "phrase", "a", "c.*"))
    within = F.flatten(F.transform(F.sequence(F.lit(2), F.size("w") - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.size("w") - m + 1), lambda i: _joined(F.col("w"), i, m))))
    covered = (counts.where(F.size("w") > 2).select("lang", F.explode(within).alias("phrase"), "a")
               .groupBy("lang", "phrase").agg(F.max("a").alias("longest")))
    per_lang = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (scored.join(covered, ["lang", "phrase"], "left")
            .where(F.col("longest").isNull()
                   | (F.col("longest").cast("decimal(19,0)") * 100 < F.col("a").cast("decimal(19,0)") * cover))
            .withColumn("rank", F.row_number().over(per_lang)).where(F.col("rank") <= top)
            .join(total, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))


def oracle_sql(least: int = 30, top: int = 2000, cover: int = 80) -> str:
    """DuckDB SQL of the phrases of ``documents``."""
    grams = " UNION ALL ".join(
        f"SELECT lang, {k} AS len, unnest(list_transform(range(1, len(w) - {k - 2}), "
        f"lambda i: array_to_string(w[i:i + {k - 1}], ' '))) AS text FROM pieces WHERE len(w) >= {k}"
        for k in range(1, LONGEST + 1))
    subs = " UNION ALL ".join(
        f"SELECT lang, array_to_string(w[{i}:{i + m - 1}], ' ') AS phrase, a FROM cand WHERE len = {k}"
        for k in range(3, LONGEST + 1) for m in range(2, k) for i in range(1, k - m + 2))
    cuts = " UNION ALL ".join(
        f"SELECT lang, phrase, a, {c} AS k, array_to_string(w[1:{c}], ' ') AS x, "
        f"array_to_string(w[{c + 1}:], ' ') AS y FROM cand WHERE len > {c}" for c in range(1, LONGEST))
    return f"""WITH cut AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
  translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
pieces AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM cut),
f AS MATERIALIZED (SELECT lang, len, text, count(*) AS f FROM ({grams}) GROUP BY ALL HAVING count(*) >= {least}),
total AS (SELECT lang, sum(len(w)) AS n FROM pieces GROUP BY lang),
cand AS MATERIALIZED (SELECT lang, len, text AS phrase, string_split(text, ' ') AS w, f AS a FROM f WHERE len > 1),
cuts AS (SELECT c.lang, c.phrase, c.a, c.k, p.f AS l, q.f AS r, (2000000::HUGEINT * c.a) // (p.f + q.f) AS score
  FROM ({cuts}) c JOIN f p ON (p.lang, p.text) = (c.lang, c.x) JOIN f q ON (q.lang, q.text) = (c.lang, c.y)),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
covered AS (SELECT lang, phrase, max(a) AS longest FROM ({subs}) GROUP BY ALL),
ranked AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM best b LEFT JOIN covered USING (lang, phrase) WHERE longest IS NULL OR 100 * longest < {cover} * a)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM ranked JOIN total USING (lang)
WHERE rank <= {top}"""
