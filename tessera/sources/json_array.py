"""One large JSON document, ``{"meta": ..., "data": [...]}`` or a bare array,
read by many tasks (S7).

A JSON document has no safe place to cut, as a byte may lie within a string, so
the file is read in byte ranges three times.  First every range says how it
would change the lexer's state (within a string or not, and the depth) for
either state it may begin in; put one after the other, these give the state at
every range's start.  Then the ranges say which top-level key they leave, and
whether an element begins or ends in them.  At last each range cuts its
elements; the pieces of those that cross ranges are joined.  The driver sees a
few numbers per range.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A string (perhaps cut off by the range's end), or what changes or parts levels.
_TOKEN = re.compile(rb'"(?:[^"\\]|\\.)*(?:"|\Z)|[\[\]{},]', re.DOTALL)
_REST_OF_STRING = re.compile(rb'(?:[^"\\]|\\.)*(?:"|\Z)', re.DOTALL)


def _tokens(text: bytes, within: bool) -> Iterator[tuple[int, bytes]]:
    """(start, token) outside strings, and whole strings; ``within``: the text
    begins inside a string, whose rest is skipped."""
    at = _REST_OF_STRING.match(text).end() if within else 0
    for m in _TOKEN.finditer(text, at):
        yield m.start(), m[0]


def _ends_within(text: bytes, within: bool) -> bool:
    """Whether the text's end lies inside a string."""
    at = 0
    if within:
        at = _REST_OF_STRING.match(text).end()
        if at == len(text) and not _closed(b'"' + text):
            return True
    last = None
    for _, last in _tokens(text, within):
        pass
    return last is not None and last[:1] == b'"' and not _closed(last)


def _closed(string: bytes) -> bool:
    """Whether a string token has its closing quote."""
    if len(string) < 2 or string[-1:] != b'"':
        return False
    back = len(string) - 1 - len(string[:-1].rstrip(b"\\"))
    return back % 2 == 0


def _depth(text: bytes, within: bool) -> int:
    return sum((t in b"[{") - (t in b"]}") for _, t in _tokens(text, within) if len(t) == 1 and t != b",")


def _walk(text: bytes, within: bool, depth: int, key: str | None, field: str, inner: int):
    """(kind, start, end, key) of what matters: ``key`` for a top-level key, and
    ``cut`` for what begins, parts or ends the elements of ``field``'s array,
    whose elements lie ``inner`` levels deep (1: the document is the array)."""
    for at, t in _tokens(text, within):
        if t[:1] == b'"':
            if depth == 1 and inner == 2 and re.match(rb"\s*:", text[at + len(t):at + len(t) + 64]):
                key = json.loads(t)
                yield "key", at, at + len(t), key
            continue
        here = inner == 1 or key == field
        if t in b"[{":
            depth += 1
            if t == b"[" and depth == inner and here:
                yield "cut", at, at + 1, key
        elif t in b"]}":
            depth -= 1
            if t == b"]" and depth == inner - 1 and here:
                yield "cut", at, at + 1, key
        elif depth == inner and here:
            yield "cut", at, at + 1, key


def read_json_array(spark: SparkSession, path: str, schema: T.StructType | str, field: str = "data") -> DataFrame:
    """The elements of the array ``field`` of the document at ``path`` (or of
    the document itself, if it is an array) as rows of ``schema``, as many
    tasks reading as the file has splits.

    What isn't an object gives a row of NULLs, as ``from_json`` has it.  Several
    files may be read at once.  A compressed file is one range.
    """
    ranges = (spark.read.option("lineSep", "}").text(path)
              .select("_metadata.file_path", F.col("_metadata.file_block_start").alias("start"),
                      F.col("value").cast("binary").alias("value")))

    def per_range(work, schema: str) -> DataFrame:
        """``work(path, start, text)`` of every range; the reader's separators put back."""
        names = [column.split()[0] for column in schema.split(", ")]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, at = [], None

            def out() -> Iterator[pa.RecordBatch]:
                rows = list(work(*at, b"}".join([*held, b""])))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names) if rows else None

            for b in batches:
                for p, s, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                    if at != (p, s):
                        if at is not None:
                            yield from filter(None, out())
                        held, at = [], (p, s)
                    held.append(v)
            if at is not None:
                yield from filter(None, out())

        return ranges.mapInArrow(run, schema)

    def transitions(p: str, s: int, text: bytes) -> Iterator[tuple]:
        first = text.lstrip()[:1]
        yield (p, s, first == b"[", *[x for w in (False, True) for x in (_ends_within(text, w), _depth(text, w))])

    state: dict[tuple, tuple] = {}
    before = None
    for r in sorted(per_range(transitions, "path string, start long, is_array boolean, in0 boolean, d0 long, in1 boolean, "
                              "d1 long").collect(), key=lambda r: (r.path, r.start)):
        if before is None or before[0] != r.path:
            before = (r.path, False, 0, 1 if r.is_array else 2)
        _, within, depth, inner = before
        state[r.path, r.start] = (within, depth, inner)
        before = (r.path, r.in1, depth + r.d1, inner) if within else (r.path, r.in0, depth + r.d0, inner)

    def keys(p: str, s: int, text: bytes) -> Iterator[tuple]:
        within, depth, inner = state[p, s]
        # Cuts before the range's first key belong to the key it begins with.
        first, cuts, last = 0, 0, None
        for kind, _, _, key in _walk(text, within, depth, field, field, inner):
            if kind == "key":
                last = key
            elif last is None:
                first += 1
            else:
                cuts += 1
        yield p, s, first, cuts, last or ""

    begins: dict[tuple, tuple] = {}
    path_of = key = since = None
    for r in sorted(per_range(keys, "path string, start long, first long, cuts long, last string").collect(),
                    key=lambda r: (r.path, r.start)):
        if path_of != r.path:
            path_of, key, since = r.path, None, None
        within, depth, inner = state[r.path, r.start]
        begins[r.path, r.start] = (within, depth, inner, key, since)
        if r.cuts or (r.first and (inner == 1 or key == field)):
            since = r.start
        key = r.last or key

    def elements(p: str, s: int, text: bytes) -> Iterator[tuple]:
        within, depth, inner, key, since = begins[p, s]
        # ``of``: where the element begins that a piece belongs to; -1 for a whole one.
        open_ = depth >= inner and (inner == 1 or key == field)
        at, of = 0, since
        for kind, start, end, _ in _walk(text, within, depth, key, field, inner):
            if kind == "key":
                continue
            if open_ and text[start:end] in (b",", b"]"):
                yield p, -1 if at else of, s, text[at:start].decode()
            open_, at, of = text[start:end] != b"]", end, s
        if open_:
            yield p, of, s, text[at:].decode()

    pieces = per_range(elements, "path string, of long, start long, text string")
    crossing = (pieces.where("of >= 0").groupBy("path", "of")
                .agg(F.sort_array(F.collect_list(F.struct("start", "text"))).alias("x"))
                .select(F.array_join(F.col("x.text"), "").alias("text")))
    whole = pieces.where("of < 0").select("text").unionByName(crossing).where(F.trim(F.translate("text", "\n\r\t", "")) != "")
    return whole.select(F.from_json("text", schema).alias("e")).select("e.*")
