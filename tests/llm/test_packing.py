"""Packing operators: exact round trips against the tokenizers library."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import bfd_pack, kk_pack

DOCS = [(1, "A first text, not long."), (2, None), (3, ""), (4, "word " * 3000), (5, "<|endoftext|> \n\n é漢字"),
        (5, "<|endoftext|> \n\n é漢字"), (None, "no id"), (7, "x" * 5000)] + [
    (100 + i, f"text {i} " * (i % 97)) for i in range(300)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "clash", 1) for i, t in DOCS],
                                 "doc_id long, text string, ids string, offset int").repartition(3)


def reference_ids(texts, end_id, plain=False):
    """Ids by the vocabulary's tokenizer: as it comes (``plain``), or with the
    strings of special tokens as ordinary text."""
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = not plain
    return [e.ids + [end_id] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_pieces_give_back_every_id(docs):
    rows = kk_pack.pack(docs, windows=8).collect()
    want = sorted((i is None, i, ids) for (i, _), ids in zip(DOCS, reference_ids([t for _, t in DOCS], 0, plain=True)))
    got: dict = {}
    for r in sorted(rows, key=lambda r: (r.start, r.sequence_id)):
        got.setdefault((r.doc_id, r.doc_tokens, r.start), []).append(list(np.frombuffer(bytes(r.ids), "<u4")))
        assert r.length == len(r.ids) // 4
    for none, i, ids in want:
        mine, at = [], 0
        while at < len(ids):
            piece = got[i, len(ids), at][0]
            if i != 5:                       # a repeated row: either copy's pieces are the same ids
                got[i, len(ids), at].pop(0)
            mine += piece
            at += len(piece)
        assert mine == ids
    assert sum(r.length for r in rows) == sum(len(w[2]) for w in want)


def test_sequences_are_gapless_and_bounded(docs):
    by: dict = {}
    for r in kk_pack.pack(docs).collect():
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= 1024


def test_little_padding(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    per = kk_pack.pack(docs).groupBy("sequence_id").sum("length").toPandas().iloc[:, 1]
    assert per.max() <= 1024
    assert per.sum() / (1024 * len(per)) > 0.98


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 128), min_size=1, max_size=400), st.integers(1, 12))
def test_difference_splits_all_items(sizes, k):
    groups = kk_pack.difference(np.array(sizes), k)
    assert len(groups) == k
    assert sorted(i for g in groups for i in g) == list(range(len(sizes)))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 128), min_size=1, max_size=400))
def test_window_count_rises_until_all_fit(sizes):
    a = np.array(sizes)
    groups = kk_pack.windows_for(a, 256, 4)
    assert all(a[g].sum() <= 256 for g in groups)
    assert sorted(i for g in groups for i in g) == list(range(len(sizes)))


def test_differencing_is_near_equal():
    a = np.random.default_rng(1).integers(1, 129, 1000)
    sums = [a[g].sum() for g in kk_pack.difference(a, 60)]
    assert max(sums) - min(sums) <= 16


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert kk_pack.pack(empty).count() == 0
    assert bfd_pack.pack_matrices(empty).count() == 0


def test_only_empty_texts(spark):
    docs = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert sum(r.length for r in kk_pack.pack(docs).collect()) == 2


def brute_best_fit(sizes, capacity):
    rooms, out = [], []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fits = [b for b, r in enumerate(rooms) if r >= sizes[i]]
        if not fits:
            rooms.append(capacity)
            out.append([])
            fits = [len(rooms) - 1]
        b = min(fits, key=lambda b: rooms[b])
        rooms[b] -= sizes[i]
        out[b].append(i)
    return sorted(rooms)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=120))
def test_tree_search_is_best_fit(sizes):
    bins = bfd_pack.best_fit_decreasing(sizes, 64)
    rooms = sorted(64 - sum(sizes[i] for i in b) for b in bins)
    assert rooms == brute_best_fit(sizes, 64)
    assert sorted(i for b in bins for i in b) == list(range(len(sizes)))


def test_matrices_give_back_every_id(docs):
    rows = bfd_pack.pack_matrices(docs, end_id=0, pad_id=9).collect()
    found: dict = {}
    for r in rows:
        ids = np.frombuffer(bytes(r.input_ids), "<u4")
        pos = np.frombuffer(bytes(r.position_ids), "<u4")
        assert len(ids) == len(pos) == 1024 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens
        assert (ids[r.n_tokens:] == 9).all()
        for d, s, a, b in zip(r.doc_ids, r.starts, r.cu_seqlens, r.cu_seqlens[1:]):
            assert (pos[a:b] == np.arange(b - a)).all()
            found.setdefault((d, s), []).append(ids[a:b].tolist())
    for (i, _), ids in zip(DOCS, reference_ids([t for _, t in DOCS], 0)):
        mine, at = [], 0
        while at < len(ids):
            piece = found[i, at][0]
            if i != 5:
                found[i, at].pop(0)
            mine += piece
            at += len(piece)
        assert mine == ids
    assert len({r.sequence_id for r in rows}) == len(rows)


def test_digest_query(spark):
    from tessera.llm.queries import QUERIES
    rows = QUERIES["op10_kk_packing"](spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    ids = dict(zip(texts, reference_ids(list(texts.values()), 0)))
    for r in rows:
        mine = np.array(ids[r.doc_id][r.start:r.start + r.length], "<u4").tobytes()
        assert zlib.crc32(mine) == r.ids_crc32 and len(ids[r.doc_id]) == r.doc_tokens
