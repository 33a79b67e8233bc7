"""Toxicity uses all evidence that was counted."""

import math
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import kneser_ney
from tessera.llm.queries import QUERIES
from tests.llm.test_classifiers import slow_codes


def slow_stats(text, grams, contexts):
    """The statistics of one text, n-gram by n-gram."""
    words = kneser_ney.words_of(text)
    if not words:
        return [0.0] * kneser_ney.N_STATS
    of = []
    for w in words:
        code = [int.from_bytes(s, "big") for s in slow_codes(w.decode())]
        of.append(sum(grams.get(c, contexts.get(c >> 8, 0.0)) for c in code))
    top = sorted(of, reverse=True)
    return ([sum(of) / sum(len(w) + 1 for w in words), np.mean([v > 3 for v in of]), math.log(len(words))]
            + [sum(top[:t]) / t for t in kneser_ney.TOP])


def test_scores_use_every_gram_and_context(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=9))
    texts = [" ".join(word() for _ in range(60)) for _ in range(100)] + [None, "", "12 !", "é" * 50, "seen " * 900]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    labels = docs.select("doc_id", (F.col("doc_id") % 3 == 0).cast("int").alias("toxic"))
    learn = F.col("__id") < 90
    model = kneser_ney.fit(docs, labels, learn=learn, calibration=F.col("__id") >= 60)
    counted = docs.join(labels, "doc_id").where("doc_id < 90")
    by_gram, by_context = kneser_ney.evidence(kneser_ney.count_grams(counted, "text", "toxic"))
    grams, contexts = ({r.code: r.llr for r in df.collect()} for df in (by_gram, by_context))
    got = {r.doc_id: r.score for r in kneser_ney.score(docs, model).collect()}
    assert got.keys() == set(range(len(texts)))
    for i, t in enumerate(texts):
        z = model.weights[0] + np.dot(slow_stats(t, grams, contexts), model.weights[1:])
        assert abs(got[i] - 1 / (1 + math.exp(-z))) < 1e-6, i


def test_chunks_do_not_change_scores(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"some words {'idiot' * (i % 2)} and word{chr(97 + i % 7)} more") for i in range(40)]
                                 + [(7, "twice"), (None, "no id")], "doc_id long, text string")
    labels = docs.where("doc_id is not null").select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    model = kneser_ney.fit(docs, labels, learn=F.lit(True), calibration=F.lit(True))

    def scores(df):
        return sorted((str(r.doc_id), r.score) for r in kneser_ney.score(df, model).collect())

    want = scores(docs.coalesce(1))
    monkeypatch.setattr(kneser_ney, "CHUNK_WORDS", 9)
    assert scores(docs.repartition(3)) == want


def test_every_learnable_fold_is_counted(spark, tmp_path):
    """Toxic words that only documents of fold 1 have are known to the model."""
    rng = random.Random(8)
    plain = ["river", "stone", "market", "window", "letter", "garden", "summer", "bridge", "candle", "harbour"]
    rows = []
    for i in range(400):
        f, y = zlib.crc32(str(i).encode()) % 5, i % 2
        bad = "zzqxav" if f in (0, 1) else "wkkopu"
        rows.append((i, " ".join(rng.choices(plain, k=12) + [bad] * (6 * y)), y))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    df.select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    df.select("doc_id", "toxic").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r.doc_id: r for r in QUERIES["op7_kneser_ney_toxicity"](spark, str(tmp_path)).collect()}
    held = [(got[i].predicted, y) for i, _, y in rows if got[i].held_out]
    assert len(held) > 40 and all(p == y for p, y in held)


def test_counts_add_up_over_folds(spark):
    docs = [("the idiot cat", 1, 3), ("the cat", 0, 3), ("the cat", 0, 1), ("an idiot", 1, 2), (None, 0, 4)]
    df = spark.createDataFrame(docs, "text string, y int, f int").repartition(3)
    whole = {(r.code, r.n0, r.n1) for r in kneser_ney.count_grams(df, "text", "y").collect()}
    parts = kneser_ney.count_grams(df, "text", "y", "f").groupBy("code").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    assert {(r.code, r.n0, r.n1) for r in parts.collect()} == whole


def test_a_fold_is_taken_off_the_whole(spark):
    """Evidence for a fold's keys equals that of class counts of the others."""
    rng = random.Random(6)
    docs = [(" ".join(rng.choices(["idiot", "cat", "stone", "idle", "car", "scum"], k=8)), rng.randrange(2), i % 3)
            for i in range(40)]
    df = spark.createDataFrame(docs, "text string, y int, f int")
    counted = kneser_ney.count_grams(df, "text", "y", "f")
    whole = counted.groupBy("code").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    full, ctx = kneser_ney.with_backoff(whole), kneser_ney.contexts(whole)
    keys = full.select("code").union(ctx.select(F.col("ctx").bitwiseOR(kneser_ney._CONTEXT))).toDF("key")
    asked = keys.select(F.explode(F.array(*[F.lit(f).cast("long") for f in (0, 1, 7)])).alias("fold"), "key")
    got = {(r.fold, r.key): r.v for r in kneser_ney.without_fold(asked, counted, full, ctx).collect()}
    for f in (0, 1, 7):
        rest = counted.where(F.col("fold") != f).groupBy("code").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
        rest = rest.join(full.select("code", "ctx", "p"), "code")
        want = {r.key: r.v for r in kneser_ney.keyed(*kneser_ney._evidence(
            rest, kneser_ney.contexts(rest), kneser_ney.DISCOUNT)).collect()}
        mine = {k: v for (g, k), v in got.items() if g == f}
        assert mine.keys() == want.keys() and all(abs(mine[k] - want[k]) < 1e-9 for k in want)


def test_chunks_take_less_room_than_their_texts(spark):
    """Before, the n-grams of every word were stored as numbers: 2.0 bytes for a byte of text here in all."""
    rng = random.Random(9)
    parts = [["".join(rng.choices("abcdefghijklmnoprstu", k=3)) for _ in range(24)] for _ in range(3)]
    words = [a + b + c for a in parts[0] for b in parts[1] for c in parts[2]]
    rng.shuffle(words)
    texts = [" ".join(words[i:i + 200]) for i in range(0, len(words), 200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    row = kneser_ney.chunks(docs, "text", {"doc_id": "doc_id"}).first()
    stored = sum(len(v) for v in row if isinstance(v, (bytes, bytearray)))
    assert stored < sum(map(len, texts)), stored / sum(map(len, texts))


def test_folds_are_counted_one_by_one(spark):
    """Before, the texts and counts of all folds were shuffled at once."""
    docs = spark.createDataFrame([(i, f"some words and word{chr(97 + i % 7)}") for i in range(60)] + [(None, "no id")],
                                 "__id long, __text string")
    known = spark.createDataFrame([(i, i % 2) for i in range(0, 60, 3)], "__id long, __y int")
    tables = kneser_ney.fold_counts(docs, known)
    of = [{r.fold for r in t.select("fold").distinct().collect()} for t in tables]
    assert sorted(map(sorted, of)) == [[f] for f in range(5)]
    joined = docs.join(known, "__id").withColumn("f", F.crc32(F.col("__id").cast("string").cast("binary")) % 5)
    want = {tuple(r) for r in kneser_ney.count_grams(joined, "__text", "__y", "f").collect()}
    assert {tuple(r) for t in tables for r in t.collect()} == want
