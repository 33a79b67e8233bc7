"""Language identification by a blended-spectrum string kernel.

k(a, b) is the number of n-grams (n = 1..4, letters lower-cased, all else one
space) present in both texts over the root of the product of how many each
has.  Landmark texts give the Nyström features K(x, landmarks) K_mm^-1/2, on
which one-versus-rest ridge regression is solved; whole batches are scored by
matrix products.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import fold, map_texts

#: n-grams are numbered by a hash of so many bits.
BITS = 18


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Code point -> code point of its lower-case letter, 0 for non-letters."""
    table = np.zeros(sys.maxunicode + 1, np.uint32)
    for c in range(sys.maxunicode + 1):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def grams(text: str | None, longest: int = 4) -> np.ndarray:
    """Numbers of the text's n-grams, repeats included; none without a letter."""
    if not text:
        return np.empty(0, np.int64)
    c = _letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    if not c.any():
        return np.empty(0, np.int64)
    # runs of other characters are one space; one stands at either end
    c = np.concatenate([[0], c, [0]]).astype(np.uint64)
    blank = c == 0
    c = c[~(blank & np.append(False, blank[:-1]))] + np.uint64(1)
    out, h = [c[c > 1]], c
    for n in range(2, longest + 1):
        h = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + c[n - 1:]
        out.append(h)
    h = np.concatenate(out) * np.uint64(0xD6E8FEB86659FD93)
    return (h >> np.uint64(64 - BITS)).astype(np.int64)


@dataclass
class Kernel:
    langs: list[str]
    #: n-grams that some landmark has, and landmarks over them (0/1, scaled)
    vocab: np.ndarray
    landmarks: np.ndarray
    #: landmark kernel values -> one-versus-rest outputs
    weights: np.ndarray
    _seen: np.ndarray = field(default_factory=lambda: np.zeros(1 << BITS, bool), repr=False)

    def presence(self, gram_lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Texts by vocabulary (0/1), and how many distinct n-grams each has."""
        out = np.empty((len(gram_lists), len(self.vocab)), np.float32)
        n = np.empty(len(gram_lists))
        for i, g in enumerate(gram_lists):
            self._seen[g] = True
            out[i] = self._seen[self.vocab]
            n[i] = np.count_nonzero(self._seen)
            self._seen[g] = False
        return out, n

    def kernel(self, gram_lists: list[np.ndarray]) -> np.ndarray:
        """k(text, landmark), texts by landmarks."""
        p, n = self.presence(gram_lists)
        return (p @ self.landmarks.T) / np.sqrt(np.maximum(n, 1))[:, None]

    def predict(self, texts: list) -> tuple[list[str], np.ndarray]:
        """Language and score in 0..1 (a softmax of the outputs)."""
        langs, scores = [], []
        for i in range(0, len(texts), 256):
            g = [grams(t) for t in texts[i:i + 256]]
            if not self.langs:
                langs += ["und"] * len(g)
                scores += [0.0] * len(g)
                continue
            out = self.kernel(g) @ self.weights
            e = np.exp(8.0 * (out - out.max(axis=1, keepdims=True)))
            e /= e.sum(axis=1, keepdims=True)
            best = e.argmax(axis=1)                # ties: the first in order of name
            for j, x in enumerate(g):
                langs.append(self.langs[best[j]] if len(x) else "und")
                scores.append(float(e[j, best[j]]) if len(x) else 0.0)
        return langs, np.array(scores)


def train(landmarks: list[np.ndarray], texts: list[np.ndarray], langs: list[str],
          ridge: float = 1e-2) -> Kernel:
    """Fit on the n-grams of the landmark texts and of the learned texts."""
    names = sorted(set(langs))
    sets = [np.unique(g) for g in landmarks]
    vocab = np.unique(np.concatenate(sets)) if sets else np.empty(0, np.int64)
    marks = np.zeros((len(sets), len(vocab)), np.float32)
    for i, s in enumerate(sets):
        marks[i, np.searchsorted(vocab, s)] = 1.0 / np.sqrt(len(s))
    model = Kernel(names, vocab, marks, np.zeros((len(sets), len(names))))
    if not sets or not names:
        return Kernel([], vocab, marks, np.zeros((len(sets), 0)))
    kmm = marks.astype(float) @ marks.T
    value, vector = np.linalg.eigh(kmm)
    root = vector[:, value > 1e-6] / np.sqrt(value[value > 1e-6])
    phi = np.concatenate([model.kernel(texts[i:i + 256]) for i in range(0, len(texts), 256)]) @ root
    y = (np.array(langs)[:, None] == np.array(names)[None, :]).astype(float)
    model.weights = root @ np.linalg.solve(phi.T @ phi + ridge * np.eye(phi.shape[1]), phi.T @ y)
    return model


def fit(documents: DataFrame, *, learn: Column | None = None, per_lang: int = 200,
        marks: int = 160, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang") -> Kernel:
    """Fit on a bounded sample of whole documents: of each language the at most
    ``per_lang`` ids of smallest hash among those ``learn`` (a condition on
    ``__id``) allows; the first of them, ``marks`` over all languages, are the
    landmarks.  The id list is bounded by per_lang times the languages; of an
    id with several texts the smallest counts."""
    learn = F.lit(True) if learn is None else learn
    # Distinct ids are ranked, and an id gives one text however many rows bear it.
    ids = (documents.select(F.col(id_col).alias("__id"), F.col(lang_col).cast("string").alias("lang"))
           .where(F.col("lang").isNotNull() & F.col("__id").isNotNull()).where(learn).distinct())
    by = Window.partitionBy("lang").orderBy(F.xxhash64(F.col("__id").cast("string")), "__id")
    picked = ids.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= per_lang)
    docs = (documents.select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("text"),
                             F.col(lang_col).cast("string").alias("lang"))
            .join(F.broadcast(picked), ["__id", "lang"])
            .groupBy("__id", "lang", "rank").agg(F.min("text").alias("text")))
    got = map_texts(docs, "text", {"lang": "lang", "rank": "rank"},
                    [T.StructField("grams", T.ArrayType(T.IntegerType()))],
                    lambda texts: {"grams": [np.unique(grams(t)).tolist() for t in texts]})
    rows = sorted(((r["lang"], r["rank"], np.array(r["grams"], np.int64)) for r in got.collect()
                   if r["grams"]), key=lambda r: (r[0], r[1], r[2].tobytes()))
    n = max(1, marks // max(1, len({r[0] for r in rows})))
    return train([r[2] for r in rows if r[1] <= n] or [r[2] for r in rows],
                 [r[2] for r in rows], [r[0] for r in rows])


def identify(documents: DataFrame, model: Kernel, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row.

    ``held_out``: crc32 of the id's text modulo 3 is 1 (false for a null id).
    ``lang_pred`` is a learned language, ``und`` with score 0 for a null text
    or one without a letter, and for any text if nothing was learned.
    Repeated rows are predicted alike; an empty table gives no rows.
    """
    def work(texts: list) -> dict:
        langs, scores = model.predict(texts)
        return {"lang_pred": langs, "score": scores}

    out = map_texts(documents, text_col, {"doc_id": id_col},
                    [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())], work)
    return out.select("doc_id", F.coalesce(fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
                      "lang_pred", "score")
