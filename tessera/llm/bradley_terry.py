"""Quality scores by Bradley-Terry pairwise ranking.

A document's score is linear in features of its whole text; the weights
maximise the likelihood that the document marked 1 beats the one marked 0 over
preference pairs, i.e. logistic loss on feature differences.  Every labelled
document takes part in pairs (all pairs would be quadratic).  The threshold is
a quantile of all labelled documents' scores: the share of those marked 0.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import fold, keep, map_texts, sigmoid

_SYMBOLS = b"#*$%&|<>"
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_LETTER = re.compile(r"[^\W\d_]")
_ASCII_UPPER = bytes(range(65, 91))
_ASCII_LOWER = bytes(range(97, 123))
_DIGITS = bytes(range(48, 58))


def _without(data: bytes, drop: bytes) -> int:
    """How many bytes of ``data`` are in ``drop``."""
    return len(data) - len(data.translate(None, drop))


def features(text: str | None) -> np.ndarray:
    """Shape of a whole text, length-normalised; zeros for null and empty."""
    data = (text or "").encode()
    words = data.split()
    n = len(words)
    if not n:
        return np.zeros(N_FEATURES)
    size = len(data)
    upper, lower = _without(data, _ASCII_UPPER), _without(data, _ASCII_LOWER)
    counts = Counter(words)
    lines = [x for x in data.split(b"\n") if x and not x.isspace()]
    lengths = np.fromiter(map(len, words), np.int64, n)
    same = sum(map(bytes.__eq__, words, words[1:]))
    pairs = len(set(zip(words, words[1:])))
    return np.array([
        np.log1p(n), lengths.mean(), lengths.std(), lengths.max(),
        _without(data, _SYMBOLS) / size, data.count(b"|") / n, data.count(b"!") / n,
        upper / (upper + lower + 1), _without(data, _DIGITS) / size,
        len(counts) / n, max(counts.values()) / n, same / n, (pairs + 1) / n,
        np.log1p(len(lines)), np.log1p(size / (len(lines) + 1)),
        1 - len(set(lines)) / max(1, len(lines)),
        (lengths <= 3).mean(), (lengths == 1).mean(),
        (data.count(b".") + data.count(b"?")) / n, data.count(b",") / n,
        (size - lower - upper - data.count(b" ")) / size,
        (data.count(b"@") + data.count(b"://") + data.count(b"{") + data.count(b"=")) / n,
    ])


N_FEATURES = 22


@dataclass
class Ranker:
    """``edges``: per feature the inner bin bounds; ``weights``: one per bin."""
    edges: list[np.ndarray]
    weights: np.ndarray
    threshold: float          # raw score at the quantile
    cut: float                # the probability that the threshold is mapped to

    def codes(self, x: np.ndarray) -> np.ndarray:
        """Per row the bin of each feature."""
        return np.column_stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)]
                               ).astype(np.uint8)

    def one_hot(self, codes: np.ndarray) -> np.ndarray:
        at = np.cumsum([0] + [len(e) + 1 for e in self.edges[:-1]])
        out = np.zeros((len(codes), len(self.weights)))
        out[np.arange(len(codes))[:, None], codes + at] = 1.0
        return out

    def design(self, x: np.ndarray) -> np.ndarray:
        return self.one_hot(self.codes(x))

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.design(x) @ self.weights

    def scores(self, texts: list) -> np.ndarray:
        x = np.array([features(t) for t in texts]).reshape(len(texts), N_FEATURES)
        return sigmoid(self.raw(x) - self.threshold + np.log(self.cut / (1 - self.cut)))


#: Pairs that a document is in at least.
ROUNDS = 2
#: Documents that meet in a block to be paired: of the commoner label at most
#: about, of the rarer label at least about.
BLOCK, LEAST = 20_000, 500
#: Probabilities count in units of 2^-20, so that sums over up to 2^33 pairs
#: are exact, in whatever order.
_UNIT = 2.0 ** 20
#: Scores whose quantile is taken are told apart by so much.
_CELL = 2.0 ** -10
#: Blocks' sums that one task adds up on their way to the driver.
_FAN = 32


def _quantile_edges(value: np.ndarray, count: np.ndarray, bins: int) -> np.ndarray:
    """The inner bounds of ``bins`` bins of about equal counts."""
    if not len(value):
        return np.empty(0)
    order = np.argsort(value)
    upto = np.cumsum(count[order])
    return np.unique(value[order][np.searchsorted(upto, np.linspace(0, 1, bins + 1)[1:-1] * upto[-1])])


def _ranker(edges: list[np.ndarray], cut: float) -> Ranker:
    return Ranker(edges, np.zeros(sum(len(e) + 1 for e in edges)), 0.0, cut)


def _slopes(model: Ranker, w: np.ndarray, good: np.ndarray, bad: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and second derivatives of the pairs' loss, in units.  The codes
    of either label are paired in turn; each has ``ROUNDS`` pairs or more."""
    grad, hess = np.zeros(len(w)), np.zeros((len(w), len(w)))
    if not len(good) or not len(bad):
        return grad, hess
    most = max(len(good), len(bad))
    for r in range(ROUNDS):
        for i in range(0, most, 4096):
            at = np.arange(i, min(i + 4096, most))
            diff = model.one_hot(good[at % len(good)]) - model.one_hot(bad[(at + r) % len(bad)])
            p = sigmoid(diff @ w)
            grad += diff.T @ np.rint((p - 1) * _UNIT)
            hess += (diff * np.rint(p * (1 - p) * _UNIT)[:, None]).T @ diff
    return grad, hess


def _newton(slopes: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]], w: np.ndarray, l2: float) -> np.ndarray:
    """The weights at which the penalised loss of all pairs is least."""
    for _ in range(25):
        grad, hess = slopes(w)
        step = np.linalg.solve(hess / _UNIT + l2 * np.eye(len(w)), grad / _UNIT + l2 * w)
        w = w - step
        if np.abs(step).max() < 1e-4:
            break
    return w


def _threshold(raw: np.ndarray, mass: np.ndarray, share: float, cell: float = 0.0) -> float:
    """Between the scores below which ``share`` of the mass lies and the next;
    scores stand for all up to ``cell`` above."""
    order = np.argsort(raw, kind="stable")
    at = min(int(np.searchsorted(np.cumsum(mass[order]), share)), len(order) - 1)
    after = min(at + 1, len(order) - 1)
    return float((raw[order[at]] + cell + raw[order[after]]) / 2)


def train(x: np.ndarray, y: np.ndarray, share_bad: float, *, cut: float = 0.3, bins: int = 8,
          l2: float = 1.0) -> Ranker:
    """Fit on features ``x`` and labels ``y``, every row of them.  Without both
    labels there is no preference, and every score equals ``cut``."""
    model = _ranker([_quantile_edges(*np.unique(x[:, j], return_counts=True), bins)
                     for j in range(N_FEATURES)], cut)
    good, bad = y == 1, y == 0
    if not good.any() or not bad.any():
        return model
    codes = model.codes(x)
    model.weights = _newton(lambda w: _slopes(model, w, codes[good], codes[bad]), model.weights, l2)
    # Rows may hold more of either label than its share; weigh them to the share.
    mass = np.where(bad, share_bad / bad.sum(), (1 - share_bad) / good.sum())
    model.threshold = _threshold(model.raw(x), mass, share_bad)
    return model


def _matrix(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), N_FEATURES)


def _counted(df: DataFrame, key: Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray]]):
    """(group, value, rows of them) of the pairs that ``key`` makes of ``df``,
    counted by tasks before they are shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            group, value = key(b)
            (group, value), n = np.unique(np.stack([group, value]), axis=1, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(group), pa.array(value), pa.array(n)], ["g", "v", "n"])

    return (df.mapInArrow(run, "g double, v double, n long").groupBy("g", "v")
            .agg(F.sum("n").alias("n")).toPandas())


def _labelled(documents: DataFrame, labels: DataFrame, label: str, learn: Column, id_col: str,
              text_col: str) -> DataFrame:
    """(id, y, x): the features of every labelled document that ``learn``
    allows, written once.  An id with several label rows counts with its largest
    label, one with several texts with the text of the smallest hash."""
    ids = (labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull())
           .groupBy(F.col(id_col).alias("__id")).agg(F.max(label).cast("int").alias("y"))
           .where(learn & F.col("y").isin(0, 1)))
    docs = documents.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text")).where(
        learn & F.col("__id").isNotNull())
    made = map_texts(docs, "text", {"__id": "__id", "h": F.xxhash64(F.col("text").cast("string"))},
                     [T.StructField("x", T.ArrayType(T.DoubleType()))],
                     lambda texts: {"x": [features(t).tolist() for t in texts]})
    one = made.groupBy("__id").agg(F.min(F.struct("h", "x")).alias("best"))
    return keep(one.join(ids, "__id").select(F.col("__id").cast("string").alias("id"), "y", "best.x"))


def _blocks(rows: DataFrame, model: Ranker, n: dict[int, int]) -> tuple[DataFrame, int]:
    """(good, bad) codes of blocks of documents, written once, and how many
    blocks there are.  Where the rarer label has too few documents for every
    block, each is in several."""
    blocks = -(-max(n.values()) // BLOCK)
    rare = min((0, 1), key=lambda v: n[v])
    copies = min(blocks, -(-LEAST * blocks // n[rare]))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [c.tobytes() for c in model.codes(_matrix(b.column("x")))]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("y"), pa.array(made, pa.binary())],
                                             ["id", "y", "code"])

    def pack(t: pa.Table) -> pa.Table:
        t = t.sort_by([("h", "ascending"), ("id", "ascending")])
        y, code = t["y"].to_numpy(), np.array(t["code"].to_pylist(), object)
        return pa.table({name: pa.array([b"".join(code[y == v])], pa.binary()) for name, v in (("good", 1), ("bad", 0))})

    dealt = (rows.mapInArrow(code, "id string, y int, code binary").withColumn("h", F.xxhash64("id"))
             .withColumn("copy", F.explode(F.sequence(F.lit(0), F.when(F.col("y") == rare, copies - 1).otherwise(0))))
             .withColumn("block", F.pmod(F.xxhash64("h") + F.col("copy"), F.lit(blocks))))
    return keep(dealt.groupBy("block").applyInArrow(pack, "good binary, bad binary")), blocks


def _summed(blocks: DataFrame, n_blocks: int, model: Ranker, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``_slopes`` over all blocks."""
    schema = "part int, grad array<double>, hess array<double>"

    def row(part: int, grad: np.ndarray, hess: np.ndarray) -> dict:
        return {"part": pa.array([part], pa.int32()), "grad": pa.array([grad]), "hess": pa.array([hess.ravel()])}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        grad, hess = np.zeros(len(w)), np.zeros((len(w), len(w)))
        for b in batches:
            for pair in zip(*(b.column(c).to_pylist() for c in ("good", "bad"))):
                g, h = _slopes(model, w, *(np.frombuffer(c, np.uint8).reshape(-1, N_FEATURES) for c in pair))
                grad, hess = grad + g, hess + h
        if hess.any():
            yield pa.RecordBatch.from_pydict(row(TaskContext.get().partitionId() // _FAN, grad, hess))

    def add(t: pa.Table) -> pa.Table:
        return pa.table(row(t["part"][0].as_py(), *(sum(np.array(v.as_py()) for v in t[c]) for c in ("grad", "hess"))))

    sums = blocks.mapInArrow(run, schema)
    if n_blocks > _FAN:
        sums = sums.groupBy("part").applyInArrow(add, schema)
    got = sums.toPandas()
    return (np.sum([np.asarray(g) for g in got["grad"]], axis=0),
            np.sum([np.asarray(h) for h in got["hess"]], axis=0).reshape(len(w), len(w)))


def fit(documents: DataFrame, labels: DataFrame, *, label: str = "quality", learn: Column | None = None,
        cut: float = 0.3, bins: int = 8, l2: float = 1.0, id_col: str = "doc_id", text_col: str = "text") -> Ranker:
    """Fit on every labelled document that ``learn`` (a condition on ``__id``)
    allows: bounds of bins, weights and threshold.  To the driver come counts of
    features at 9 binary digits, sums over pairs and counts of scores at 2^-10.
    The share of label 0 counts all labels that ``learn`` allows."""
    learn = F.lit(True) if learn is None else learn
    rows = _labelled(documents, labels, label, learn, id_col, text_col)

    def rounded(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        x = _matrix(b.column("x"))
        part, power = np.frexp(x)
        return np.tile(np.arange(N_FEATURES, dtype=float), len(x)), np.ldexp(np.floor(part * 512), power - 9).ravel()

    seen = _counted(rows.select("x"), rounded)
    values = [seen[seen["g"] == j] for j in range(N_FEATURES)]
    model = _ranker([_quantile_edges(v["v"].to_numpy(), v["n"].to_numpy(), bins) for v in values], cut)
    n = {0: 0, 1: 0} | {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    if not all(n.values()):
        return model
    blocks, n_blocks = _blocks(rows, model, n)
    model.weights = _newton(lambda w: _summed(blocks, n_blocks, model, w), model.weights, l2)
    share = (labels.where(F.col(label).isNotNull())
             .select(F.col(id_col).alias("__id"), F.col(label).alias("y")).where(learn)
             .agg(F.avg((F.col("y") == 0).cast("double"))).first()[0])
    share = float(share or 0.0)
    raw = _counted(rows.select("y", "x"), lambda b: (
        b.column("y").to_numpy().astype(float), np.floor(model.raw(_matrix(b.column("x"))) / _CELL) * _CELL))
    mass = raw["n"] * np.where(raw["g"] == 0, share / n[0], (1 - share) / n[1])
    cells = mass.groupby(raw["v"]).sum()
    model.threshold = _threshold(cells.index.to_numpy(), cells.to_numpy(), share, _CELL)
    return model


def score(documents: DataFrame, model: Ranker, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row.

    ``held_out``: crc32 of the id's text is a multiple of 5 (false for a null
    id).  ``score`` in 0..1, higher for likelier label 1; null and empty texts
    have the score of all-zero features.  ``predicted`` = score >= model.cut.
    Repeated rows are scored alike; an empty table gives no rows.
    """
    out = map_texts(documents, text_col, {"doc_id": id_col}, [T.StructField("score", T.DoubleType())],
                    lambda texts: {"score": model.scores(texts)})
    return out.select("doc_id", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
                      "score", (F.col("score") >= model.cut).cast("int").alias("predicted"))
