"""Quality rules by line sequence labelling.

Each line of a text is content or boilerplate.  A linear-chain conditional
random field over simple line features is trained here, on lines that plain
rules mark (repeated lines, symbol runs, capitals, word repetition, legal and
navigation phrases); Viterbi decoding then labels whole texts, so that a line's
neighbours count as well, and the content's share of the characters decides.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import hashed_sample, map_texts

_SPACE = b" \t\n\r\x0b\x0c"
_SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(65, 91))
_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256))
_DIGITS = bytes(range(48, 58))
#: Phrases of notices and navigation, lower case.
PHRASES = (b"copyright", b"all rights reserved", b"licensed under", b"license,", b"released under",
           b"terms of use", b"privacy policy", b"cookie", b"subscribe", b"click here", b"sign in",
           b"log in", b"read more", b"share this")
#: Training sequences are runs of at most so many lines.
RUN = 256


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    if not text:
        return 0, 0, 0, 0, 0
    data = text.encode()
    words = data.split()
    chars = len(text) - (len(data) - len(data.translate(None, _SPACE)))
    symbols = len(data) - len(data.translate(None, _SYMBOLS))
    lines = [x for x in data.split(b"\n") if x and not x.isspace()]
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeat_words(words)


def repeat_words(words: list[bytes], width: int = 8) -> int:
    """Words in ``width``-word windows (a power of two) that occur twice or more."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    x = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    with np.errstate(over="ignore"):
        h = np.zeros(n, np.int64)
        for i in range(width):
            h = h * np.int64(-7046029254386353131) + x[i:i + n]
    h.sort()
    if not (h[1:] == h[:-1]).any():
        return 0
    step = 1
    while step < width:                  # exact names of ever longer windows
        pair = x[:len(x) - step] * (int(x.max()) + 1) + x[step:]
        x = np.unique(pair, return_inverse=True)[1].astype(np.int64)
        step *= 2
    again = np.bincount(x)[x] > 1
    edge = np.zeros(len(words) + 1, np.int64)
    edge[:n] += again
    edge[width:] -= again
    return int((np.cumsum(edge)[:-1] > 0).sum())


def line_features(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(features, marks) of the lines of one text: 0/1 features, a bias among
    them, and the training rules' mark (1: boilerplate)."""
    x = np.zeros((len(lines), N_FEATURES), np.int8)
    mark = np.zeros(len(lines), np.int8)
    seen: set[bytes] = set()
    for i, line in enumerate(lines):
        words = line.split()
        n, size = len(words), len(line)
        symbols = (size - len(line.translate(None, _SYMBOLS))) / size
        shouts = line.count(b"!") / n
        letters = size - len(line.translate(None, _LETTERS))
        upper = (size - len(line.translate(None, _UPPER))) / (letters + 1)
        digits = (size - len(line.translate(None, _DIGITS))) / size
        fresh = len(set(words)) / n
        repeated = line in seen
        low = line.lower()
        phrase = any(p in low for p in PHRASES)
        link = b"://" in low or b"www." in low or b"@" in low
        end = words[-1][-1:]
        seen.add(line)
        x[i] = (1, symbols > 0, symbols > 0.02, symbols > 0.06, symbols > 0.15, shouts > 0.1,
                shouts > 0.5, upper > 0.3, upper > 0.7, digits > 0.1, digits > 0.3,
                letters < 0.6 * size, fresh < 0.3, fresh < 0.5, fresh < 0.7, repeated, phrase, link,
                n <= 2, n <= 5, n > 12, n > 40, end in b".?", end == b",")
        mark[i] = (symbols > 0.04 or shouts > 0.4 or (upper > 0.7 and n > 2) or digits > 0.4
                   or (fresh < 0.5 and n > 5) or repeated or phrase)
    return x, mark


N_FEATURES = 24


def lines_of(text: str | None) -> list[bytes]:
    """The text's lines that hold a word."""
    return [x for x in (text or "").encode().split(b"\n") if x and not x.isspace()]


@dataclass
class LineModel:
    weights: np.ndarray       # features x 2 (content, boilerplate)
    moves: np.ndarray         # from state x to state

    def viterbi(self, x: np.ndarray) -> np.ndarray:
        """The likeliest states; ties go to content."""
        e = (x @ self.weights).tolist()
        (m00, m01), (m10, m11) = self.moves.tolist()
        if not e:
            return np.empty(0, np.int8)
        a, b = e[0]
        back = []
        for ea, eb in e[1:]:
            a0, a1, b0, b1 = a + m00, b + m10, a + m01, b + m11
            back.append((0 if a0 >= a1 else 1, 0 if b0 >= b1 else 1))
            a, b = max(a0, a1) + ea, max(b0, b1) + eb
        state = 0 if a >= b else 1
        out = [state]
        for step in reversed(back):
            state = step[state]
            out.append(state)
        return np.array(out[::-1], np.int8)

    def content_share(self, text: str | None) -> tuple[float, int, int]:
        """(content's share of the characters, lines, content lines)."""
        lines = lines_of(text)
        if not lines:
            return 0.0, 0, 0
        states = self.viterbi(line_features(lines)[0])
        sizes = np.fromiter((len(x) for x in lines), np.int64, len(lines))
        return float(sizes[states == 0].sum() / sizes.sum()), len(lines), int((states == 0).sum())


def _expected(emit: np.ndarray, live: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """State and move probabilities (forward-backward over padded sequences)."""
    n, t, _ = emit.shape
    fwd, bwd = np.zeros((n, t, 2)), np.zeros((n, t, 2))
    fwd[:, 0] = emit[:, 0]

    def log_sum(x: np.ndarray) -> np.ndarray:     # over axis 1 of (n, 2, 2)
        top = x.max(axis=1)
        return top + np.log(np.exp(x - top[:, None]).sum(axis=1))

    for i in range(1, t):
        nxt = log_sum(fwd[:, i - 1, :, None] + moves[None]) + emit[:, i]
        fwd[:, i] = np.where(live[:, i, None], nxt, fwd[:, i - 1])
    for i in range(t - 2, -1, -1):
        nxt = log_sum((emit[:, i + 1] + bwd[:, i + 1])[:, :, None] + moves.T[None])
        bwd[:, i] = np.where(live[:, i + 1, None], nxt, 0.0)
    total = fwd[:, -1].max(axis=1) + np.log(
        np.exp(fwd[:, -1] - fwd[:, -1].max(axis=1, keepdims=True)).sum(axis=1))
    node = np.exp(np.clip(fwd + bwd - total[:, None, None], -50, 0)) * live[..., None]
    pair = np.exp(np.clip(fwd[:, :-1, :, None] + moves[None, None]
                          + (emit[:, 1:] + bwd[:, 1:])[:, :, None, :]
                          - total[:, None, None, None], -50, 0)) * live[:, 1:, None, None]
    return node, pair.sum(axis=(0, 1))


def train(runs: list[tuple[np.ndarray, np.ndarray]], *, steps: int = 120, rate: float = 0.1,
          l2: float = 1e-3) -> LineModel:
    """Maximise the likelihood of the marked runs (features, marks) by Adam.
    Without runs every line is content."""
    model = LineModel(np.zeros((N_FEATURES, 2)), np.zeros((2, 2)))
    if not runs:
        return model
    t = max(len(m) for _, m in runs)
    x = np.zeros((len(runs), t, N_FEATURES), np.float32)
    y, live = np.zeros((len(runs), t), np.int64), np.zeros((len(runs), t), bool)
    for i, (f, m) in enumerate(runs):
        x[i, :len(m)], y[i, :len(m)], live[i, :len(m)] = f, m, True
    hot = np.eye(2)[y] * live[..., None]
    seen = np.einsum("ntf,nts->fs", x, hot)
    went = np.einsum("nti,ntj->ij", hot[:, :-1], hot[:, 1:])
    count = live.sum()
    flat = x.reshape(-1, N_FEATURES)
    theta = np.zeros(2 * N_FEATURES + 4)
    m1, m2 = np.zeros_like(theta), np.zeros_like(theta)
    for k in range(1, steps + 1):
        w, mv = theta[:-4].reshape(N_FEATURES, 2), theta[-4:].reshape(2, 2)
        node, pair = _expected((flat @ w).reshape(len(runs), t, 2), live, mv)
        g = np.append((flat.T @ node.reshape(-1, 2) - seen).ravel(), (pair - went).ravel()) / count + l2 * theta
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.99 * m2 + 0.01 * g * g
        theta = theta - rate * (m1 / (1 - 0.9 ** k)) / (np.sqrt(m2 / (1 - 0.99 ** k)) + 1e-8)
    return LineModel(theta[:-4].reshape(N_FEATURES, 2), theta[-4:].reshape(2, 2))


def fit(documents: DataFrame, *, sample: int = 1500, id_col: str = "doc_id",
        text_col: str = "text") -> LineModel:
    """Train on a bounded sample: one run of at most 256 lines of each of the
    at most ``sample`` ids of the smallest hash (of an id with several texts the
    smallest one counts)."""
    ids = hashed_sample(documents.where(F.col(id_col).isNotNull())
                        .select(F.col(id_col).alias("__id")).distinct(), "__id", sample)
    docs = (documents.select(F.col(id_col).alias("__key"), F.col(text_col).cast("string").alias("text"))
            .join(F.broadcast(ids), F.col("__key") == F.col("__id"))
            .groupBy("__key").agg(F.min("text").alias("text")))

    def work(texts: list) -> dict:
        out = []
        for t in texts:
            lines = lines_of(t)
            f, m = line_features(lines)
            at = RUN * (len(t or "") % -(-len(lines) // RUN)) if lines else 0
            out.append(np.column_stack([m, f])[at:at + RUN].astype(np.int8).tobytes())
        return {"run": out}

    rows = map_texts(docs, "text", {}, [T.StructField("run", T.BinaryType())], work).collect()
    runs = sorted(bytes(r["run"]) for r in rows if r["run"])
    arrays = [np.frombuffer(r, np.int8).reshape(-1, 1 + N_FEATURES) for r in runs]
    return train([(a[:, 1:], a[:, 0]) for a in arrays])


FIELDS = [T.StructField(n, T.LongType()) for n in
          ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]


def judge(texts: list, model: LineModel, least_share: float = 0.5, least_words: int = 20,
          most_repeat: int = 30) -> dict[str, list]:
    """Base counts, the two verdicts and the content share of each text."""
    base = [base_counts(t) for t in texts]
    out: dict[str, list] = {f.name: [b[i] for b in base] for i, f in enumerate(FIELDS)}
    out["base_failed"] = [b[0] < least_words or 100 * b[4] > most_repeat * b[0] for b in base]
    shares = [model.content_share(t) for t in texts]
    out["kept"] = [not failed and s[0] >= least_share for failed, s in zip(out["base_failed"], shares)]
    out["content_share"] = [s[0] for s in shares]
    out["n_lines"], out["n_content_lines"] = ([s[i] for s in shares] for i in (1, 2))
    return out


def assess(documents: DataFrame, model: LineModel, id_col: str = "doc_id", text_col: str = "text",
           least_share: float = 0.5) -> DataFrame:
    """One row per document: doc_id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, kept, and further content_share
    (of the bytes of lines with a word), n_lines and n_content_lines.

    ``base_failed``: under 20 words, or over 30 % of the words in repeated
    8-word windows.  ``kept``: not base_failed and content_share >=
    ``least_share``.  Null and empty texts have zero counts and fail the base
    rule.  Repeated rows are judged alike; an empty table gives no rows.
    """
    return map_texts(documents, text_col, {"doc_id": id_col}, FIELDS + [
        T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType()),
        T.StructField("content_share", T.DoubleType()), T.StructField("n_lines", T.LongType()),
        T.StructField("n_content_lines", T.LongType())],
        lambda texts: judge(texts, model, least_share))
