"""Quality, toxicity, language and line rules: held-out accuracy on the given
labels, exact parts against brute force, and edge cases."""

import itertools
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.llm import bradley_terry, kneser_ney, line_crf, string_kernel
from tessera.llm.common import fold
from tessera.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


def held_out(spark, name, label):
    got = QUERIES[name](spark, SF).where("held_out").toPandas()
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    d = got.merge(labels, on="doc_id")
    assert d.score.between(0, 1).all()
    return d.predicted, d[label]


def test_quality_held_out(spark):
    said, true = held_out(spark, "op6_bradley_terry_quality", "quality")
    assert (said == true).mean() > 0.98
    assert (said[true == 1] == 1).mean() > 0.99


def test_toxicity_spares_clean(spark):
    said, true = held_out(spark, "op7_kneser_ney_toxicity", "toxic")
    assert (said[true == 0] == 0).mean() > 0.98


def test_toxicity_held_out(spark):
    said, true = held_out(spark, "op7_kneser_ney_toxicity", "toxic")
    assert (said[true == 1] == 1).mean() > 0.85


def test_language_held_out(spark):
    got = QUERIES["op8_string_kernel_lang"](spark, SF).where("held_out").toPandas()
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").toPandas()
    d = got.merge(docs, on="doc_id")
    assert (d.lang == d.lang_pred).mean() > 0.99


def test_held_out_is_crc32_of_the_text(spark):
    import zlib
    rows = spark.range(200).select("id", fold("id", 5).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 5 for r in rows)


# -- edge cases, all at once -------------------------------------------------

SCHEMA = "doc_id long, text string, lang string, score string, predicted string, held_out string, kept int"
EDGE = [(1, None), (2, ""), (3, " \n\t "), (4, "123 !!"), (5, "plain words in a plain sentence"), (5, "again"),
        (None, "no id at all"), (6, "long words " * 30000), (7, "é漢字 ß")]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame([(i, t, None, "x", "y", "z", 1) for i, t in EDGE], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(5, 1, 1), (5, 0, 0), (6, 0, 0), (None, 1, 1), (2, None, None), (99, 1, 0)],
                                 "doc_id long, quality int, toxic int")


def test_quality_edges(spark, edge, labels):
    for lab in (labels, labels.limit(0)):
        rows = bradley_terry.score(edge, bradley_terry.fit(edge, lab)).collect()
        assert len(rows) == len(EDGE) and all(0 <= r.score <= 1 for r in rows)
        assert all(r.predicted == (r.score >= 0.3) for r in rows)
    assert bradley_terry.score(edge.limit(0), bradley_terry.fit(edge.limit(0), labels)).count() == 0


def test_toxicity_edges(spark, edge, labels):
    for lab in (labels, labels.limit(0)):
        rows = kneser_ney.score(edge, kneser_ney.fit(edge, lab, learn=F.lit(True), calibration=F.lit(True))).collect()
        assert len(rows) == len(EDGE) and all(0 <= r.score <= 1 for r in rows)
    empty = edge.limit(0)
    assert kneser_ney.score(empty, kneser_ney.fit(empty, labels)).count() == 0


def test_language_edges(spark, edge):
    rows = string_kernel.identify(edge, string_kernel.fit(edge)).collect()
    assert {r.lang_pred for r in rows} == {"und"} and len(rows) == len(EDGE)
    known = edge.withColumn("lang", F.when(F.col("doc_id") == 7, "zz").when(F.col("doc_id") == 6, "en"))
    got = {r.doc_id: r for r in string_kernel.identify(known, string_kernel.fit(known)).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3, 4, 6, 7)] == ["und"] * 4 + ["en", "zz"]
    assert string_kernel.identify(edge.limit(0), string_kernel.fit(edge.limit(0))).count() == 0


def test_rules_edges(spark, edge):
    rows = line_crf.assess(edge, line_crf.fit(edge)).collect()
    assert len(rows) == len(EDGE)
    assert all(r.base_failed and not r.kept for r in rows if r.n_words < 20)
    assert line_crf.assess(edge.limit(0), line_crf.fit(edge.limit(0))).count() == 0


# -- pairwise ranking ---------------------------------------------------------

def test_threshold_is_the_quantile():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, bradley_terry.N_FEATURES))
    y = (x[:, 0] + 0.1 * rng.normal(size=400) > -0.5).astype(int)
    model = bradley_terry.train(x, y, float((y == 0).mean()))
    low = model.raw(x) < model.threshold
    assert abs(low.mean() - (y == 0).mean()) < 0.02
    assert ((~low).astype(int) == y).mean() > 0.9


def test_every_labelled_document_counts(spark):
    """More documents than a sample of 4,000 a label: bounds, weights and
    threshold are those of all of them, whatever the partitioning."""
    n = 9000
    docs = spark.range(n, numPartitions=7).select(F.col("id").alias("doc_id"), F.expr(
        "concat(repeat('word ', cast(3 + abs(xxhash64(id)) % 40 as int)), repeat('!! ', cast(abs(xxhash64(id, 1)) % 9 as int)), id)"
    ).alias("text"))
    labels = docs.select("doc_id", (F.abs(F.xxhash64("doc_id", F.lit(1))) % 9 < 4 + F.col("doc_id") % 3)
                         .cast("int").alias("quality"))
    model = bradley_terry.fit(docs, labels)
    again = bradley_terry.fit(docs.repartition(3), labels)
    assert np.array_equal(model.weights, again.weights) and model.threshold == again.threshold
    rows = docs.join(labels, "doc_id").orderBy(F.xxhash64(F.col("doc_id").cast("string"))).toPandas()
    x, y = np.array([bradley_terry.features(t) for t in rows.text]), rows.quality.to_numpy()
    for j, e in enumerate(model.edges):
        quantiles = np.quantile(x[:, j], np.arange(1, 8) / 8, method="inverted_cdf")
        assert np.allclose(np.unique(e), np.unique(np.ldexp(np.floor(np.frexp(quantiles)[0] * 512),
                                                            np.frexp(quantiles)[1] - 9)))
    codes = model.codes(x)
    weights = bradley_terry._newton(lambda w: bradley_terry._slopes(model, w, codes[y == 1], codes[y == 0]),
                                    np.zeros(len(model.weights)), 1.0)
    assert np.allclose(model.weights, weights)
    assert abs((model.raw(x) < model.threshold).mean() - (y == 0).mean()) < 0.001


def test_blocks_of_documents_add_up(spark, monkeypatch):
    """Many blocks, the rarer label in several of them, sums added up by tasks."""
    docs = spark.range(3000, numPartitions=5).select(F.col("id").alias("doc_id"), F.expr(
        "concat(repeat('word ', cast(3 + abs(xxhash64(id)) % 40 as int)), repeat('!! ', cast(abs(xxhash64(id, 1)) % 9 as int)), id)"
    ).alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 20 > 0).cast("int").alias("quality"))
    monkeypatch.setattr(bradley_terry, "BLOCK", 100)
    monkeypatch.setattr(bradley_terry, "LEAST", 20)
    few = bradley_terry.fit(docs, labels)
    monkeypatch.setattr(bradley_terry, "_FAN", 4)
    many = bradley_terry.fit(docs, labels)
    assert np.array_equal(few.weights, many.weights) and few.threshold == many.threshold and few.weights.any()


# -- Kneser-Ney ---------------------------------------------------------------

def slow_codes(text):
    """(bytes before, byte) of each predicted byte, by slicing."""
    words = kneser_ney.words_of(text)
    out = []
    for w in words:
        s = b" " + w + b" "
        for i in range(1, len(s)):
            out.append(s[max(0, i - kneser_ney.ORDER + 1):i + 1])
    return out


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="abcé .1", max_size=25), max_size=4))
def test_codes(texts):
    data, ends = kneser_ney.joined(texts)
    got = kneser_ney._predicted(data, ends)[1].tolist()
    assert got == [int.from_bytes(s, "big") for t in texts for s in slow_codes(t)]


def slow_model(docs):
    """Log-likelihood ratios straight from the definition."""
    from collections import Counter, defaultdict
    d, counts = kneser_ney.DISCOUNT, [Counter(), Counter()]
    for text, y in docs:
        counts[y].update(slow_codes(text))
    grams = set(counts[0]) | set(counts[1])
    cont = defaultdict(set)                       # shorter n-gram -> longer ones that end in it
    for g in grams:
        for k in range(1, len(g)):
            cont[g[len(g) - k:]].add(g[len(g) - k - 1:])

    def shared(s):
        ctx = [t for t in cont if len(t) == len(s) and t[:-1] == s[:-1]]
        total = sum(len(cont[t]) for t in ctx)
        below = shared(s[1:]) if len(s) > 1 else 1 / 256
        return (len(cont[s]) - d) / total + d * len(ctx) / total * below

    def prob(y, g):
        ctx = [t for t in counts[y] if t[:-1] == g[:-1]]
        total = sum(counts[y][t] for t in ctx)
        if not total:
            return shared(g[1:])
        return max(counts[y][g] - d, 0) / total + d * len(ctx) / total * shared(g[1:])

    return {int.from_bytes(g, "big"): np.log(prob(1, g) / prob(0, g)) for g in grams}


def test_kneser_ney_against_its_definition(spark):
    docs = [("the cat sat on the mat", 0), ("the idiot cat", 1), ("an idiotic mat, idiot", 1), ("cats and mats", 0),
            (None, 1), ("", 0)]
    df = spark.createDataFrame(docs, "text string, y int").repartition(3)
    grams, contexts = kneser_ney.evidence(kneser_ney.count_grams(df, "text", "y"))
    got = {r.code: r.llr for r in grams.collect()}
    want = slow_model([(t, y) for t, y in docs])
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)
    assert all(np.isfinite(r.llr) for r in contexts.collect())


# -- string kernel ------------------------------------------------------------

def slow_grams(text, longest=4):
    low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    s = " " + re.sub(r"[^\w]|\d|_", " ", low) + " "
    s = re.sub(" +", " ", s)
    return {s[i:i + n] for n in range(1, longest + 1) for i in range(len(s) - n + 1)} - {" "}


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="abcdéñ .,1\n", max_size=50))
def test_presence(text):
    want = slow_grams(text) if any(c.isalpha() for c in text) else set()
    assert len(np.unique(string_kernel.grams(text))) == len(want)


def test_kernel_is_normalised_presence():
    texts = ["the cat and the hat", "le chat et la dame", "the cap"]
    g = [string_kernel.grams(t) for t in texts]
    model = string_kernel.train(g, g, ["en", "fr", "en"])
    k = model.kernel(g)
    sets = [slow_grams(t) for t in texts]
    for i, j in itertools.product(range(3), repeat=2):
        assert abs(k[i, j] - len(sets[i] & sets[j]) / np.sqrt(len(sets[i]) * len(sets[j]))) < 1e-5
    assert model.predict(["that cat", "la chatte", "", None, "12"])[0] == ["en", "fr", "und", "und", "und"]


# -- line rules ---------------------------------------------------------------

def slow_base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    hit = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(8)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(hit))


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab#é \n\t\x0b\x1c\x85", max_size=120))
def test_base_counts(text):
    assert line_crf.base_counts(text) == slow_base(text)


def test_base_counts_of_documents(spark):
    for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(80).collect():
        if len(r.text) < 8000:
            assert line_crf.base_counts(r.text) == slow_base(r.text)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 9), st.integers(0, 10 ** 6))
def test_viterbi_is_the_best_path(n, seed):
    rng = np.random.default_rng(seed)
    model = line_crf.LineModel(rng.normal(size=(line_crf.N_FEATURES, 2)), rng.normal(size=(2, 2)))
    x = rng.integers(0, 2, (n, line_crf.N_FEATURES))
    e = x @ model.weights

    def value(p):
        return sum(e[i, s] for i, s in enumerate(p)) + sum(model.moves[a, b] for a, b in zip(p, p[1:]))

    best = max(itertools.product((0, 1), repeat=n), key=value)
    assert abs(value(model.viterbi(x)) - value(best)) < 1e-9


def test_expected_counts_are_the_marginals():
    rng = np.random.default_rng(3)
    emit, moves = rng.normal(size=(2, 4, 2)), rng.normal(size=(2, 2))
    live = np.array([[True] * 4, [True, True, True, False]])
    node, pair = line_crf._expected(emit * live[..., None], live, moves)
    want_node, want_pair = np.zeros((2, 4, 2)), np.zeros((2, 2))
    for i, t in enumerate((4, 3)):
        paths = list(itertools.product((0, 1), repeat=t))
        w = np.exp([sum(emit[i, k, s] for k, s in enumerate(p)) + sum(moves[a, b] for a, b in zip(p, p[1:]))
                    for p in paths])
        for p, v in zip(paths, w / w.sum()):
            for k, s in enumerate(p):
                want_node[i, k, s] += v
            for a, b in zip(p, p[1:]):
                want_pair[a, b] += v
    assert np.allclose(node, want_node) and np.allclose(pair, want_pair)


def test_boilerplate_decides(spark):
    # No 8-word window of the prose repeats, or the base rule would reject it.
    prose = "\n".join(("The fox walked to the river and looked at every boat that passed it.",
                       "Late in the evening a cold wind came over the hills from the sea.",
                       "Nobody in the village could remember such a long and quiet winter.",
                       "Her brother had sold the mill years ago and moved to the coast.",
                       "When the bells rang, the children ran home through the wet fields."))
    junk = "\n".join(["HOME | ABOUT | LOGIN $$$", "### *** ### ***", "click here | subscribe | cookie"] * 6)
    docs = spark.createDataFrame([(i, f"{prose}\n{i} more") for i in range(40)]
                                 + [(100 + i, f"{junk}\n{i}") for i in range(20)], "doc_id long, text string")
    kept = {r.doc_id for r in line_crf.assess(docs, line_crf.fit(docs)).where("kept").collect()}
    assert kept == set(range(40))


def test_toxicity_is_scored_in_portions(spark, edge, labels):
    """Before, all chunks were shuffled at once when the result was read, and stayed."""
    model = kneser_ney.fit(edge, labels, learn=F.lit(True), calibration=F.lit(True))
    out = kneser_ney.score(edge, model)
    files = out.inputFiles()
    assert files and not any("op7-chunks" in f for f in files)
    assert sorted(str(r.doc_id) for r in out.collect()) == sorted(str(i) for i, _ in EDGE)
