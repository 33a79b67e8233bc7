"""Raking and sampling."""

import pytest

from tessera.llm import mixing
from tessera.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SF01
from tests.oracle import compare, duck


@pytest.fixture(scope="module")
def cells(spark):
    return mixing.weights(spark.read.parquet(f"{SF01}/documents.parquet")).toPandas()


def test_sql(spark):
    got = QUERIES["op2_mixing_weights"](spark, SF01).toPandas()
    res = compare(got, duck(SF01).execute(ORACLE_SQL["op2_mixing_weights"]).fetchdf())
    assert res["ok"], res
    assert 0 < len(got) < 1000


def goals(held, share=0.5, temper=0.7):
    """Bounded targets of one marginal by bisection."""
    want, low, high = (held / held.sum()) ** temper, 0.0, held.sum() * 1e6
    for _ in range(300):
        per = (low + high) / 2
        low, high = (per, high) if (want * per).clip(upper=mixing.WHOLE * held).sum() < share * held.sum() else (low, per)
    return (want * per).clip(upper=mixing.WHOLE * held)


@pytest.mark.parametrize("by", ["source", "lang", "topic"])
def test_marginals_meet_their_targets(cells, by):
    goal = goals(cells.groupby(by).tokens.sum().astype(float))
    got = (cells.p * cells.tokens).groupby(cells[by]).sum()
    assert cells.p.between(0, 1).all() and (got / goal - 1).abs().max() < 5e-3
    assert (cells.ratio * 0.5 - cells.p).abs().max() < 1e-9


def test_sample_share_follows_p(spark, cells):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    want = (cells.p * cells.tokens).sum()
    got = mixing.sample(docs, mixing.weights(docs)).select(mixing.tokens("text").alias("n")).toPandas().n.sum()
    assert abs(got / want - 1) < 0.1


def test_edge_cases(spark):
    schema = "doc_id long, text string, source string, lang string, p string, tokens int"
    rows = [(1, "a b", None, None, "x", 1), (None, None, None, "en", "x", 1), (2, "", "s", None, "x", 1),
            (3, "Licensed under X", "s", "en", "x", 1), (3, "Licensed under X", "s", "en", "x", 1)]
    df = spark.createDataFrame(rows, schema)
    w = mixing.weights(df)
    assert {(r.source, r.lang, r.topic) for r in w.collect()} == {
        ("(none)", "und", "prose"), ("(none)", "en", "prose"), ("s", "und", "prose"), ("s", "en", "legal")}
    drawn = mixing.sample(df, w)
    assert set(df.columns) <= set(drawn.columns)
    assert len([r for r in drawn.collect() if r.doc_id == 3]) in (0, 2)
    empty = spark.createDataFrame([], schema)
    assert mixing.sample(empty, mixing.weights(empty)).count() == 0
    blank = spark.createDataFrame([(1, None, "s", "en", "x", 1)], schema)
    assert [r.ratio for r in mixing.weights(blank).collect()] == [1.0]


def test_bounded_targets_and_what_they_miss(spark):
    cells = mixing.weights(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))
    held = cells.toPandas()
    assert held.p.max() <= 1 and (held.p == 1).any()             # bounded cells are taken whole
    assert abs((held.p * held.tokens).sum() / held.tokens.sum() / 0.5 - 1) < 1e-3
    for by in ("source", "lang", "topic"):
        got = (held.p * held.tokens).groupby(held[by]).sum()
        assert (got / goals(held.groupby(by).tokens.sum().astype(float)) - 1).abs().max() < 5e-3, by
    off = mixing.misses(cells).toPandas()
    short = off[off.expected < off.target * 0.98]
    assert set(off.marginal) == {"source", "lang", "topic"} and (short.whole > 0.95).all()


def test_a_tiny_topic_does_not_shrink_the_sample(spark):
    rows = [(i, "word " * 50, f"s{i % 3}", "en") for i in range(300)] + [(900, "Who? ", "s0", "en")]
    cells = mixing.weights(spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")).toPandas()
    assert abs((cells.p * cells.tokens).sum() / cells.tokens.sum() - 0.5) < 0.01
    assert cells[cells.topic == "questions"].p.iloc[0] > 0.9


def test_drawn_rows_meet_the_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    cells = mixing.weights(docs)
    rows = mixing.draw(docs, cells).select("lang", "topic", mixing.tokens("row.text").alias("n")).toPandas()
    held = cells.toPandas()
    for by in ("lang", "topic"):
        goal = goals(held.groupby(by).tokens.sum().astype(float))
        assert (rows.groupby(by).n.sum() / goal - 1).abs().max() < 0.15, by
