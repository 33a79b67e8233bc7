"""The pipeline's stages against their operators and brute force."""

import pytest

import corpus_pipeline as P
from tessera.llm import kk_pack, mixing
from tests.llm.test_simhash import components, slow_fingerprint

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, f in P.STAGES:
        path = str(tmp_path_factory.mktemp("pipeline") / name)
        f(spark, out[-1], SF).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_columns_stay(stages):
    for df in stages[1:-1]:
        assert df.schema == stages[0].schema


def test_filters_follow_their_operators(spark, stages):
    from tessera.llm import bradley_terry, line_crf
    from tessera.llm.common import fold
    model = bradley_terry.fit(stages[0], spark.read.parquet(f"{SF}/labels.parquet"), learn=fold("__id", 5) != 0)
    assert ids(stages[1]) == ids(bradley_terry.score(stages[0], model).where("predicted = 1"))
    assert ids(stages[2]) == ids(line_crf.assess(stages[1], line_crf.fit(stages[1])).where("kept"))


def test_one_of_each_group(stages):
    rows = stages[2].select("doc_id", "text").collect()
    low = components([slow_fingerprint(r.text) for r in rows], [r.doc_id for r in rows], 4)
    assert ids(stages[3]) == sorted(set(low))


def test_mixed(stages):
    assert ids(stages[4]) == ids(mixing.sample(stages[3], mixing.weights(stages[3])))


def test_packed_whole(stages):
    want = {r.doc_id: r.n for r in kk_pack.pack(stages[4]).groupBy("doc_id").agg({"length": "sum"})
            .withColumnRenamed("sum(length)", "n").collect()}
    got = {r.doc_id: r.n for r in stages[5].groupBy("doc_id").agg({"length": "sum"})
           .withColumnRenamed("sum(length)", "n").collect()}
    assert got == want and sorted(got) == ids(stages[4])


def test_run(spark, stages):
    assert ids(P.run(spark, SF)) == ids(stages[5])


def test_edge_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, __p string"
    text = "some words that say one thing after the other and then go on to say more until the text is long enough"
    rows = [(1, None), (2, ""), (3, text), (3, text), (4, text), (None, text + " x"), (None, text + " x"), (5, "a")]
    docs = spark.createDataFrame([(i, t, None, None, None, 0.5, "clash") for i, t in rows], schema)
    for name, f in P.STAGES[:-1]:
        got = f(spark, docs, SF)
        assert got.columns == docs.columns and got.count() <= len(rows), name
        assert f(spark, docs.limit(0), SF).count() == 0, name
    assert P.packing(spark, docs, SF).count() >= len(rows)
    kept = P.near_duplicates(spark, docs, SF).collect()
    assert len([r for r in kept if r.doc_id == 3]) == 1 and not [r for r in kept if r.doc_id == 4]


def test_repeated_ids_lose_no_text(spark):
    a = "some words that say one thing after the other and then go on to say more until the text is long enough"
    b = "a quite different passage about rivers and stones that shares no shingle with what the first one has said"
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for rows in ([(1, a), (2, a), (2, b), (3, b)], [(None, a), (2, a), (None, b), (None, b), (2, None), (3, "")]):
        docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], schema).repartition(3)
        kept = sorted(((r.doc_id, r.text) for r in P.near_duplicates(spark, docs, SF).collect()), key=str)
        want = {a: (1, a), b: (2, b)} if rows[0][0] else {a: (2, a), b: (None, b), None: (2, None)}
        assert kept == sorted(want.values(), key=str)
