"""Dialect edges checked against DuckDB on random inputs: case-insensitive
LIKE with user wildcards and backslashes (P7/P9), and the exact-separator
text-list split (S3)."""

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.functions import predicates as P
from tessera.sources.normalize import split_list

CHARS = "aAbB%_\\.*[]()|^$ ,Éé"
TEXT = st.text(alphabet=CHARS, max_size=8)


@settings(max_examples=40, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=12), TEXT)
def test_like_ci_matches_duckdb(spark, values, pattern):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    got = sorted(r["i"] for r in df.where(P.like_ci("s", pattern)).collect())
    con = duckdb.connect()
    want = sorted(i for i, v in enumerate(values)
                  if con.execute("SELECT lower(?) LIKE lower(?)", [v, pattern]).fetchone()[0])
    assert got == want


@settings(max_examples=40, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab, ", max_size=8)), min_size=1, max_size=10))
def test_split_matches_duckdb(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    got = {r["i"]: r["l"] for r in df.select("i", split_list(df.s).alias("l")).collect()}
    con = duckdb.connect()
    for i, v in enumerate(values):
        want = con.execute("SELECT CASE WHEN ? IS NULL OR trim(?) = '' THEN []::VARCHAR[] "
                           "ELSE string_split(?, ', ') END", [v, v, v]).fetchone()[0]
        assert got[i] == want, (v, got[i], want)
