"""Predicates, grouping and paging as a query builder's user combines them."""

import pytest
from pyspark.sql import functions as F

from tessera.functions import predicates as P
from tessera.functions.fuzzy import fuzzy_filter
from tessera.operators import aggregates as A
from tessera.operators import topk as K


@pytest.fixture(scope="module")
def stock(spark):
    rows = [(i, f"bin {i % 4}", None if i % 7 == 0 else float(i % 5), ["raw", "cut"][: i % 3]) for i in range(60)]
    return spark.createDataFrame(rows, "id long, bin string, weight double, marks array<string>")


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_predicates_combine(stock):
    either = P.any_of([P.eq("bin", "bin 1"), P.eq("bin", "bin 3")])
    heavy = P.gte("weight", 3.0)
    assert ids(P.apply_filters(stock, either, heavy, None)) == [
        i for i in range(60) if i % 2 == 1 and i % 7 and i % 5 >= 3]
    assert P.apply_filters(stock, P.any_of([])).count() == 60           # an empty group does not narrow
    assert ids(stock.where(P.contains_all("marks", ["raw", "cut"]))) == [i for i in range(60) if i % 3 == 2]


def test_groups_over_a_bound(stock):
    got = A.group_having(stock, "bin", [F.count("weight").alias("n")], having=F.col("n") >= 13)
    want = {f"bin {b}": n for b in range(4) if (n := sum(i % 4 == b and i % 7 != 0 for i in range(60))) >= 13}
    assert {r["bin"]: r["n"] for r in got.collect()} == want


def test_pages_cover_all_rows_once(stock):
    pages = [K.page(stock, ["weight desc", "id asc"], limit=25, offset=o).collect() for o in (0, 25, 50)]
    seen = [r["id"] for p in pages for r in p]
    assert seen == [r["id"] for r in K.order_by(stock, "weight desc", "id asc").collect()] and len(set(seen)) == 60
    assert [r["id"] for r in K.page(stock, ["id asc"], limit=None, offset=57).collect()] == [57, 58, 59]


def test_similarity_needs_a_threshold_between_0_and_1(stock):
    for bad in (-0.5, 1.01):
        with pytest.raises(ValueError):
            fuzzy_filter(stock, "bin", "bin", bad)
