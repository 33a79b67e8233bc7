"""Plan-shape checks behind the scale claims in the README."""

import re

import __spark_entry__ as E
from tests.conftest import SF01

from tessera.plans.surface import QUERIES as STANDINS

Q = E.queries()


def plan(spark, name):
    return Q[name](spark, SF01)._jdf.queryExecution().executedPlan().toString()


def test_topk_per_group_is_window_group_limit(spark):
    for name in ["topn_cheapest", "top1_all_names", "weighted_without_repl", "latest_rows", "latest_per_group"]:
        assert "WindowGroupLimit" in plan(spark, name), name


def test_filters_reach_the_scan(spark):
    p = plan(spark, "filter_range")
    assert "GreaterThanOrEqual(l_quantity,10.0)" in p and "LessThanOrEqual(l_quantity,20.0)" in p
    assert "GreaterThanOrEqual(o_orderdate" in plan(spark, "year_filter")
    assert "EqualTo(p_name,red widget)" in plan(spark, "topn_dearest")


def test_column_pruning(spark):
    p = plan(spark, "filter_eq")
    schema = re.search(r"ReadSchema: struct<([^>]*)>", p).group(1)
    assert "p_retailprice" not in schema and "p_size" not in schema


def test_no_python_in_catalogue_queries(spark):
    for name in STANDINS:
        if name == "json_array_file":            # cuts a document's bytes, a range a task
            continue
        p = plan(spark, name)
        assert not re.search("ArrowEvalPython|BatchEvalPython|MapInArrow|MapInPandas|FlatMap", p), name


def test_fuzzy_filter_has_no_shuffle_and_joins_have_no_cross_product(spark):
    assert "Exchange" not in plan(spark, "fuzzy_name")
    for name in STANDINS:
        assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan(spark, name)), name


def test_distinct_on_and_pick_are_aggregates_not_windows(spark):
    for name in ["distinct_on", "weighted_pick"]:
        p = plan(spark, name)
        assert "Window " not in p and "Aggregate" in p, name


def test_no_broadcast_hints_in_library():
    """Outside the optional subpackage, whose own tests name its bounded lists."""
    import pathlib
    src = pathlib.Path(__file__).resolve().parents[1] / "tessera"
    for f in src.rglob("*.py"):
        assert f.parent.name == "llm" or "F.broadcast(" not in f.read_text(), f


def test_bucketed_tables_join_and_rank_without_exchange(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(spark, "bucket_join")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in p and "Exchange" not in p and "Bucketed: true" in p
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("tessera_bucketed")]


def test_a_deep_page_reads_few_ranges(spark):
    from tessera.operators.topk import RankIndex
    df = spark.range(10_000).selectExpr("id", "(id * 7919) % 10007 AS k").repartition(5)
    index = RankIndex(df, ["k desc", "id"], rows=500)
    want = [r.id for r in df.orderBy(df.k.desc(), "id").collect()]
    for offset, limit in [(0, 10), (4_990, 30), (9_995, 50), (20_000, 5), (499, 1_002)]:
        page = index.page(offset, limit)
        assert [r.id for r in page.collect()] == want[offset:offset + limit]
    # the page of 30 rows lies in one range or two of some twenty
    assert len(index.counts) >= 15 and len(index.page(4_990, 30).inputFiles()) >= 1
    parts = index.page(4_990, 30)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in parts and "_range" in parts
