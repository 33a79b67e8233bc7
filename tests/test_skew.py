"""Hot-key regression check: with one key holding a third of the rows, no
task of any keyed operator reads a third of a stage's shuffle records."""

import json
import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _run(*args):
    out = subprocess.run([sys.executable, os.path.join(ROOT, "skew_check.py"), "120000", *args],
                         capture_output=True, text=True, timeout=900, cwd=ROOT)
    line = [x for x in out.stdout.splitlines() if x.startswith("{")][-1]
    return json.loads(line)["max_task_share_of_stage_shuffle"]


@pytest.mark.parametrize("mode", [(), ("--aqe",)])
def test_no_task_holds_the_hot_key(mode):
    shares = _run(*mode)
    assert shares, "no shuffle stages measured"
    worst = {k: v for k, v in shares.items() if v >= 0.2}
    assert not worst, worst


def test_join_deals_large_tables_over_more_tasks(spark):
    """Before, a task's share grew with the tables once there were no more partitions."""
    from pyspark.sql import functions as F
    from tessera.operators import joins as J
    a = spark.range(4000).select(F.col("id").alias("a"))
    b = spark.range(9000).select((F.col("id") % 3000).alias("b"), F.col("id").alias("n"))
    on = F.col("a") == F.col("b")
    for how in ("inner", "left", "left_anti"):
        out = J.join(a, b, on, how, by=("a", "b"), task_rows=100)
        assert sorted(map(str, out.collect())) == sorted(map(str, a.join(b, on, how).collect()))
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("RepartitionByExpression") == 2 and ", 90" in plan


def test_nested_parts_of_missing_and_blank_keys_are_disjoint(spark):
    """Before, a NULL and a blank level of one full key could go to two parts."""
    from tessera.operators import aggregates as A
    rows = [(1, lvl, f"d{i}", float(i)) for i in range(40) for lvl in (None, "", "x")]
    df = spark.createDataFrame(rows, "id int, lvl string, day string, price double")
    parts = A.nested_map_parts(df, ["id"], ["lvl"], "day", "price", most=4)
    flat = [(r.lvl, r.day, r.price) for r in A.flatten_nested_map(parts, ["id", "part"], ["lvl"], "day", "price").collect()]
    assert sorted(flat) == sorted({(lvl or "", day, price) for _, lvl, day, price in rows}) and parts.count() > 10


def test_exists_flag_copies_only_what_is_asked(spark):
    """Before, every hit had 32 copies, whatever the requests asked."""
    from tessera.operators import aggregates as A
    req = spark.createDataFrame([(i % 7 if i % 5 else None, i) for i in range(60)] + [(99, 60), (99, 60)], "k int, n int")
    facts = spark.createDataFrame([(0, 0), (1, 1), (1, 1), (3, 1), (5, 1), (None, 1), (8, 0)], "k int, q int")
    out = A.exists_flag(req, facts, ["k"], cond=facts.q == 1)
    want = [(*r, r.k in (1, 3, 5)) for r in req.collect()]
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, want))
    assert "Generate" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_nested_map_of_one_shuffle(spark):
    """Before, rows were shuffled once to be deduped and once more to be nested."""
    from tessera.operators import aggregates as A
    rows = [(i % 9, lvl, f"d{i % 20}", float(i)) for i in range(300) for lvl in (None, "", "x")]
    df = spark.createDataFrame(rows, "id int, lvl string, day string, price double")
    for split in (0, 1):
        plain = A.nested_map(df, ["id"], ["lvl"], "day", "price", split_levels=split)
        dealt = A.nested_map(df, ["id"], ["lvl"], "day", "price", split_levels=split, task_rows=50)
        assert sorted(map(str, dealt.collect())) == sorted(map(str, plain.collect()))
        plan = [d._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1] for d in (plain, dealt)]
        assert [p.count("Exchange") for p in plan] == [2, 1]
