"""Hot-key check: one key holds a third of all rows.

For each keyed operator, runs it on skewed data and reports, over every
stage that reads a shuffle, the largest share of that stage's shuffle
records read by a single task.  A skew-bound plan shows ~0.33 or more (the
hot key's rows meet in one task); a skew-safe one stays near 1 / tasks.

usage: python skew_check.py [rows] [--aqe]      (prints one JSON line)

Default mode measures the plans as written (no broadcasts, no AQE skew
splitting).  ``--aqe`` measures the joins that rely on AQE's runtime skew
split instead (skew thresholds lowered to this data size, broadcasts still
off).
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tessera.operators import aggregates as A  # noqa: E402
from tessera.operators import joins as J  # noqa: E402
from tessera.operators import sampling as X  # noqa: E402
from tessera.operators import topk as K  # noqa: E402
from tessera.session import get_spark  # noqa: E402


def skewed(spark, n: int):
    """n rows; key 0 holds a third of them, the rest spread over n/30 keys."""
    ids = spark.range(n, numPartitions=16)
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % F.lit(max(n // 30, 1)) + 1)
    return ids.select(
        key.cast("long").alias("k"), F.col("id").alias("item"),
        (F.col("id") % 97 + 1).cast("long").alias("w"),
        (F.col("id") * 7919 % 100003).cast("double").alias("price"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 365).cast("int")).alias("date"))


def operators(df):
    return {
        "top_n_per_group": lambda: K.top_n_per_group(df, "k", ["price asc", "item asc"], 3),
        "latest_rows": lambda: J.latest_rows(df, "k", "date"),
        "distinct_on": lambda: A.distinct_on(df, ["k"], ["price", "item"]),
        "price_trend": lambda: A.price_trend(df, key="k"),
        "nested_map_split": lambda: A.nested_map(
            df.withColumn("s", F.col("item") % 3).withColumn("d", F.col("date").cast("string")),
            ["k"], ["s", "d"], "item", "price", split_levels=2),
        "nested_map_parts": lambda: A.nested_map_parts(
            df.withColumn("s", F.col("item") % 3).withColumn("d", F.col("item").cast("string")),
            ["k"], ["s"], "d", "price", most=5000),
        "hot_small_sheet": lambda: X.weighted_with_replacement(
            df.where("item < 5").select(F.lit(0).cast("long").alias("k"), "item", "w"),
            df.select(F.lit(0).cast("long").alias("k"), F.col("item").alias("rid")), "k", "item", "w", 2, "rid"),
        "sample_n_large": lambda: X.sample_n(df, df.count() * 3 // 5, "item"),
        "financial_summary": lambda: A.financial_summary(df, group="k", item="item"),
        "exists_flag": lambda: A.exists_flag(df.select("k").distinct(), df, ["k"], F.col("price") > 50000),
        "exists_flag_hot_requests": lambda: A.exists_flag(df.select("k", "item"), df.where("item % 2 = 0"), ["k"]),
        "distinct_on_with_fallback": lambda: A.distinct_on_with_fallback(
            df.select(F.lit(0).cast("long").alias("q")).union(df.select(F.lit(5).cast("long"))), df, "q",
            "k", "w", ["k", "w"], ["item"]),
        "weighted_pick": lambda: X.weighted_pick(df, "k", "item", "w"),
        "weighted_without_replacement_k5": lambda: X.weighted_without_replacement(df, "k", "item", "w", 5),
        "weighted_with_replacement": lambda: X.weighted_with_replacement(
            df, df.select("k").distinct().withColumn("rid", F.col("k")), "k", "item", "w", 50, "rid"),
        "two_phase_without_replacement": lambda: X.weighted_without_replacement_draws(
            df, df.select("k").distinct().withColumn("rid", F.col("k")), "k", "item", "w", 20, "rid"),
        # One request per row: a third of all requests target the hot group.
        "with_replacement_hot_requests": lambda: X.weighted_with_replacement(
            df, df.select("k", F.col("item").alias("rid")), "k", "item", "w", 2, "rid"),
        "two_phase_hot_requests": lambda: X.weighted_without_replacement_draws(
            df, df.select("k", F.col("item").alias("rid")), "k", "item", "w", 3, "rid"),
    }


def join_operators(df):
    # A dimension as stored: a plain table (not derived by an aggregate).
    n_keys = df.agg(F.max("k")).first()[0] + 1
    dim = df.sparkSession.range(n_keys).select(F.col("id").alias("k"), (F.col("id") % 7).alias("tag"))
    status = df.select("k", F.lit("fmt").alias("format"),
                       F.when(F.col("item") % 2 == 0, "Legal").otherwise("Banned").alias("status"))
    foreign = df.select("k", F.concat(F.lit("name"), F.col("item") % 5).alias("name"))
    return {
        "join_status": lambda: J.join_status(df, status.dropDuplicates(["k", "status"]), "fmt", "Legal", key="k"),
        "join_dimension": lambda: J.join_dimension(df, dim, "k", "k", F.col("tag") < 5, keep=["tag"]),
        "join_translations": lambda: J.join_translations(df, foreign.dropDuplicates(), "name1", key="k"),
        "ordered_fetch": lambda: J.ordered_fetch(df.select(F.col("item").alias("rq"), F.lit(0).alias("pos"), "k"),
                                                 dim, "k", request_col="rq"),
    }


def main():
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    aqe = "--aqe" in sys.argv
    n = int(args[0]) if args else 600_000
    log_dir = tempfile.mkdtemp(prefix="tessera-skew-")
    conf = {"spark.ui.enabled": "false", "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.autoBroadcastJoinThreshold": "-1"}
    if aqe:
        conf.update({"spark.sql.adaptive.skewJoin.enabled": "true",
                     "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                     "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
                     "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k"})
    else:
        # Measure the plans themselves: no coalescing or AQE skew splitting.
        conf["spark.sql.adaptive.skewJoin.enabled"] = "false"
    spark = get_spark("local[8]", 16, app_name="tessera-skew", extra=conf)
    df = skewed(spark, n)
    ops = join_operators(df) if aqe else operators(df)
    for name, make in ops.items():
        spark.sparkContext.setJobGroup(name, name)
        make().write.format("noop").mode("overwrite").save()
    app_id = spark.sparkContext.applicationId
    spark.stop()
    import zstandard
    files = glob.glob(os.path.join(log_dir, "*", "events*")) + glob.glob(os.path.join(log_dir, "*"))
    path = [f for f in files if os.path.isfile(f)][0]
    raw = open(path, "rb")
    stream = zstandard.ZstdDecompressor().stream_reader(raw) if path.endswith(".zstd") else raw
    stage_group = {}
    task_reads: dict[int, list[int]] = {}
    for line in io.TextIOWrapper(stream, encoding="utf-8"):
        e = json.loads(line)
        ev = e.get("Event")
        if ev == "SparkListenerJobStart":
            g = (e.get("Properties") or {}).get("spark.jobGroup.id")
            for sid in e.get("Stage IDs", []):
                stage_group[sid] = g
        elif ev == "SparkListenerTaskEnd":
            m = (e.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
            recs = m.get("Total Records Read", 0)
            if recs:
                task_reads.setdefault(e["Stage ID"], []).append(recs)
    worst = {}
    for sid, recs in task_reads.items():
        g = stage_group.get(sid)
        total = sum(recs)
        if g is None or total < 1000:
            continue
        share = max(recs) / total
        worst[g] = max(worst.get(g, 0.0), share)
    print(json.dumps({"rows": n, "hot_key_share": 1 / 3, "mode": "aqe" if aqe else "plans", "app": app_id,
                      "max_task_share_of_stage_shuffle": {k: round(v, 3) for k, v in worst.items()}}))


if __name__ == "__main__":
    main()
