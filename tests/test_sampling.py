"""Exact sizes, no duplicates without replacement, zero weights never
drawn, and frequencies close to the exact sequential probabilities."""

import itertools

from pyspark.sql import functions as F

from tessera.operators import sampling as X

WEIGHTS = {"a": 5, "b": 3, "c": 1, "d": 1, "z": 0}


def _items(spark, groups=1):
    rows = [(g, k, w) for g in range(groups) for k, w in WEIGHTS.items()]
    return spark.createDataFrame(rows, "g long, item string, w long")


def _exact_pairs(weights, k=2):
    pos = {i: w for i, w in weights.items() if w > 0}
    out = {}
    for seq in itertools.permutations(pos, k):
        p, rem = 1.0, dict(pos)
        for s in seq:
            p *= rem[s] / sum(rem.values())
            del rem[s]
        out[seq] = p
    return out


def _check_pairs(pdf, n):
    exact = _exact_pairs(WEIGHTS)
    got = pdf.groupby("g")["item"].apply(tuple).value_counts() / n
    for seq, p in exact.items():
        assert abs(got.get(seq, 0.0) - p) < 0.02, (seq, got.get(seq, 0.0), p)


def test_without_replacement_es(spark):
    n = 4000
    out = X.weighted_without_replacement(_items(spark, n), "g", "item", "w", 2, seed="t1")
    pdf = out.orderBy("g", "draw").toPandas()
    assert (pdf.groupby("g").size() == 2).all()
    assert "z" not in set(pdf["item"])
    _check_pairs(pdf, n)


def test_without_replacement_two_phase(spark):
    n = 4000
    items = spark.createDataFrame([("s", k, w) for k, w in WEIGHTS.items()], "sheet string, item string, w long")
    req = spark.range(n).select(F.col("id").alias("g"), F.lit("s").alias("sheet"))
    out = X.weighted_without_replacement_draws(items, req, "sheet", "item", "w", 2, ["g"], seed="t2",
                                               oversample=1)
    pdf = out.orderBy("g", "draw").toPandas()
    assert (pdf.groupby("g").size() == 2).all()
    assert not pdf.duplicated(["g", "item"]).any()
    assert "z" not in set(pdf["item"])
    _check_pairs(pdf, n)


def test_without_replacement_caps_at_available(spark):
    items = spark.createDataFrame([("s", k, w) for k, w in WEIGHTS.items()], "sheet string, item string, w long")
    req = spark.range(50).select(F.col("id").alias("g"), F.lit("s").alias("sheet"))
    out = X.weighted_without_replacement_draws(items, req, "sheet", "item", "w", 10, ["g"], seed="t3")
    pdf = out.toPandas()
    assert (pdf.groupby("g").size() == 4).all()      # four positive weights


def test_with_replacement_frequencies(spark):
    items = spark.createDataFrame([("s", k, w) for k, w in WEIGHTS.items()], "sheet string, item string, w long")
    req = spark.createDataFrame([("s", "r1")], "sheet string, rid string")
    out = X.weighted_with_replacement(items, req, "sheet", "item", "w", 20000, "rid", seed="t4", blocks=4)
    pdf = out.toPandas()
    assert len(pdf) == 20000
    freq = pdf["item"].value_counts() / len(pdf)
    total = sum(WEIGHTS.values())
    for k, w in WEIGHTS.items():
        assert abs(freq.get(k, 0.0) - w / total) < 0.015
    empty = spark.createDataFrame([("s", "x", 0)], "sheet string, item string, w long")
    assert X.weighted_with_replacement(empty, req, "sheet", "item", "w", 5, "rid").count() == 0


def test_pick_uniform_when_total_not_positive(spark):
    items = spark.createDataFrame([(g, k, 0) for g in range(2000) for k in "abcd"], "g long, item string, w long")
    pdf = X.weighted_pick(items, "g", "item", "w").toPandas()
    assert len(pdf) == 2000
    freq = pdf["item"].value_counts() / 2000
    assert all(abs(freq[k] - 0.25) < 0.04 for k in "abcd")


def test_sample_n_exact(spark):
    df = spark.range(1000)
    assert X.sample_n(df, 37, "id").count() == 37
    assert X.sample_n(df, 5000, "id").count() == 1000


def test_open_packs(spark):
    from tessera.plans.standins import booster_tables
    from tests.conftest import SF001
    weights, contents, sheets, sheet_cards = booster_tables(spark, SF001)
    req = spark.createDataFrame([(i, "small" if i % 2 else "PROMO", "draft") for i in range(200)] +
                                [(999, "NOPE", "draft")], "request_id long, setCode string, boosterName string")
    pdf = X.open_packs(req, weights, contents, sheets, sheet_cards, seed="t5").toPandas()
    assert pdf.loc[pdf.request_id == 999, "status"].tolist() == ["no_template"]
    ok = pdf[pdf.status == "ok"]
    assert set(ok.request_id) == set(range(200))          # lower-case set codes are upper-cased
    # Each request used one template; a sheet contributes `picks` cards
    # (1 for template 0, 2 for template 1), capped by the sheet's size.
    assert (ok.groupby("request_id")["boosterIndex"].nunique() == 1).all()
    nodup = ok.groupby(["request_id", "sheetName"])["cardUuid"].apply(lambda s: s.is_unique)
    even = [k for k in nodup.index if int(k[1].split("#")[1]) % 2 == 0]
    assert even and all(nodup[k] for k in even)
    sizes = ok.groupby(["request_id", "sheetName", "boosterIndex"]).size().reset_index(name="n")
    assert (sizes["n"] <= sizes["boosterIndex"] + 1).all()


def test_top_k_per_group_column_k_matches_brute_force(spark):
    import random
    rnd = random.Random(3)
    rows = [(g, f"i{j}", rnd.random(), 1 + g % 4) for g in range(30) for j in range(rnd.randint(0, 200))]
    df = spark.createDataFrame(rows, "g long, item string, v double, k int")
    got = X.top_k_per_group(df, ["g"], [F.col("v").asc(), F.col("item").asc()], "k", "r", spread_by="item",
                            buckets=8).toPandas()
    want = set()
    by = {}
    for g, item, v, k in rows:
        by.setdefault(g, []).append((v, item, k))
    for g, lst in by.items():
        lst.sort()
        for r, (v, item, k) in enumerate(lst[:lst[0][2]], 1):
            want.add((g, item, r))
    assert set(zip(got.g, got.item, got.r)) == want


def test_salted_join_equals_plain_join(spark):
    big = spark.range(3000).select((F.col("id") % 3 == 0).cast("int").alias("g"), F.col("id").alias("item"))
    small = spark.createDataFrame([(0, "a"), (1, "b")], "g int, tag string")
    a = sorted(tuple(r) for r in X.salted_join(big, small, ["g"], "item", salts=8).collect())
    b = sorted(tuple(r) for r in big.join(small, ["g"]).collect())
    assert a == b


def test_salted_join_never_broadcasts_the_copied_side(spark):
    """The planner counts a row once, before its copies; before, it broadcast them."""
    big = spark.range(3000).select((F.col("id") % 50).alias("g"), F.col("id").alias("item"))
    small = spark.range(50).select(F.col("id").alias("g"), F.lit("a").alias("tag"))
    for how in ("inner", "left"):
        out = X.salted_join(big, small, ["g"], "item", how=how)
        assert out.count() == 3000
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_existence_flags_hold_no_copied_keys_in_memory(spark):
    from tessera.operators import aggregates as A
    asked = spark.range(200).select(F.col("id").alias("k"))
    facts = spark.range(400).select((F.col("id") * 2).alias("k"))
    out = A.exists_flag(asked, facts, ["k"])
    assert {r.k for r in out.where("exists").collect()} == set(range(0, 200, 2)) and out.count() == 200
    out.collect()
    assert "BroadcastHashJoin" not in out._jdf.queryExecution().executedPlan().toString()


def _large_and_small_groups(spark):
    """Intervals of two groups, one of several array rows per hash block."""
    items = spark.range(3000).select(F.when(F.col("id") < 5, "small").otherwise("large").alias("g"), "id",
                                     (F.col("id") % 11 * F.when(F.col("id") == 2000, 10 ** 6).otherwise(1)).alias("w"))
    return items, X.interval_index(items, "g", "id", "w", blocks=4, piece=50)


def test_interval_index_covers_every_weight_once(spark):
    items, (index, tops) = _large_and_small_groups(spark)
    rows = index.collect()
    want = {(r.g, r.id, r.w) for r in items.collect() if r.w > 0}
    assert {(r.g, i.item, i.w) for r in rows for i in r._items} == want
    for t in tops.collect():
        mine = sorted((r for r in rows if r.g == t.g), key=lambda r: r._lo)
        flat = [i for r in mine for i in r._items]
        assert [r._lo for r in mine] == t._starts
        assert [i.lo for i in flat] == [sum(j.w for j in flat[:n]) for n in range(len(flat))]
        assert [e for r in mine for e in r._ends] == [i.lo + i.w for i in flat]
        assert sum(r._weight for r in mine) == t._total
        assert max(len(r._items) for r in mine) <= 55 and (t.g == "large") == (len(mine) > 1)


def test_a_roll_meets_one_array_however_heavy_an_item(spark):
    items, _ = _large_and_small_groups(spark)
    req = spark.range(300).select(F.lit("large").alias("g"), F.col("id").alias("rid"))
    out = X.weighted_without_replacement_draws(items, req, "g", "id", "w", 6, "rid", blocks=4).toPandas()
    assert (out.groupby("rid").size() == 6).all() and not out.duplicated(["rid", "id"]).any()
    assert (out[out.id == 2000].draw == 0).mean() > 0.9          # nearly all take the heavy item first
    index, tops = X.interval_index(items, "g", "id", "w", blocks=4, piece=50)
    short = req.select("g", "rid", F.array(F.struct(F.lit(2000).cast("long").alias("item"),
                                                    F.lit(0).cast("long").alias("lo"),
                                                    F.lit(1).cast("long").alias("w"))).alias("_taken"),
                       F.lit(12).alias("_kk"))
    assert X._find(short, index, tops, ["g"], ["rid"], "_kk", "s", "_d", taken=True).count() == 300 * 12


def test_hot_small_sheet_is_dealt_over_copies(spark):
    items = spark.createDataFrame([("s", k, w) for k, w in WEIGHTS.items()], "sheet string, item string, w long")
    req = spark.range(20_000).select(F.lit("s").alias("sheet"), F.col("id").alias("rid"))
    out = X.weighted_with_replacement(items, req, "sheet", "item", "w", 10, "rid")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "_copy" in plan
    freq = out.groupBy("item").count().toPandas().set_index("item")["count"] / 200_000
    assert abs(freq["a"] - 0.5) < 0.01 and abs(freq["d"] - 0.1) < 0.01


def test_without_replacement_after_skips_is_exact(spark):
    """One roll for two picks: the second always comes from a round over what is left."""
    n = 4000
    items = spark.createDataFrame([("s", k, w) for k, w in WEIGHTS.items()], "sheet string, item string, w long")
    req = spark.range(n).select(F.col("id").alias("g"), F.lit("s").alias("sheet"))
    index, tops = X.interval_index(items, "sheet", "item", "w")
    one = X._drawn_without_replacement(req.withColumn("_k", F.lit(2)), index, tops, ["sheet"], ["g"], [], "a", "b", 1,
                                       F.lit(False), "draw").withColumnRenamed("_item", "item")
    _check_pairs(one.orderBy("g", "draw").toPandas(), n)


def test_sample_n_by_counts_is_the_top_n(spark):
    df = spark.range(5000).select(F.col("id"), (F.col("id") % 700).alias("k")).repartition(7)
    for n in (0, 1, 37, 2500, 4999, 5000, 9000):
        want = sorted(r.id for r in X.sample_n(df, n, ["k", "id"]).collect())
        assert sorted(r.id for r in X.sample_n(df, n, ["k", "id"], gathered=0 if n % 2 else 5).collect()) == want
    tied = X.sample_n(df, 3000, "k", gathered=3)                 # equal hashes: ties by key
    assert tied.count() == 3000 and tied.columns == ["id", "k"]
    assert X.sample_n(df.limit(0), 5, "k", gathered=0).count() == 0


def test_draws_independent_of_partitioning(spark):
    """Same rows whatever the input partitioning or shuffle width: a task
    recomputed after an executor loss reproduces its draws exactly."""
    base = spark.range(3000).select((F.col("id") % 7).alias("g"), F.col("id").alias("item"),
                                    (F.col("id") % 5).alias("w"))
    req = spark.range(200).select((F.col("id") % 7).alias("g"), F.col("id").alias("rid"))

    def run(parts, shuffle):
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle))
        items = base.repartition(parts)
        r = req.repartition(parts)
        out = {
            "wr": X.weighted_with_replacement(items, r, "g", "item", "w", 3, "rid"),
            "two": X.weighted_without_replacement_draws(items, r, "g", "item", "w", 4, "rid"),
            "pick": X.weighted_pick(items, "g", "item", "w"),
            "es": X.weighted_without_replacement(items, "g", "item", "w", 3),
            "n": X.sample_n(items, 10, "item"),
        }
        return {k: sorted(tuple(x) for x in v.collect()) for k, v in out.items()}

    try:
        a = run(2, 3)
        b = run(9, 13)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert a == b


def test_direct_rolls_are_not_gathered(spark):
    """Before, every roll of a pack was gathered by request, those of single picks too."""
    cards = spark.createDataFrame([("S", "draft", sh, f"{sh}{i}", i + 1) for sh in ("a", "b") for i in range(9)],
                                  "setCode string, boosterName string, sheetName string, cardUuid string, cardWeight long")
    sheets = spark.createDataFrame([("S", "draft", "a", False, False), ("S", "draft", "b", True, True)],
                                   "setCode string, boosterName string, sheetName string, sheetAllowDuplicates boolean, "
                                   "sheetIsFoil boolean")
    weights = spark.createDataFrame([("S", "draft", 0, 1)], "setCode string, boosterName string, boosterIndex long, boosterWeight long")
    contents = spark.createDataFrame([("S", "draft", 0, "a", 3), ("S", "draft", 0, "b", 2)],
                                     "setCode string, boosterName string, boosterIndex long, sheetName string, sheetPicks long")
    req = spark.createDataFrame([(i, "s", "draft") for i in range(30)], "request_id long, setCode string, boosterName string")
    out = X.open_packs(req, weights, contents, sheets, cards)
    assert any("sampling-rolls" in f for f in out.inputFiles())
    drawn = {}
    for r in out.collect():
        drawn.setdefault((r.request_id, r.sheetName), []).append((r.draw, r.cardUuid))
    assert len(drawn) == 60
    for (_, sheet), got in drawn.items():
        assert sorted(d for d, _ in got) == list(range(3 if sheet == "a" else 2))
        assert sheet == "b" or len({c for _, c in got}) == 3


def test_a_roll_is_hashed_once(spark):
    """Before, each step of the bisection hashed the roll anew."""
    items = spark.createDataFrame([("g", i, i + 1) for i in range(40)], "g string, id long, w long")
    index, tops = (X._stored(t, "test") for t in X.interval_index(items, "g", "id", "w", blocks=4, piece=5))
    req = spark.createDataFrame([(i, "g", 3) for i in range(20)], "rid long, g string, _kk int")
    found = X._find(req, index, tops, ["g"], ["rid"], "_kk", "s", "_d")
    assert found._jdf.queryExecution().analyzed().toString().count("md5(") == 1
    assert found.count() == 60
