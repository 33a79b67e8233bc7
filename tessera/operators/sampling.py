"""Deterministic sampling.

Randomness comes from ``hash_uniform(seed, key)``: a pure function of the
seed and the row's key.  Re-running a task after an executor loss therefore
reproduces the same draws, results do not depend on partitioning, and the
same formula in SQL reproduces every draw.

* X1 ``sample_n``: exactly n rows, uniformly (the n smallest u; for large n
  the n-th is found by counts, so no task gathers the sample).
* X4 ``weighted_without_replacement``: Efraimidis-Spirakis keys
  ``-ln(u)/w``; the k smallest per group have the distribution of k
  successive weighted draws without replacement.  Zero weights never drawn.
* X2 ``weighted_pick``: X4 with k=1 as a grouped ``min_by`` (partial
  aggregate); a group whose total weight is <= 0 picks uniformly.
* X3 ``weighted_with_replacement``: integer cumulative weights
  ``[lo, hi)`` and integer rolls in ``[0, total)``.  The intervals of a group
  are array rows of some hundred items (``interval_index``): a roll meets the
  array of its value bucket by an equi-join and finds its item by bisection.
  A group with many rolls has its arrays copied, one copy per so many rolls,
  so a sheet of five items serves any number of draws without a hot task.
* X4 for many requests, ``weighted_without_replacement_draws``: candidates
  with replacement, first distinct ones kept; a request that is still short
  rolls on over what is left of its group's weight, the intervals of the items
  it has taken being skipped.  Rows are proportional to picks throughout.
* X5 ``open_packs``: the multi-stage draw as one plan over a table of
  requests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.random import composite_key, hash_bits, hash_bucket, hash_uniform
from tessera.session import scratch_path


def _cols(x):
    return [x] if isinstance(x, str) else list(x)


def _stored(df: DataFrame, name: str) -> DataFrame:
    """``df``, written once to the shared scratch folder and read back."""
    path = scratch_path(df.sparkSession, f"sampling-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sample_n(df: DataFrame, n: int, key, seed: str = "sample", gathered: int = 10_000) -> DataFrame:   # X1
    """The ``n`` rows of the smallest hash, ties by key.

    Up to ``gathered`` rows are a top-n.  For more, the n-th smallest hash is
    found by counting ranges of hashes, refined within the range that holds it
    until that has at most ``gathered`` rows (one pass over the keys for
    each factor of 4096; ``ceil(log4096(rows / gathered))`` in all); all ranges
    below are kept by a filter and only the last one is sorted.
    """
    keys = _cols(key)
    n = int(n)
    order = [F.col("_u").asc(), *[F.col(k).asc_nulls_last() for k in keys]]
    d = df.withColumn("_u", hash_bits(seed, keys))
    if n <= gathered:
        return d.orderBy(*order).limit(n).drop("_u")
    low, shift, rest, size = 0, 52, n, None        # the range [low, low + 2^shift) holds the n-th
    while shift and (size is None or size > gathered):
        shift = max(shift - 12, 0)
        inside = (F.col("_u") >= low) & (F.col("_u") < low + (1 << min(shift + 12, 52)))
        part = F.shiftright(F.col("_u") - low, shift).alias("part")
        counts = sorted((r["part"], r["n"]) for r in
                        d.where(inside).groupBy(part).agg(F.count(F.lit(1)).alias("n")).collect())
        for at, size in counts:
            if rest <= size:
                break
            rest -= size
        else:
            return df                              # no more than n rows
        low += at << shift
    edge = d.where((F.col("_u") >= low) & (F.col("_u") < low + (1 << shift))).orderBy(*order).limit(rest)
    return d.where(F.col("_u") < low).unionByName(edge).drop("_u")


def _weight(weight) -> Column:
    w = weight if isinstance(weight, Column) else F.col(weight)
    return F.coalesce(w, F.lit(1)).cast("double")


def es_key(seed: str, key, weight) -> Column:
    """Efraimidis-Spirakis key; NULL (never drawn) for non-positive weight."""
    w = _weight(weight)
    return F.when(w > 0, -F.log(hash_uniform(seed, key)) / w)


def top_k_per_group(df: DataFrame, keys: list, order: list, k, rank_col: str,
                    spread_by: str | None = None, buckets: int = 64) -> DataFrame:
    """Exact top-``k`` rows per ``keys`` group by ``order`` (a total order).

    A literal ``k`` plans a WindowGroupLimit (each task keeps k rows per group
    before the shuffle).  A per-row ``k`` column cannot, so the ranking is
    two-level: the best k per (group, hash bucket of ``spread_by``), then the
    best k among those <= buckets x k survivors.  The global top-k is inside
    the union of the per-bucket top-k, and a hot group is ranked by
    ``buckets`` tasks instead of one.
    """
    if isinstance(k, int):
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= F.lit(k))
    kc = F.col(k)
    if spread_by is not None:
        df = df.withColumn("_bkt", hash_bucket("top", spread_by, buckets))
        wb = Window.partitionBy(*keys, "_bkt").orderBy(*order)
        df = df.withColumn("_rb", F.row_number().over(wb)).where(F.col("_rb") <= kc).drop("_rb", "_bkt")
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= kc)


def weighted_without_replacement(items: DataFrame, group, item: str, weight, k,
                                 seed: str = "wor", rank_col: str = "draw") -> DataFrame:   # X4
    """Per group, min(k, #positive-weight items) items without replacement.

    ``k`` is an int (plans a WindowGroupLimit: each task keeps k rows per
    group before the shuffle) or a column name holding a per-group count.
    ``rank_col`` is the 1-based draw order.
    """
    g = _cols(group)
    d = items.withColumn("_key", es_key(seed, g + [item], weight)).where(F.col("_key").isNotNull())
    order = [F.col("_key").asc(), F.col(item).asc()]
    return top_k_per_group(d, g, order, k, rank_col, spread_by=item).drop("_key")


def weighted_pick(items: DataFrame, group, item: str, weight, seed: str = "pick",
                  out: str | None = None) -> DataFrame:                  # X2
    """One item per group, P(item) = w / total; total <= 0 -> uniform pick.

    One grouped aggregate, no join: the group total, the ES-keyed
    ``min_by`` over positive weights and a uniform ``min_by`` are computed
    side by side (all partial aggregates, so a hot group costs one partial
    row per task), and the total decides which one is the pick.
    """
    g = _cols(group)
    w = _weight(weight)
    u = hash_uniform(seed, g + [item])
    rest = [c for c in items.columns if c not in g]
    row = F.struct(*[F.col(f"`{c}`") for c in rest])
    best = items.groupBy(*g).agg(
        F.sum(w).alias("_total"),
        F.min_by(row, F.when(w > 0, F.struct((-F.log(u) / w).alias("k"), F.col(item).alias("i")))).alias("_es"),
        F.min_by(row, F.struct(u.alias("k"), F.col(item).alias("i"))).alias("_uni"))
    pick = F.when(F.col("_total") > 0, F.col("_es")).otherwise(F.col("_uni"))
    sel = best.select(*g, pick.alias("_b")).select(*g, *[F.col(f"_b.`{c}`").alias(c) for c in rest])
    return sel if out is None else sel.withColumnRenamed(item, out)


def salted_join(big: DataFrame, small: DataFrame, on: list, salt_by, salts: int = 32,
                how: str = "inner", asked: bool = False) -> DataFrame:
    """Equi-join that stays spread when one key of ``big`` is hot: ``big`` rows
    get a salt from a hash of ``salt_by`` and ``small`` rows are replicated once
    per salt, so a hot key's rows are spread over ``salts`` tasks.

    Copies are what the planner does not count: it would broadcast a ``small``
    side by its size before them, through the driver and into every task's
    memory.  So the copied side is never broadcast; both are shuffled.

    With ``asked`` a row of ``small`` is copied only for the salts that ``big``
    has of its key: no more copies than ``big`` has rows, for another reading of
    its keys.  That is for a large ``small`` of one row per key."""
    cols = salt_by if isinstance(salt_by, (list, tuple)) else [salt_by]
    cols = [c if isinstance(c, Column) else F.col(f"`{c}`") for c in cols]
    # A cheap deterministic spread (re-executed tasks salt identically).
    b = big.withColumn("_salt", F.pmod(F.xxhash64(*cols), F.lit(salts)).cast("bigint"))
    if asked:
        s = small.join(b.select(*on, "_salt").distinct(), list(on))
    else:
        s = small.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))
    return b.join(s.hint("merge"), list(on) + ["_salt"], how).drop("_salt")


def _interval_tables(items: DataFrame, g: list, item: str, weight, blocks: int):
    d = items.select(*g, F.col(item), F.coalesce(F.col(weight) if isinstance(weight, str) else weight,
                                                 F.lit(1)).alias("_w")).where(F.col("_w") > 0)
    if isinstance(d.schema["_w"].dataType, T.FractionalType):
        # Exact integer sums whatever the order: fractional weights count in
        # millionths, and in one at least.
        d = d.withColumn("_w", F.greatest(F.lit(1), F.round(F.col("_w") * 1_000_000)))
    d = d.withColumn("_w", F.col("_w").cast("bigint")) \
        .withColumn("_blk", hash_bucket("blk", item, blocks))
    bsum = d.groupBy(*g, "_blk").agg(F.sum("_w").alias("_bsum"), F.count(F.lit(1)).alias("_bcnt"))
    wg = Window.partitionBy(*g)
    boff = (bsum.withColumn("_boff", F.sum("_bsum").over(
                wg.orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)))
            .withColumn("_total", F.sum("_bsum").over(wg))
            .withColumn("_n", F.sum("_bcnt").over(wg))
            .select(*g, "_blk", F.coalesce("_boff", F.lit(0)).alias("_boff"), "_total", "_n"))
    wi = Window.partitionBy(*g, "_blk").orderBy(F.col(item), "_w").rowsBetween(Window.unboundedPreceding, 0)
    run = d.withColumn("_run", F.sum("_w").over(wi)).withColumn("_nth", F.count(F.lit(1)).over(wi))
    iv = run.join(boff, g + ["_blk"], "inner").select(
        *g, F.col(item), F.col("_w").alias("weight"),
        (F.col("_boff") + F.col("_run") - F.col("_w")).alias("lo"),
        (F.col("_boff") + F.col("_run")).alias("hi"),
        F.col("_total").alias("total"), F.col("_n").alias("n"), "_blk", "_nth")
    return iv


def cumulative_intervals(items: DataFrame, group, item: str, weight,
                         blocks: int = 1024) -> DataFrame:
    """``[lo, hi)`` integer intervals of positive weights per group, in the
    order (hash block of item, item), plus the group ``total`` and item
    count ``n``.

    Block sums are a partial aggregate; the only windows run over <= blocks
    rows per group (block offsets) and over one block's items (running sums).
    """
    return _interval_tables(items, _cols(group), item, weight, blocks).drop("_blk", "_nth")


#: Items of an array row at least, and rolls that share one copy of it.
PIECE, ROLLS = 256, 10_000


def interval_index(items: DataFrame, group, item: str, weight, blocks: int = 1024,
                   piece: int = PIECE) -> tuple[DataFrame, DataFrame]:
    """(index, tops): the intervals of ``cumulative_intervals`` as array rows.

    An index row holds the items of one range of its group: ``_lo`` where the
    range begins, ``_weight``, ``_ends`` (the items' hi) and ``_items`` (structs
    of item, lo and w), in order.  It has about ``piece`` items, or the root of
    the group's number of items if that is more.  ``tops`` has one row per
    group: ``_total`` and the ``_starts`` of its ranges, no more of them than
    the larger of 2 * ``blocks`` and that root.
    """
    g = _cols(group)
    iv = _interval_tables(items, g, item, weight, blocks)
    size = F.greatest(F.lit(piece), F.ceil(F.sqrt("n"))).cast("bigint")
    # Whole hash blocks share a row where they are small; else a block has several.
    together = F.floor(F.lit(blocks) * size / F.col("n")).cast("bigint")
    iv = (iv.withColumn("_first", F.floor(F.col("_blk") / F.greatest(F.lit(1), together)))
          .withColumn("_part", F.when(together > 1, 0).otherwise(F.floor((F.col("_nth") - 1) / size))))
    row = F.struct("hi", "lo", F.col("weight").alias("w"), F.col(item).alias("item"))
    index = (iv.groupBy(*g, "_first", "_part")
             .agg(F.sort_array(F.collect_list(row)).alias("_a"), F.max("total").alias("_total"))
             .select(*g, "_total", F.col("_a")[0]["lo"].alias("_lo"), F.col("_a.hi").alias("_ends"),
                     (F.element_at("_a", -1)["hi"] - F.col("_a")[0]["lo"]).alias("_weight"),
                     F.transform("_a", lambda x: F.struct(x["item"].alias("item"), x["lo"].alias("lo"),
                                                          x["w"].alias("w"))).alias("_items")))
    tops = index.groupBy(*g).agg(F.max("_total").alias("_total"), F.sort_array(F.collect_list("_lo")).alias("_starts"))
    return index.drop("_total"), tops


def _upto(ascending: Column, value: Column) -> Column:
    """How many of ``ascending`` are no larger than ``value``, by bisection: as
    many steps as the array's size has binary digits.  ``value`` is read in each
    step, so it should be at hand."""
    digits = F.length(F.bin(F.size(ascending).cast("bigint")))
    steps = F.slice(F.array(*[F.lit(1 << b) for b in range(24, -1, -1)]), -digits, digits)
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        F.try_element_at(ascending, at + step) <= value, at + step).otherwise(at))


def _copies(weight: Column) -> Column:
    """Copies of an index row that its group's rolls are dealt over: by its
    share of the weight, or of the rows if that is more (rolls that skip heavy
    items fall on light ones)."""
    share = F.greatest(weight / F.col("_total"), F.lit(1.0) / F.col("_rows"))
    return F.greatest(F.lit(1), F.ceil(F.col("_load") * share / ROLLS)).cast("bigint")


def _find(requests: DataFrame, index: DataFrame, tops: DataFrame, g: list, rk: list, k: str, seed: str,
          draw_col: str, taken: bool = False) -> DataFrame:
    """One row per roll of each request (``k`` names how many): the columns of
    ``requests``, ``draw_col`` from 0, ``_total`` of the group and ``_got``, the
    struct of item, lo and w that it hits.  Groups without weight drop out.

    With ``taken`` a request rolls over the weight that its array ``_taken``
    leaves.  Every roll meets one index row; a row that many rolls hit has as
    many copies as it needs.
    """
    load = requests.groupBy(*g).agg(F.sum(k).alias("_load"))
    per_group = tops.where("_total > 0").join(load, g).withColumn("_rows", F.size("_starts"))
    # Many requests may ask one hot group: its row is salted.
    asked = salted_join(requests, per_group, g, rk)
    below = F.col("_total") - _weight_of("_taken") if taken else F.col("_total")
    starts = F.col("_starts")

    def roll(d: Column) -> Column:
        r = F.floor(hash_uniform(seed, [*rk, d]) * below).cast("bigint")
        r = _skipping(r, F.col("_taken")) if taken else r
        return F.struct(d.alias("d"), r.alias("roll"))

    # Apart from ``roll``, or every step of the bisection would hash anew.
    def find(x: Column) -> Column:
        return F.struct(x["d"].alias("d"), x["roll"].alias("roll"), _upto(starts, x["roll"]).alias("at"))

    def place(x: Column) -> Column:
        lo = F.element_at(starts, x["at"])
        weight = F.coalesce(F.try_element_at(starts, x["at"] + 1), F.col("_total")) - lo
        copy = F.pmod(F.xxhash64(*rk, x["d"]), _copies(weight))
        return F.struct(x["d"].alias("d"), x["roll"].alias("roll"), lo.alias("lo"), copy.alias("copy"))

    rolls = F.transform(F.transform(F.transform(F.sequence(F.lit(0), (F.col(k) - 1).cast("int")), roll), find), place)
    dealt = (asked.select(*requests.columns, "_total", F.explode(rolls).alias("_x"))
             .select(*requests.columns, "_total", F.col("_x.d").alias(draw_col), F.col("_x.roll").alias("_roll"),
                     F.col("_x.lo").alias("_lo"), F.col("_x.copy").alias("_copy")))
    copied = (index.join(per_group.drop("_starts"), g)
              .withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("bigint"), _copies(F.col("_weight")) - 1)))
              .select(*g, "_lo", "_copy", "_ends", "_items"))
    return (dealt.join(copied, [*g, "_lo", "_copy"])
            .withColumn("_got", F.element_at("_items", _upto(F.col("_ends"), F.col("_roll")) + 1))
            .drop("_lo", "_copy", "_roll", "_ends", "_items"))


def _weight_of(taken: str) -> Column:
    return F.aggregate(taken, F.lit(0).cast("bigint"), lambda a, t: a + t["w"])


def weighted_with_replacement(items: DataFrame, requests: DataFrame, group, item: str, weight,
                              k, request_key, seed: str = "wr", blocks: int = 1024,
                              draw_col: str = "draw", carry=()) -> DataFrame:       # X3
    """For each request row (carrying the ``group`` columns, a ``request_key``
    and a count ``k`` (int or column)), ``k`` items drawn with replacement
    with P = w / total.  Groups with total <= 0 (or no items) draw nothing.

    Output: group + request key + ``carry`` columns, ``draw_col`` (0-based)
    and ``item``.
    """
    g = _cols(group)
    rk = _cols(request_key)
    keys = list(dict.fromkeys(g + rk))
    carry = [c for c in carry if c not in keys]
    kcol = F.lit(int(k)) if isinstance(k, int) else F.coalesce(F.col(k), F.lit(1))
    req = requests.select(*[F.col(c) for c in keys + carry], kcol.cast("int").alias("_kk")).where("_kk > 0")
    index, tops = interval_index(items, g, item, weight, blocks)
    drawn = _find(req, index, tops, g, rk, "_kk", seed, draw_col)
    return drawn.select(*[F.col(c) for c in keys + carry], draw_col, F.col("_got.item").alias(item))


def _first_distinct(got: Column, k: Column, but: Column | None = None) -> Column:
    """The first ``k`` structs of distinct items, in order."""
    def add(out: Column, x: Column) -> Column:
        new = ~F.exists(out, lambda y: y["item"] == x["item"])
        return F.when((F.size(out) < k) & new, F.concat(out, F.array(x))).otherwise(out)

    return F.aggregate(got, F.filter(got, lambda x: F.lit(False)), add)


def _in_order(draw_col: str) -> Column:
    """A request's finds in the order of its rolls."""
    by_draw = F.sort_array(F.collect_list(F.struct(F.col(draw_col).alias("d"), F.col("_got").alias("x"))))
    return F.transform(by_draw, lambda e: e["x"])


def _skipping(roll: Column, taken: Column) -> Column:
    """A roll over what is left, as a roll over everything: each taken interval
    (in order of lo) that begins at or before it moves it on by its weight."""
    return F.aggregate(F.sort_array(F.transform(taken, lambda t: F.struct(t["lo"].alias("lo"), t["w"].alias("w")))),
                       roll, lambda r, t: F.when(t["lo"] <= r, r + t["w"]).otherwise(r))


def _drawn_without_replacement(requests: DataFrame, index: DataFrame, tops: DataFrame, g: list, rk: list,
                               carry: list, seed: str, again: str, oversample: int, direct: Column | None,
                               draw_col: str) -> DataFrame:
    """Requests (``_k`` picks each) with their picks, one row each: (keys, carry,
    ``draw_col`` from 0, ``_item``).

    All roll ``oversample * _k`` times and keep the first ``_k`` distinct items
    (those of ``direct`` roll ``_k`` times and keep all: their rolls are picks
    as they are, and are never gathered by request).  The rest goes in
    rounds: requests still short roll twice for each missing pick over the
    weight they have not taken.  A round adds one item to each of them at
    least, and rounds end when none is short; each is written to the shared
    scratch folder.
    """
    keys = list(dict.fromkeys(g + rk))
    carry = [c for c in carry if c not in keys]
    base = [*keys, "_k", *carry]
    index, tops = _stored(index, "index"), _stored(tops, "tops")
    times = (F.col("_k") * int(oversample)).cast("int")
    if direct is None:
        picks, rolls = None, _find(requests.select(*base, times.alias("_kk")), index, tops, g, rk, "_kk", seed, "_d")
    else:
        req = requests.select(*base, direct.alias("_direct")) \
            .withColumn("_kk", F.when(F.col("_direct"), F.col("_k")).otherwise(times))
        rolls = _stored(_find(req, index, tops, g, rk, "_kk", seed, "_d"), "rolls")
        picks = rolls.where("_direct").select(*keys, *carry, F.lit(0).alias("_before"), F.col("_d").alias("_i"),
                                              F.col("_got").alias("_x"))
        rolls = rolls.where(~F.col("_direct"))
    state = _stored(
        rolls.groupBy(*base, "_total").agg(_in_order("_d").alias("_got"))
        .withColumn("_new", _first_distinct(F.col("_got"), F.col("_k")))
        .select(*base, "_total", "_new", F.col("_new").alias("_taken"), F.lit(0).alias("_before")), "draws-0")
    out = [state]
    while True:
        missing = F.col("_k") - F.size("_taken")
        short = (state.where((missing > 0) & (F.col("_total") > _weight_of("_taken")))
                 .select(*base, "_taken", (missing * 2).alias("_kk")))
        if short.isEmpty():
            break
        # A request's rows differ in nothing but the roll; NULL keys group too.
        state = _stored(
            _find(short, index, tops, g, rk, "_kk", f"{again}|{len(out)}", "_d", taken=True)
            .groupBy(*base, "_total", "_taken").agg(_in_order("_d").alias("_got"))
            .withColumn("_new", _first_distinct(F.col("_got"), F.col("_k") - F.size("_taken")))
            .select(*base, "_total", "_new", F.concat("_taken", "_new").alias("_taken"),
                    F.size("_taken").alias("_before")), f"draws-{len(out)}")
        out.append(state)
    for s in out:
        part = s.select(*keys, *carry, "_before", F.posexplode("_new").alias("_i", "_x"))
        picks = part if picks is None else picks.unionByName(part)
    return picks.select(*keys, *carry, (F.col("_before") + F.col("_i")).cast("int").alias(draw_col),
                        F.col("_x.item").alias("_item"))


def weighted_without_replacement_draws(items: DataFrame, requests: DataFrame, group, item: str,
                                       weight, k, request_key, seed: str = "wor",
                                       oversample: int = 2, blocks: int = 1024,
                                       draw_col: str = "draw") -> DataFrame:
    """X4 for many requests against shared item groups (e.g. packs against
    sheets), with cost proportional to the picks rather than to the groups.

    1. draw ``oversample * k`` candidates *with* replacement (X3) and keep the
       first ``k`` distinct items in draw order.  Dropping repeats from a
       with-replacement stream is exactly successive weighted sampling
       without replacement.
    2. requests still short of ``k`` (a dominant weight, or fewer items than
       ``k``) go on from where they stopped: rolls over their remaining weight,
       the intervals of taken items skipped (sampling is Markov, so the
       continuation is exact).  A request may be short because its group has no
       more items; it ends then.

    Rounds of step 2 run when this is called (see ``_drawn_without_replacement``).
    A request's picks, at most ``k``, are one row in between.
    Output: group + request key columns, ``draw_col`` (0-based draw order)
    and ``item``.
    """
    g = _cols(group)
    rk = _cols(request_key)
    keys = list(dict.fromkeys(g + rk))
    kcol = F.lit(int(k)) if isinstance(k, int) else F.coalesce(F.col(k), F.lit(1))
    req = requests.select(*keys, kcol.cast("int").alias("_k")).where(F.col("_k") > 0)
    index, tops = interval_index(items, g, item, weight, blocks)
    return _drawn_without_replacement(req, index, tops, g, rk, [], f"{seed}|c", f"{seed}|r", oversample,
                                      None, draw_col).withColumnRenamed("_item", item)


def open_packs(requests: DataFrame, content_weights: DataFrame, contents: DataFrame,
               sheets: DataFrame, sheet_cards: DataFrame, cards: DataFrame | None = None,
               seed: str = "pack", request_id: str = "request_id",
               card_key: str = "uuid") -> DataFrame:   # X5
    """Open one pack per request row ``(request_id, setCode, boosterName)``;
    requests may share an id, and equal rows open a pack each (``copy`` tells
    them apart, from 1).

    1. pick a template per request (X2, weighted by boosterWeight);
    2. its sheets with pick counts (NULL -> 1, 0 -> skipped);
    3. per (request, sheet): with-replacement draws (X3) when the sheet
       allows duplicates or takes a single pick, else the exact draw without
       replacement (candidates from the same X3 pass, then rounds over the
       remaining weight for any shortfall);
    4. fetch card rows (J8): order by (sheetName, draw); uuids missing from
       ``cards`` are dropped, as a batch fetch drops misses.

    Requests without a template come back once with ``status =
    'no_template'`` and NULL card columns instead of failing the job; so do
    those whose template draws nothing (no contents, or only sheets without
    cards of positive weight), with ``status = 'empty'`` and their
    ``boosterIndex``.
    The draws run when this is called and are written to
    ``spark.checkpoint.dir``, so a lost executor replays no draw.
    Output: request_id, setCode, boosterName, copy, boosterIndex, sheetName, draw,
    cardUuid, isFoil (the sheet's foil flag), status (+ card columns when
    ``cards`` is given).
    """
    keys = ["setCode", "boosterName"]
    # A request's identity is its whole row.  Counting equal rows also spreads
    # the (narrow) request table over the shuffle partitions, so that the
    # fan-out to templates x sheets x picks never runs in the few tasks of its
    # source scan.  The digest is the key of all that follows (never NULL).
    ident = [request_id, *keys]
    req = (requests.select(request_id, F.upper(F.col("setCode")).alias("setCode"), "boosterName")
           .groupBy(*ident).agg(F.count(F.lit(1)).alias("_copies"))
           .select(*ident, F.explode(F.sequence(F.lit(1).cast("bigint"), "_copies")).alias("copy"))
           .withColumn("_rid", F.md5(composite_key([*ident, "copy"]))))
    ident = [request_id, "copy"]
    cw = content_weights.select(*keys, "boosterIndex",
                                F.coalesce("boosterWeight", F.lit(1)).alias("boosterWeight"))
    cand = req.join(cw, keys, "inner")
    picked = weighted_pick(cand, ["_rid"], "boosterIndex", "boosterWeight", seed=f"{seed}|tpl")
    missing = req.join(picked.select("_rid"), "_rid", "left_anti")
    pk = contents.select(*keys, "boosterIndex", "sheetName",
                         F.coalesce("sheetPicks", F.lit(1)).cast("int").alias("picks"))
    per_sheet = (picked.select("_rid", *ident, *keys, "boosterIndex").join(pk, keys + ["boosterIndex"], "inner")
                 .where(F.col("picks") > 0))
    props = sheets.select(*keys, "sheetName",
                          F.coalesce("sheetAllowDuplicates", F.lit(False)).alias("allow_dup"),
                          F.col("sheetIsFoil")).dropDuplicates(keys + ["sheetName"])
    per_sheet = per_sheet.join(props, keys + ["sheetName"], "left") \
        .withColumn("allow_dup", F.coalesce("allow_dup", F.lit(False)))
    sc = sheet_cards.where(F.col("cardUuid").isNotNull() & (F.trim("cardUuid") != "")) \
        .select(*keys, "sheetName", "cardUuid", F.coalesce("cardWeight", F.lit(1)).alias("cardWeight"))
    grp = keys + ["sheetName"]
    rk = ["_rid", "sheetName"]
    carry = [*ident, "boosterIndex", "sheetIsFoil"]
    # One draw serves both kinds of sheet.  A single pick needs no dedupe: one
    # weighted draw with replacement is one draw without replacement.
    per_sheet = per_sheet.withColumnRenamed("picks", "_k")
    index, tops = interval_index(sc, grp, "cardUuid", "cardWeight")
    drawn = _drawn_without_replacement(per_sheet, index, tops, grp, rk, carry, f"{seed}|draw", f"{seed}|nodup", 2,
                                       F.col("allow_dup") | (F.col("_k") <= 1), "draw")
    out = drawn.select(request_id, *keys, "copy", "boosterIndex", "sheetName", "draw",
                       F.col("_item").alias("cardUuid"),
                       F.coalesce("sheetIsFoil", F.lit(False)).alias("isFoil"), F.lit("ok").alias("status"))
    empty = picked.join(drawn.select("_rid").distinct(), "_rid", "left_anti").withColumn("status", F.lit("empty"))
    missing = missing.withColumn("boosterIndex", F.lit(None).cast("bigint")).withColumn("status", F.lit("no_template"))
    cols = [request_id, *keys, "copy", "boosterIndex", "status"]
    without = empty.select(*cols).unionByName(missing.select(*cols))
    if cards is not None:
        # Rows without a card take no part: their NULL key would gather them.
        c = cards.alias("c")
        out = (out.alias("o").join(c, F.col("o.cardUuid") == F.col(f"c.`{card_key}`"), "inner")
               .select("o.*", *[F.col(f"c.`{x}`") for x in cards.columns if x not in out.columns]))
    return out.unionByName(without, allowMissingColumns=True)
