"""Aggregates (A1-A10).

Every grouped aggregate here is algebraic or has a partial form, so Spark
combines map-side before the shuffle: a hot group costs one partial row per
task, not all of its rows.  Map builders (A8-A10) dedupe their keys first
(``map_from_entries`` rejects duplicate keys) and sort entries, so their
output is deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.predicates import all_of, filter_map


def count_rows(df: DataFrame, *conds: Column | None, filters: dict | None = None,
               group=None, alias: str = "n") -> DataFrame:                 # A1
    c = all_of(list(conds) + [filter_map(df, filters)])
    d = df if c is None else df.where(c)
    if group:
        return d.groupBy(*([group] if isinstance(group, str) else group)).agg(F.count(F.lit(1)).alias(alias))
    return d.agg(F.count(F.lit(1)).alias(alias))


def price_trend(df: DataFrame, key=None, price: str = "price", date: str = "date",
                where: Column | None = None, money_scale: int | None = None) -> DataFrame:   # A2
    """min/max/avg price, first/last date and data points.

    With ``key`` set: one row per key.  Without: one global row; an empty
    input still yields one row (NULLs and ``data_points = 0``).
    """
    d = df if where is None else df.where(where)
    _, avg = _money(price, money_scale)
    aggs = [F.min(price).alias("min_price"), F.max(price).alias("max_price"),
            avg.alias("avg_price"), F.min(date).alias("first_date"),
            F.max(date).alias("last_date"), F.count(F.lit(1)).alias("data_points")]
    if key is None:
        return d.agg(*aggs)
    return d.groupBy(*([key] if isinstance(key, str) else key)).agg(*aggs)


def financial_summary(joined: DataFrame, group=None, item: str = "uuid",
                      price: str = "price", date: str = "date",
                      money_scale: int | None = None) -> DataFrame:       # A3
    """count(distinct item), coalesced sum/avg/min/max(price), max(date).

    The distinct count is planned as a two-level aggregate keyed by
    ``(group, item)`` first, so it also combines map-side."""
    total, avg = _money(price, money_scale)
    aggs = [F.countDistinct(item).alias("card_count"),
            F.coalesce(total, F.lit(0.0)).alias("total_value"),
            F.coalesce(avg, F.lit(0.0)).alias("avg_value"),
            F.coalesce(F.min(price), F.lit(0.0)).alias("min_value"),
            F.coalesce(F.max(price), F.lit(0.0)).alias("max_value"),
            F.max(date).alias("date")]
    if group is None:
        return joined.agg(*aggs)
    return joined.groupBy(*([group] if isinstance(group, str) else group)).agg(*aggs)


def group_having(df: DataFrame, group, aggs: list[Column], having: Column | None = None) -> DataFrame:   # A4
    out = df.groupBy(*([group] if isinstance(group, str) else group)).agg(*aggs)
    return out if having is None else out.where(having)


def exists_flag(requests: DataFrame, facts: DataFrame, on: list[str],
                cond: Column | None = None, flag: str = "exists") -> DataFrame:   # A5
    """For each request row, whether a matching fact (satisfying ``cond``) exists.

    Facts are reduced to distinct keys first (partial aggregation), then
    left-joined; requests are never multiplied."""
    from tessera.operators.sampling import salted_join
    hits = (facts if cond is None else facts.where(cond)).select(*on).distinct() \
        .withColumn("_hit", F.lit(True))
    # Many requests may share a key: salt by a hash of the whole request row.
    # There may be as many hits as requests: they are copied only as asked.
    salt = F.xxhash64(*[F.col(f"`{c}`") for c in requests.columns])
    return (salted_join(requests, hits, on, salt, how="left", asked=True)
            .withColumn(flag, F.coalesce(F.col("_hit"), F.lit(False))).drop("_hit"))


def distinct_on(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:   # A6
    """DISTINCT ON (keys): per key combination, the row first in ``order``
    (ascending, NULLs last; ``order`` must make the choice unique).

    Planned as ``min(struct(order…, rest…))`` per group: a partial aggregate,
    so no group is ever gathered into one task (unlike a window)."""
    rest = [c for c in df.columns if c not in keys]
    # NULLs last: a null flag sorts before each order column (false < true).
    rank = F.struct(*[x for i, c in enumerate(order)
                      for x in (F.col(f"`{c}`").isNull().alias(f"_n{i}"), F.col(f"`{c}`").alias(f"_o{i}"))])
    agg = df.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in rest]), rank).alias("_best"))
    return agg.select(*[F.col(f"`{k}`") for k in keys],
                      *[F.col(f"_best.`{c}`").alias(c) for c in rest]).select(*df.columns)


def distinct_on_with_fallback(requests: DataFrame, items: DataFrame, request_col: str,
                              primary: str, fallback: str, keys: list[str],
                              order: list[str]) -> DataFrame:
    """A6 in bulk: per request value, items whose ``primary`` column equals it;
    if none, items whose ``fallback`` column equals it; then DISTINCT ON keys.

    Both matches are salted equi-joins (a value matching a third of the items
    spreads over many tasks).  DISTINCT ON runs first, with the match
    priority leading the order, so that the per-request best priority (a
    partial aggregate) is joined back to one row per (request, keys) group
    rather than to the raw matches.
    """
    from tessera.operators.sampling import salted_join
    req = requests.select(F.col(request_col).alias("_req")).distinct()
    salt = [order[0]] if order else keys
    m1 = salted_join(items.withColumn("_req", F.col(primary)), req, ["_req"], salt).withColumn("_prio", F.lit(1))
    m2 = salted_join(items.withColumn("_req", F.col(fallback)), req, ["_req"], salt).withColumn("_prio", F.lit(2))
    cand = m1.unionByName(m2)
    best = cand.groupBy("_req").agg(F.min("_prio").alias("_prio"))
    first = distinct_on(cand, ["_req"] + keys, ["_prio"] + list(order))
    # One request may own many groups: salt that lookup as well.
    out = salted_join(first, best, ["_req", "_prio"], keys).drop("_prio")
    return out.withColumnRenamed("_req", request_col)


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:     # A7
    return df.select(column).where(F.col(column).isNotNull()).distinct() \
        .orderBy(F.col(column).asc_nulls_last())


def _sorted_map(key: Column, value: Column, orderable: bool = False) -> Column:
    """map_from_entries over entries sorted by key (deterministic order).
    Keys are unique here, so comparing keys alone is a total order; with
    orderable (scalar) values the natural struct order is the same order and
    avoids a comparator lambda."""
    entries = F.collect_list(F.struct(key.alias("k"), value.alias("v")))
    if orderable:
        return F.map_from_entries(F.array_sort(entries))
    by_key = F.array_sort(entries, lambda a, b: F.when(a["k"] < b["k"], -1)
                          .when(a["k"] > b["k"], 1).otherwise(0))
    return F.map_from_entries(by_key)


def _money(price: str, money_scale: int | None):
    """Sum and average of ``price``.  With ``money_scale`` (decimal places of
    the currency) the sum is exact: prices are summed as integer units of
    10^-scale, so results do not depend on partitioning or summation order
    (double sums do), and avg = units / count / 10^scale."""
    if money_scale is None:
        return F.sum(price), F.avg(price)
    f = float(10 ** money_scale)
    units = F.sum(F.round(F.col(price) * F.lit(f)).cast("bigint"))
    return units / F.lit(f), units / F.count(price) / F.lit(f)


def nested_map(df: DataFrame, id_cols: list[str], levels: list[str], leaf_key: str,
               leaf_value: str, out: str = "prices", pick=F.max,
               text_default: str = "", value_default: float = 0.0,
               split_levels: int = 0, task_rows: int | None = None) -> DataFrame:                       # A8
    """Rows -> nested maps ``levels[0] -> … -> {leaf_key: leaf_value}``.

    Missing text becomes ``""`` and a missing value ``0.0``; duplicate full
    keys are resolved by ``pick`` (max by default) first.

    One output row per id (``split_levels=0``), or per (id, first
    ``split_levels`` levels) with the remaining levels nested: the bulk form
    for data where one id may be huge, since a row holds one group's map and
    the split spreads a hot id over tasks.

    Two shuffles whatever the depth: the dedupe (a map-side partial aggregate
    hashed on the full key), then one repartition by the output row's key;
    every level is then built inside those partitions (each level groups by
    a superset of the partitioning keys, so no further exchange).  Building
    level by level with a shuffle each would move the data once per level.

    With ``task_rows`` it is one: rows are dealt by the output row's key over
    tasks of about so many rows (one count, answered by Parquet's footers) and
    deduped there.  That is for rows that repeat few full keys, which a dedupe
    of its own would only move once more.
    """
    deal = None
    if task_rows:
        tasks = max(-(-df.count() // task_rows), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        deal = (tasks, *id_cols, *levels[:split_levels])
    entries = _entries(df, id_cols, levels, leaf_key, leaf_value, pick, text_default, value_default, deal)
    if deal is None:
        entries = entries.repartition(*id_cols, *levels[:split_levels])
    return _nest(entries, id_cols, levels, leaf_key, out, split_levels)


def _entries(df: DataFrame, id_cols: list[str], levels: list[str], leaf_key: str, leaf_value: str, pick=F.max,
             text_default: str = "", value_default: float = 0.0, deal: tuple | None = None) -> DataFrame:
    """One row per full key, its value as ``_v``; ``deal``: how rows are dealt
    before, if they are."""
    d = df.select(*[F.col(c) for c in id_cols],
                  *[F.coalesce(F.col(c).cast("string"), F.lit(text_default)).alias(c)
                    for c in levels + [leaf_key]],
                  F.coalesce(F.col(leaf_value).cast("double"), F.lit(value_default)).alias("_v"))
    d = d.repartition(*deal) if deal else d
    return d.groupBy(*id_cols, *levels, leaf_key).agg(pick("_v").alias("_v"))


def _nest(entries: DataFrame, id_cols: list[str], levels: list[str], leaf_key: str, out: str,
          split_levels: int = 0) -> DataFrame:
    """Nested maps of ``entries``, which are dealt by the output row's key."""
    cur = entries
    grp = id_cols + levels
    cur = cur.groupBy(*grp).agg(_sorted_map(F.col(leaf_key), F.col("_v"), orderable=True).alias("_m"))
    for lvl in reversed(levels[split_levels:]):
        grp = grp[:-1]
        cur = cur.groupBy(*grp).agg(_sorted_map(F.col(lvl), F.col("_m")).alias("_m"))
    return cur.withColumnRenamed("_m", out)


def nested_map_parts(df: DataFrame, id_cols: list[str], levels: list[str], leaf_key: str, leaf_value: str,
                     out: str = "prices", most: int = 10_000, split_levels: int = 0, **options) -> DataFrame:
    """``nested_map`` in rows of at most about ``most`` entries: (id, ``part``,
    map).  An id of more entries has several parts, dealt by the hash of a full
    key, so that no row or task holds its whole history; the parts' entries are
    disjoint, and ``merge_parts`` makes one map of them.

    Rows are deduped once, before they are counted and dealt; counts and
    entries share that shuffle, and an id with very many entries is split by
    AQE where they meet its count."""
    keys = levels + [leaf_key]
    entries = _entries(df, id_cols, levels, leaf_key, leaf_value, **options)
    sized = entries.groupBy(*id_cols).agg(F.ceil(F.count("_v") / most).cast("bigint").alias("_parts"))
    dealt = entries.join(sized, id_cols).withColumn(
        "part", F.pmod(F.xxhash64(*[F.col(c) for c in keys]), F.col("_parts"))).drop("_parts")
    dealt = dealt.repartition(*id_cols, "part", *levels[:split_levels])
    return _nest(dealt, [*id_cols, "part"], levels, leaf_key, out, split_levels)


def merge_parts(parts: DataFrame, id_cols: list[str], levels: list[str], leaf_key: str, leaf_value: str,
                out: str = "prices") -> DataFrame:
    """One map per id of ``nested_map_parts``, for ids whose map one row may hold."""
    long = flatten_nested_map(parts, id_cols, levels, leaf_key, leaf_value, col=out)
    return nested_map(long, id_cols, levels, leaf_key, leaf_value, out=out)


def flatten_nested_map(df: DataFrame, id_cols: list[str], levels: list[str], leaf_key: str,
                       leaf_value: str, col: str = "prices") -> DataFrame:
    """Inverse of ``nested_map`` (long rows), for checking and export."""
    cur = df.select(*id_cols, F.col(col).alias("_m0"))
    names = levels + [leaf_key]
    for i, name in enumerate(names):
        last = i == len(names) - 1
        cur = cur.select(*[c for c in cur.columns if c != f"_m{i}"],
                         F.explode(f"_m{i}").alias(name, leaf_value if last else f"_m{i + 1}"))
    return cur


def group_map(df: DataFrame, group: list[str], key: str, value: str, out: str = "entries",
              default=1, pick=F.max) -> DataFrame:                       # A9 / A10 core
    """One ``map<key, value>`` per group; NULL value -> ``default``; NULL or
    blank keys dropped; duplicate keys resolved by ``pick``."""
    d = df.where(F.col(key).isNotNull() & (F.trim(F.col(key).cast("string")) != ""))
    d = d.select(*group, F.col(key).alias("_k"),
                 F.coalesce(F.col(value), F.lit(default)).alias("_v"))
    # Dedupe first, by a partial aggregate on (group, key): a hot group's raw
    # rows are reduced in the map tasks and spread by key; only its distinct
    # entries, which the map row holds anyway, meet in one task.
    d = d.groupBy(*group, "_k").agg(pick("_v").alias("_v"))
    return d.groupBy(*group).agg(_sorted_map(F.col("_k"), F.col("_v"), orderable=True).alias(out))


def templates(weights: DataFrame, contents: DataFrame, keys: list[str], index: str,
              weight: str, sheet: str, picks: str) -> DataFrame:         # A9
    """Pack templates: each ``(keys…, index)`` of ``weights`` with its weight
    (NULL -> 1) and a ``sheets`` map ``{sheet: picks}`` (NULL picks -> 1; a
    template without contents gets an empty map)."""
    sheets = group_map(contents, keys + [index], sheet, picks, out="sheets", default=1)
    w = weights.select(*keys, index, F.coalesce(F.col(weight), F.lit(1)).cast("bigint").alias("weight"))
    out = w.join(sheets, keys + [index], "left")
    return out.withColumn("sheets", F.coalesce(
        F.col("sheets"), F.create_map().cast(sheets.schema["sheets"].dataType)))


def empty_templates(weights: DataFrame, contents: DataFrame, keys: list[str], index: str, weight: str,
                    sheet: str) -> DataFrame:
    """The templates without contents, by an anti join: no map is built."""
    named = contents.where(F.col(sheet).isNotNull() & (F.trim(F.col(sheet).cast("string")) != ""))
    w = weights.select(*keys, index, F.coalesce(F.col(weight), F.lit(1)).cast("bigint").alias("weight"))
    return w.join(named.select(*keys, index), keys + [index], "left_anti")


def weight_map(df: DataFrame, group: list[str], item: str, weight: str,
               out: str = "cards") -> DataFrame:                         # A10
    """``{item: weight}`` per group (NULL weight -> 1, blank items dropped);
    groups with no usable item are absent (no map rather than an empty one)."""
    return group_map(df, group, item, weight, out=out, default=1)
