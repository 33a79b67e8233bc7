"""Jaro-Winkler fuzzy match (P11) and its score column (K5), one query or in bulk.

The score follows the common byte-level definition: strings are compared as
UTF-8 bytes, case-sensitively; the match window is ``max(l1, l2) // 2 - 1``;
an empty side scores 0; the Winkler prefix bonus (up to 4 bytes, weight 0.1)
applies only when the Jaro score exceeds 0.7.

All of it is built-in Column expressions: a codegen'd upper bound on the score
discards almost every row, and the exact score folds over the bytes of one
string with ``locate`` and ``overlay`` on the other, whatever their lengths.
No Python worker, no shuffle.  ``fuzzy_join`` matches two tables of names by
signatures, so that only pairs that share one are scored; names, their sets and
the signatures' sizes are worked out when it is called.
"""

from __future__ import annotations

from collections.abc import Callable
from math import comb

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import scratch_path

#: Stands for a byte that is matched already; no byte view holds it.
_TAKEN = "Ā"


# The expressions are written as SQL text: one parse in the JVM instead of
# hundreds of calls to it.
def _name(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def _byte_view(sql: str) -> str:
    # One character per UTF-8 byte, so lengths and replace() count bytes.
    return f"decode(encode({sql}, 'UTF-8'), 'ISO-8859-1')"


def _bytes_literal(b: bytes) -> str:
    return f"decode(X'{b.hex()}', 'ISO-8859-1')"


def _let(value: str, name: str, body: str) -> str:
    """``body`` with the value worked out once, however often it is read."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _score_sql(x: str, y: str) -> str:
    """Score of two byte views (SQL of each); NULL if one is.

    The j-th byte of y takes the first free equal byte of x in its window;
    ``hits`` are the bytes matched in y's order, ``t`` those in x's.
    """
    chars = "transform(sequence(1, length({0})), i -> substring({0}, i, 1))".format
    match = _let("position(substring(v.y, j, 1), s.x, greatest(j - v.window, 1))", "at", f"""
        if(at > 0 AND at <= least(v.l1, j + v.window),
           struct(overlay(s.x PLACING '{_TAKEN}' FROM at FOR 1) AS x, concat(s.hits, substring(v.y, j, 1)) AS hits), s)""")
    done = f"aggregate(sequence(1, v.l2), struct(v.x AS x, '' AS hits), (s, j) -> {match})"
    in_order = (f"filter(zip_with({chars('d.x')}, {chars('v.x')}, (t, b) -> if(t = '{_TAKEN}', b, NULL)), "
                "b -> b IS NOT NULL)")
    moved = f"aggregate(zip_with({in_order}, {chars('d.hits')}, (a, b) -> int(a != b)), 0, (n, e) -> n + e)"
    jaro = (f"(double(length(d.hits)) / v.l1 + double(length(d.hits)) / v.l2 + "
            f"double(length(d.hits) - {moved} div 2) / length(d.hits)) / 3.0D")
    common = "0"
    for k in range(4, 0, -1):
        here = f"least(v.l1, v.l2) >= {k} AND substring(v.x, {k}, 1) = substring(v.y, {k}, 1)"
        common = f"if({here}, 1 + {common}, 0)"
    score = _let(jaro, "j", f"if(j > 0.7D, j + 0.1D * {common} * (1.0D - j), j)")
    matched = _let(done, "d", f"if(length(d.hits) = 0, 0.0D, {score})")
    sized = _let("struct(u.x AS x, u.y AS y, length(u.x) AS l1, length(u.y) AS l2, "
                 "int(greatest(greatest(length(u.x), length(u.y)) div 2 - 1, 0)) AS window)", "v",
                 f"if(v.l1 = 0 OR v.l2 = 0, 0.0D, {matched})")
    return _let(f"struct({x} AS x, {y} AS y)", "u", f"if(u.x IS NOT NULL AND u.y IS NOT NULL, {sized}, NULL)")


def jaro_winkler_score(c: str, query: str) -> Column:
    """Score of the column named ``c`` against a fixed string."""
    return F.expr(_score_sql(_byte_view(_name(c)), _bytes_literal(query.encode())))


def jaro_winkler_columns(a: str, b: str) -> Column:
    """Score of two columns against each other."""
    return F.expr(_score_sql(_byte_view(_name(a)), _byte_view(_name(b))))


def _least_jaro(threshold: float, prefix: int = 4) -> float:
    """What Jaro must exceed for a score above ``threshold`` with a common
    prefix of at most ``prefix`` bytes."""
    if threshold < 0.7:
        return threshold
    return max(0.7, (threshold - 0.1 * prefix) / (1 - 0.1 * prefix))


def fuzzy_prefilter(c: str, query: str, threshold: float) -> Column:
    """Native necessary condition for a score of ``c`` and ``query`` above ``threshold``.

    Matches m are bounded by the multiset intersection of bytes; with
    transpositions at 0 that bounds Jaro, and with the largest prefix bonus
    (4 bytes) it bounds the final score.  Never drops a true match.
    """
    q = query.encode()
    if not q:
        return F.lit(False)              # empty query scores 0
    x = _byte_view(_name(c))
    size = f"length({x})"
    common = " + ".join(f"least({size} - length(replace({x}, {_bytes_literal(bytes([b]))}, '')), {q.count(b)})"
                        for b in sorted(set(q)))
    bound = f"(m / {size} + m / {len(q)}D + 1) / 3 > {_least_jaro(threshold) - 1e-9!r}D"
    return F.expr(f"{size} > 0 AND {_let(common, 'm', f'm > 0 AND {bound}')}")


def check_threshold(threshold: float) -> float:
    if not (0.0 <= float(threshold) <= 1.0):
        raise ValueError(f"threshold must be within [0, 1], got {threshold}")
    return float(threshold)


def fuzzy_filter(df: DataFrame, c: str, query: str, threshold: float = 0.8,
                 score_col: str | None = "similarity") -> DataFrame:
    """Rows whose ``c`` scores strictly above ``threshold``; the score is
    kept as ``score_col`` (for K5 ranking) unless that is None."""
    check_threshold(threshold)
    name = score_col or "_similarity"
    out = (df.where(fuzzy_prefilter(c, query, threshold))
           .withColumn(name, jaro_winkler_score(c, query))
           .where(F.col(name) > F.lit(threshold)))
    return out if score_col else out.drop(name)


# --------------------------------------------------------------------------
# Bulk: names against names.
# --------------------------------------------------------------------------
#: Lengths up to ``_SHORT`` are a band each; those of a longer band differ by
#: the factor ``_BAND`` at most.
_SHORT, _BAND = 32, 1.25
#: Signatures that a name has at most, if more of its members are to go into one.
_MOST_KEYS = 100


def _stored(df: DataFrame) -> DataFrame:
    """``df``, written once to the shared scratch folder and read back by many
    tasks: names are few bytes but much work."""
    path = scratch_path(df.sparkSession, "fuzzy")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).repartition(_tasks(df))


def _tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _signed(df: DataFrame, name: str) -> DataFrame:
    """Distinct names with their byte view ``x``, length, its band, and their
    bytes in hex."""
    long = F.floor(F.log(F.col("l") / _SHORT) / F.log(F.lit(_BAND)) + 1e-9) + _SHORT
    return (df.select(F.col(name).alias("name")).where(F.col(name).isNotNull() & (F.col(name) != ""))
            .distinct()
            .select("name", F.expr(_byte_view("name")).alias("x"))
            .select("*", F.length("x").alias("l"), F.regexp_extract_all(F.hex(F.encode("name", "UTF-8")),
                                                                        F.lit(".."), 0).alias("bytes"))
            .withColumn("band", F.when(F.col("l") <= _SHORT, F.col("l")).otherwise(long).cast("int")))


def _overlap(l1: Column, l2: Column, jaro: Column) -> Column:
    """Common bytes (with repeats) without which Jaro can't exceed ``jaro``."""
    least = (3 * jaro - 1) * l1 * l2 / (l1 + l2)
    return F.greatest(F.lit(1), F.floor(least - 1e-9) + 1).cast("int")


def _once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of the value, worked out once however often it is read."""
    return F.transform(F.array(value), body)[0]


def _lowest(band: Column) -> Column:
    """A length no greater than any of the band."""
    return F.when(band <= _SHORT, band).otherwise(F.floor(_SHORT * F.pow(F.lit(_BAND), band - _SHORT) - 1e-6))


def _alphabet(names: DataFrame) -> DataFrame:
    """(other, most): of every band how often a name of it has a byte at most."""
    return (names.select("band", "name", F.explode("bytes").alias("byte"))
            .groupBy("band", "name", "byte").agg(F.count("*").alias("n"))
            .groupBy("band", "byte").agg(F.max("n").alias("n"))
            .groupBy(F.col("band").alias("other")).agg(F.map_from_entries(F.collect_list(F.struct("byte", "n"))).alias("most")))


def _ranked(names: DataFrame, ranks: dict[str, int]) -> DataFrame:
    """``names`` with ``tokens`` for their bytes: bytes are numbered by rarity,
    repeats told apart, so a name is a set of ascending numbers."""
    rank = F.create_map(*[F.lit(v) for kv in sorted(ranks.items()) for v in kv])
    by_rarity = F.array_sort(F.transform("bytes", lambda b: F.struct(rank[b].cast("bigint").alias("r"), b.alias("byte"))))
    tokens = _once(by_rarity, lambda ranked: _once(F.transform(ranked, lambda v: v["r"]), lambda rs: F.transform(
        ranked, lambda v, i: F.struct((i - F.array_position(rs, v["r"]) + 2).cast("int").alias("nth"), v["byte"].alias("byte"),
                                      (v["r"] * (1 << 32) + i - F.array_position(rs, v["r"]) + 1).alias("n")))))
    return names.withColumn("tokens", tokens)


def _members(names: DataFrame, met: DataFrame, others: list[int], threshold: float,
             side: str) -> DataFrame:
    """(name, prefix, head, low, high, set, spare): the names' sets for every
    band and every length of a common prefix of the other side, ``met``.

    Members that no name of the other band has are left out.  ``spare`` is how many of the rest may go without a partner.
    """
    heads = (met.select("x", F.explode(F.sequence(F.lit(1), F.least(F.lit(4), F.col("l")))).alias("prefix"))
             .select("prefix", F.substring(F.col("x"), F.lit(1), F.col("prefix")).alias("head")).distinct())
    longer = (names.withColumn("prefix", F.explode(F.sequence(F.lit(1), F.least(F.lit(4), F.col("l")))))
              .withColumn("head", F.substring(F.col("x"), F.lit(1), F.col("prefix"))).join(heads, ["prefix", "head"], "left_semi"))
    rows = names.withColumn("prefix", F.lit(0)).withColumn("head", F.lit("")).unionByName(longer)
    jaro = F.create_map(*[F.lit(v) for p in range(5) for v in (p, _least_jaro(threshold, p))])[F.col("prefix")]
    rows = (rows.withColumn("other", F.explode(F.array(*[F.lit(b) for b in others])))
            .withColumn("need", _overlap(F.col("l"), _lowest(F.col("other")), jaro)).where("need <= l")
            .join(F.broadcast(_alphabet(met)), "other"))
    kept = _once(F.col("most"), lambda most: F.transform(F.filter("tokens", lambda v: v["nth"] <= F.coalesce(
        F.try_element_at(most, v["byte"]), F.lit(0))), lambda v: v["n"]))
    low, high = ("band", "other") if side == "left" else ("other", "band")
    return (rows.select(F.col("name").alias(side), "prefix", "head", F.col(low).alias("low"), F.col(high).alias("high"),
                        kept.alias("set"), "need")
            .withColumn("spare", F.size("set") - F.col("need")).where("spare >= 0"))


def _together(spares: DataFrame, threshold: float) -> dict[tuple[int, int, int], int]:
    """How many members a signature holds, by (prefix, low, high): all that two
    names must share at least, or as many as names of the most ``spare``
    members have ``_MOST_KEYS`` signatures of."""
    out = {}
    for r in spares.groupBy("prefix", "low", "high").agg(F.max("spare").alias("spare")).select(
            "*", _overlap(_lowest(F.col("low")), _lowest(F.col("high")), F.create_map(
                *[F.lit(v) for p in range(5) for v in (p, _least_jaro(threshold, p))])[F.col("prefix")]).alias("least")).collect():
        n = min(2, r["least"]) if r["prefix"] < 2 else 1
        while n < r["least"] and comb(r["spare"] + n + 1, n + 1) <= _MOST_KEYS:
            n += 1
        out[r["prefix"], r["low"], r["high"]] = n
    return out


def _keys(members: DataFrame, together: DataFrame, side: str) -> DataFrame:
    """(name, prefix, low, high, head, key): the signatures of every name.

    Two names whose sets share ``need`` members share n of the first ``spare +
    n`` of each, n no more than they must share.
    """
    first = F.slice("set", F.lit(1), F.col("spare") + F.col("n"))
    start = F.array(F.struct(F.lit(0).cast("bigint").alias("h"), F.lit(0).alias("at")))
    # One member more at a time, so that enough are left for the rest.
    chosen = _once(F.struct(first.alias("set"), "spare"), lambda u: F.aggregate(
        F.sequence(F.lit(1), F.col("n")), start, lambda some, k: F.flatten(F.transform(
            some, lambda c: F.transform(F.sequence(c["at"] + 1, u["spare"] + k), lambda i: F.struct(
                F.xxhash64(c["h"], F.get(u["set"], i - 1)).alias("h"), i.alias("at")))))))
    return (members.join(F.broadcast(together), ["prefix", "low", "high"])
            .select(side, "prefix", "low", "high", "head", F.explode(chosen["h"]).alias("key")))


def fuzzy_pairs(left: DataFrame, left_on: str, right: DataFrame, right_on: str, threshold: float = 0.8) -> DataFrame:
    """(left, right, similarity): the distinct names of two tables that score
    strictly above ``threshold``; NULL and empty names match nothing.

    Names meet only by a shared signature (see ``_keys``), an equi-join; what
    is exact is the score, so a signature may bring too many pairs together
    but never miss one.  Pairs are looked for by the length of their common
    prefix: the shorter it is, the more they must share; the longer, the more
    of it is part of the signature.  The driver sees the 256 byte counts, the
    bands of the lengths (fewer than 200) and a number for each two of them.
    """
    check_threshold(threshold)
    a, b = _stored(_signed(left, left_on)), _stored(_signed(right, right_on))
    counts = {r["byte"]: r["n"] for r in a.select(F.explode("bytes").alias("byte"))
              .unionByName(b.select(F.explode("bytes").alias("byte"))).groupBy("byte").agg(F.count("*").alias("n")).collect()}
    ranks = {byte: i for i, byte in enumerate(sorted(counts, key=lambda x: (counts[x], x)))}
    bands = [sorted(r["band"] for r in d.select("band").distinct().collect()) for d in (a, b)]
    none = a.limit(0).select(F.col("name").alias("left"), F.col("name").alias("right"), F.lit(0.0).alias("similarity"))
    if not all(bands):
        return none
    a, b = _stored(_ranked(a, ranks)), _stored(_ranked(b, ranks))
    sets = [_stored(_members(a, b, bands[1], threshold, "left")),
            _stored(_members(b, a, bands[0], threshold, "right"))]
    sizes = _together(sets[0].select("prefix", "low", "high", "spare").unionByName(
        sets[1].select("prefix", "low", "high", "spare")), threshold)
    if not sizes:
        return none
    together = left.sparkSession.createDataFrame([(*k, n) for k, n in sorted(sizes.items())],
                                                 "prefix int, low int, high int, n int")
    met = _keys(sets[0], together, "left").join(_keys(sets[1], together, "right"),
                                                ["prefix", "low", "high", "head", "key"])
    # Pairs are few bytes but much work, too.
    return (met.select("left", "right").repartition(_tasks(left), "left", "right").distinct()
            .withColumn("similarity", jaro_winkler_columns("left", "right"))
            .where(F.col("similarity") > F.lit(threshold)))


def fuzzy_join(left: DataFrame, left_on: str, right: DataFrame, right_on: str, threshold: float = 0.8,
               score_col: str = "similarity") -> DataFrame:
    """All columns of both tables (their names must differ) and the score, for
    every two rows whose names score strictly above ``threshold``."""
    pairs = fuzzy_pairs(left, left_on, right, right_on, threshold).withColumnsRenamed(
        {"left": "_left", "right": "_right", "similarity": score_col})
    return (left.join(pairs, F.col(left_on) == F.col("_left")).join(right, F.col(right_on) == F.col("_right"))
            .drop("_left", "_right"))
