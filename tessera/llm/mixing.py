"""Mixing sources to target weights by iterative proportional fitting.

Token counts by source, language and topic are raked until all three marginals
meet their targets; a document is then sampled with its cell's calibrated
probability.  As no probability can exceed 1, the raked weights may be bounded:
a cell that would exceed its tokens is taken whole, and the others are raked
against what is left of the targets.  The sources' factors stay in a table
(there may be any number of sources); a round sums languages-by-topics
matrices, which are all that the driver sees.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import keep

#: Topics by phrases (their case is fixed, so that texts needn't be folded);
#: the first that holds, "prose" for the rest.
TOPICS = (("legal", ("icensed under", "eleased under", "ights reserved")), ("contact", ("@",)),
          ("tables", (" | ",)), ("figures", ("0", "5")), ("questions", ("?",)))


def topic(text: str | Column) -> Column:
    """The document's topic, from its whole text (null: prose)."""
    c = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    out = None
    for name, phrases in TOPICS:
        hit = F.contains(c, F.lit(phrases[0]))
        for p in phrases[1:]:
            hit = hit | F.contains(c, F.lit(p))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise("prose")


def tokens(text: str) -> Column:
    """About how many tokens a text has: a quarter of its bytes, rounded up."""
    return F.ceil(F.coalesce(F.octet_length(text), F.lit(0)) / 4).cast("long")


def uniform(id_col: str, seed: int = 42) -> Column:
    """A number in [0, 1) by the md5 of seed and id: the same in any run."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(h, 1, 12), 16, 10).cast("double") / F.lit(float(16 ** 12))


def _keys(text_col: str, source_col: str, lang_col: str) -> list[Column]:
    return [F.coalesce(F.col(source_col).cast("string"), F.lit("(none)")).alias("source"),
            F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
            topic(text_col).alias("topic")]


#: The part of its tokens that a source, language or topic gives at most, if
#: the sample has room for it; a little less than all, so that the marginals
#: leave each other some choice.
WHOLE = 0.98


def bounded(want: dict, held: dict, total: float) -> dict:
    """Targets in proportion to ``want``, each at most ``WHOLE`` of what is
    ``held``, of ``total`` in all: those that hold too little give that much,
    and the others share the rest."""
    full: set = set()
    while True:
        left = total - sum(WHOLE * held[k] for k in full)
        per = left / sum(w for k, w in want.items() if k not in full) if len(full) < len(want) else 0.0
        more = {k for k, w in want.items() if k not in full and per * w > WHOLE * held[k]}
        if not more:
            return {k: WHOLE * held[k] if k in full else per * w for k, w in want.items()}
        full |= more


def weights(df: DataFrame, *, text_col: str = "text", source_col: str = "source", lang_col: str = "lang",
            temper: float = 0.7, keep_share: float = 0.5, rounds: int = 12) -> DataFrame:
    """Cells (source, lang, topic, tokens, ratio, p), one per combination held.

    The targets of each marginal are its token shares to the power ``temper``,
    scaled to one: large sources, languages and topics lose, small ones gain.
    The sample is ``keep_share`` of all tokens.  A source, language or topic
    whose target exceeds the tokens it has (all but 1 - ``WHOLE`` of them) has
    these as its target, and the others share the rest in proportion.  A cell's
    weight is its tokens times the factors of its source, language and topic,
    but never more than its tokens; ``p`` (to six places), the weight over the
    tokens, is its sampling probability, ``ratio`` that over the share sampled.
    A round solves the sources' factors exactly, then steps those of languages
    and topics towards what their bounded cells leave of the targets;
    ``misses`` tells how far the sample is off them.  Nulls are a source
    ``(none)`` and a language ``und``.  Cells without tokens (empty texts only)
    have ratio 1.  An empty table gives no cells.
    """
    cells = keep(df.select(*_keys(text_col, source_col, lang_col), tokens(text_col).alias("tokens"))
                 .groupBy("source", "lang", "topic").agg(F.sum("tokens").alias("tokens")))
    # Languages by topics: few, whatever the corpus; sources stay in the table.
    grid = cells.groupBy("lang", "topic").agg(F.sum("tokens").alias("tokens")).collect()
    total = float(sum(r["tokens"] for r in grid))
    if not total:
        return cells.withColumn("ratio", F.lit(1.0)).withColumn("p", F.lit(min(1.0, keep_share)))
    held: dict[str, dict] = {"lang": {}, "topic": {}}
    for r in grid:
        for name, of in held.items():
            of[r[name]] = of.get(r[name], 0.0) + r["tokens"]
    share = min(keep_share, WHOLE)
    goal = {n: bounded({k: (v / total) ** temper for k, v in of.items() if v}, of, share * total)
            for n, of in held.items()}
    factor = {n: dict.fromkeys(g, 1.0) for n, g in goal.items()}
    of_source = (cells.where("tokens > 0").groupBy("source").agg(F.sum("tokens").alias("held"))
                 .withColumn("want", F.pow(F.col("held") / F.lit(total), F.lit(temper))))
    # ``bounded`` over a table of any size: the sources that give all they have grow round by round.
    per, full = 0.0, -1
    while True:
        whole = F.col("want") * F.lit(per) > F.col("held") * F.lit(WHOLE)
        r = of_source.agg(F.sum(whole.cast("long")), F.sum(F.when(whole, F.col("held") * F.lit(WHOLE))),
                          F.sum(F.when(~whole, F.col("want")))).first()
        if r[0] == full or not r[2]:
            break
        full, per = r[0], (share * total - (r[1] or 0.0)) / r[2]
    live = keep(cells.where("tokens > 0").join(of_source.select("source", F.least(
        F.col("want") * F.lit(per), F.col("held") * F.lit(WHOLE)).alias("goal")), "source").repartition("source"))
    per_source = Window.partitionBy("source")        # languages by topics at most
    falling = per_source.orderBy(F.desc("r"), "lang", "topic")

    def raked() -> DataFrame:
        """Cells with the bounded probabilities ``p`` that meet the sources' targets."""
        r = F.lit(1.0)
        for name, f in factor.items():
            r = r * F.create_map(*[F.lit(x) for kv in sorted(f.items()) for x in kv])[F.col(name)]
        above = F.coalesce(F.sum("tokens").over(falling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        rest = F.sum(F.col("tokens") * F.col("r")).over(falling.rowsBetween(0, Window.unboundedFollowing))
        # With the cells before this one taken whole, the factor of the others;
        # the first that leaves this cell within its tokens is the source's.
        c = (F.col("goal") - above) / rest
        ok = F.when(F.col("c") * F.col("r") <= 1, F.struct("n", "c"))
        return (live.withColumn("r", r).withColumn("c", c).withColumn("n", F.row_number().over(falling))
                .withColumn("c", F.min(ok).over(per_source)["c"])
                .withColumn("p", F.least(F.lit(1.0), F.col("c") * F.col("r"))))

    for _ in range(rounds):
        whole = F.col("p") >= 1
        m = {(r["lang"], r["topic"]): (r["whole"], r["part"]) for r in raked().groupBy("lang", "topic").agg(
            F.sum(F.when(whole, F.col("tokens")).otherwise(0.0)).alias("whole"),
            F.sum(F.when(whole, 0.0).otherwise(F.col("tokens") * F.col("p"))).alias("part")).collect()}
        for i, name in enumerate(("lang", "topic")):
            for k, g in goal[name].items():
                whole_k = sum(w for cell, (w, _) in m.items() if cell[i] == k)
                part_k = sum(w for cell, (_, w) in m.items() if cell[i] == k)
                step = max((g - whole_k) / part_k, LEAST_STEP) if part_k > 0 else 1.0
                factor[name][k] *= step
                m = {cell: (w, v * step if cell[i] == k else v) for cell, (w, v) in m.items()}
    fitted = raked().select("source", "lang", "topic", "p")
    return (cells.join(fitted, ["source", "lang", "topic"], "left")
            .withColumn("p", F.round(F.coalesce("p", F.lit(share)), 6))
            .select("source", "lang", "topic", "tokens", (F.col("p") / F.lit(share)).alias("ratio"), "p"))


#: A language's or topic's factor shrinks to this part of itself in a round at most.
LEAST_STEP = 0.05


def misses(cells: DataFrame, temper: float = 0.7) -> DataFrame:
    """(marginal, value, target, expected, whole): the shares of the sampled
    tokens of every source, language and topic, as wanted and as expected by
    ``p``, and the part of its own tokens that is sampled.  Those that are short
    of their target are sampled nearly whole."""
    out = None
    held, drawn = cells.agg(F.sum("tokens"), F.sum(F.col("tokens") * F.col("p"))).first()
    for name in ("source", "lang", "topic"):
        part = (cells.groupBy(F.col(name).alias("value"))
                .agg(F.sum("tokens").alias("n"), F.sum(F.col("tokens") * F.col("p")).alias("d")).where("n > 0")
                .withColumn("share", F.pow(F.col("n") / F.lit(held), F.lit(temper))))
        scale = part.agg(F.sum("share")).first()[0]
        part = part.select(F.lit(name).alias("marginal"), "value", (F.col("share") / F.lit(scale)).alias("target"),
                           (F.col("d") / F.lit(drawn)).alias("expected"), (F.col("d") / F.col("n")).alias("whole"))
        out = part if out is None else out.unionByName(part)
    return out


#: A cell's rows go to so many tasks at most, before AQE splits them further.
MOST_SALTS = 256


def draw(df: DataFrame, cells: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
           source_col: str = "source", lang_col: str = "lang", seed: int = 42) -> DataFrame:
    """The rows of ``df`` drawn with their cell's probability: (row, source,
    lang, topic, p), where the struct ``row`` has all columns of ``df``.

    A row stays if the uniform number of its id is below p: the same rows in
    any run and partitioning; repeated ids stay or go together, and so do null
    ids of one cell.  Rows are dealt by cell and a salt, each cell being there
    once per salt, so that a cell with a third of all rows meets in no one
    task; cells (sources by languages by topics) are few beside documents.
    """
    salts = min(MOST_SALTS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    salt = F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(salts)).alias("salt")
    keyed = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
                      *_keys(text_col, source_col, lang_col), uniform(id_col, seed).alias("u"), salt)
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("salt")
    return (keyed.join(cells.select("source", "lang", "topic", "p", each), ["source", "lang", "topic", "salt"])
            .where("u < p").select("row", "source", "lang", "topic", "p"))


def sample(df: DataFrame, cells: DataFrame, **options) -> DataFrame:
    """The rows that ``draw`` draws, with the columns of ``df``."""
    return draw(df, cells, **options).select("row.*")


def oracle_sql(temper: float = 0.7, keep_share: float = 0.5, rounds: int = 12, seed: int = 42) -> str:
    """DuckDB SQL of the sample over ``documents``: the rounds of ``weights``,
    the factors of languages and topics as tables."""
    case = " ".join("WHEN " + " OR ".join(f"contains(coalesce(text, ''), '{p}')" for p in phrases)
                    + f" THEN '{name}'" for name, phrases in TOPICS)
    ctes = [f"""docs AS MATERIALIZED (SELECT doc_id, coalesce(source, '(none)') AS source,
  coalesce(lang, 'und') AS lang, CASE {case} ELSE 'prose' END AS topic,
  CAST(ceil(coalesce(strlen(text), 0) / 4.0) AS BIGINT) AS n_tokens FROM documents)""",
            "cells AS MATERIALIZED (SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS tokens "
            "FROM docs GROUP BY ALL)",
            "live AS MATERIALIZED (SELECT * FROM cells WHERE tokens > 0)"]
    names = ("source", "lang", "topic")
    share = min(keep_share, WHOLE)
    for n in names:
        # With those of the smallest room before this one giving all they have:
        # the first that has room for its share decides the scale.
        ctes += [f"""want_{n} AS MATERIALIZED (SELECT {n}, held, pow(held / all_t, {temper}) AS want, all_t FROM (
  SELECT {n}, sum(tokens) AS held, (SELECT sum(tokens) FROM live) AS all_t FROM live GROUP BY {n}))""",
                 f"""per_{n} AS MATERIALIZED (SELECT arg_min(per, k) AS per FROM (SELECT want, held, row_number() OVER w AS k,
  ({share} * all_t - coalesce(sum({WHOLE} * held) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(want) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS per
  FROM want_{n} WINDOW w AS (ORDER BY held / want, {n})) WHERE per * want <= {WHOLE} * held)""",
                 f"""goal_{n} AS MATERIALIZED (SELECT {n}, least(per * want, {WHOLE} * held) AS goal
  FROM want_{n}, per_{n})"""]
    ctes += [f"f_{n}0 AS MATERIALIZED (SELECT {n}, 1.0::DOUBLE AS f FROM goal_{n})" for n in ("lang", "topic")]
    for i in range(rounds + 1):
        ctes += [f"""r{i} AS MATERIALIZED (SELECT l.*, a.f * b.f AS r, g.goal FROM live l JOIN f_lang{i} a USING (lang)
  JOIN f_topic{i} b USING (topic) JOIN goal_source g USING (source))""",
                 f"""c{i} AS MATERIALIZED (SELECT source, arg_min(c, n) AS c FROM (
  SELECT source, r, row_number() OVER w AS n, (goal - coalesce(sum(tokens) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING
    AND 1 PRECEDING), 0)) / sum(tokens * r) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS c
  FROM r{i} WINDOW w AS (PARTITION BY source ORDER BY r DESC, lang, topic)) WHERE c * r <= 1 GROUP BY source)""",
                 f"p{i} AS MATERIALIZED (SELECT r{i}.*, least(1.0, c * r) AS p FROM r{i} JOIN c{i} USING (source))"]
        if i == rounds:
            break
        ctes += [f"""g{i} AS MATERIALIZED (SELECT lang, topic, sum(CASE WHEN p >= 1 THEN tokens ELSE 0 END) AS whole,
  sum(CASE WHEN p >= 1 THEN 0 ELSE tokens * p END) AS part FROM p{i} GROUP BY ALL)""",
                 f"""s{i} AS MATERIALIZED (SELECT lang, CASE WHEN sum(part) > 0 THEN greatest((any_value(goal) - sum(whole))
  / sum(part), {LEAST_STEP}) ELSE 1 END AS step FROM g{i} JOIN goal_lang USING (lang) GROUP BY lang)""",
                 f"""u{i} AS MATERIALIZED (SELECT topic, CASE WHEN sum(part * step) > 0 THEN greatest((any_value(goal)
  - sum(whole)) / sum(part * step), {LEAST_STEP}) ELSE 1 END AS step FROM g{i} JOIN s{i} USING (lang)
  JOIN goal_topic USING (topic) GROUP BY topic)""",
                 f"f_lang{i + 1} AS MATERIALIZED (SELECT lang, f * step AS f FROM f_lang{i} JOIN s{i} USING (lang))",
                 f"f_topic{i + 1} AS MATERIALIZED (SELECT topic, f * step AS f FROM f_topic{i} JOIN u{i} USING (topic))"]
    return "WITH " + ",\n".join(ctes) + f""",
named AS (SELECT d.*, round(coalesce(p, {share}), 6) AS p FROM docs d
  LEFT JOIN p{rounds} q ON (q.source, q.lang, q.topic) = (d.source, d.lang, d.topic))
SELECT doc_id, source, lang, topic, n_tokens, p FROM named
WHERE ('0x' || substr(md5('{seed}:' || coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT / {16 ** 12}.0 < p"""
