"""Joins (J1-J8).  All are equi-joins; the physical strategy is left to
Catalyst + AQE, which broadcast a side only after measuring it under
``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffle-join (with AQE
splitting skewed partitions).  We never hint a broadcast for a side whose
size grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.predicates import contains_ci, validate_column


#: Rows of the larger table that a task sorts for a join dealt by ``by``.
TASK_ROWS = 2_000_000


def join(df: DataFrame, other: DataFrame, on, how: str = "inner",
         by: tuple[str, str] | None = None, task_rows: int = TASK_ROWS) -> DataFrame:   # J1
    """Any condition, any kind.

    ``by`` names a column of either table that the condition holds equal: where
    the session's shuffle partitions are too few for ``task_rows`` rows each,
    both tables are dealt by it over more, so that what a task sorts does not
    grow with the tables (two counts, answered by Parquet's footers)."""
    if by is not None:
        tasks = -(-max(df.count(), other.count()) // task_rows)
        if tasks > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
            df, other = df.repartition(tasks, by[0]), other.repartition(tasks, by[1])
    return df.join(other, on, how)


def _left_cols(df: DataFrame, alias: str) -> list[Column]:
    return [F.col(f"{alias}.`{c}`") for c in df.columns]


def join_by_identifier(fact: DataFrame, ids: DataFrame, id_column: str, value,
                       key: str = "uuid", allowed=None) -> DataFrame:          # J2
    """Fact rows whose identifier ``id_column`` equals ``value``.

    The identifier table is filtered first (pushed to its scan), then
    semi-joined, so only the fact's own columns come back.
    """
    validate_column(id_column, allowed if allowed is not None else ids.columns)
    hits = ids.where(F.col(id_column) == F.lit(value)).select(key)
    return fact.join(hits, key, "left_semi")


def identifiers_long(ids: DataFrame, key: str = "uuid", columns=None,
                     type_col: str = "id_type", value_col: str = "id_value") -> DataFrame:
    """J2 bulk form: ``(key, id_type, id_value)`` rows without NULL ids."""
    cols = [c for c in (columns or ids.columns) if c != key]
    wide = ids.select(key, *[F.col(c).cast("string").alias(c) for c in cols])
    return wide.unpivot([key], cols, type_col, value_col).where(F.col(value_col).isNotNull())


def resolve_identifiers(fact: DataFrame, ids: DataFrame, lookups: DataFrame,
                        key: str = "uuid", columns=None) -> DataFrame:
    """Resolve a whole table of ``(id_type, id_value)`` lookups to fact rows."""
    long = identifiers_long(ids, key, columns)
    matched = long.join(lookups, ["id_type", "id_value"], "inner")
    return matched.join(fact, key, "inner")


def join_status(fact: DataFrame, status: DataFrame, name: str, value: str,
                key: str = "uuid", name_col: str = "format",
                value_col: str = "status") -> DataFrame:                   # J3
    """Fact rows with status ``value`` under ``name`` (e.g. Legal in modern)."""
    hits = status.where((F.col(name_col) == F.lit(name)) & (F.col(value_col) == F.lit(value)))
    return fact.join(hits.select(key), key, "left_semi")


def join_translations(fact: DataFrame, foreign: DataFrame, pattern: str,
                      key: str = "uuid", name_col: str = "name",
                      dedupe: bool = False) -> DataFrame:                  # J4
    """Fact rows with a translation whose name contains ``pattern``
    (case-insensitive, wildcards kept).  Default: one row per matching
    translation (rows multiply); ``dedupe`` -> one per fact row.
    Only the fact's columns are returned; the matched name is ``foreign_name``.
    """
    hits = foreign.where(contains_ci(name_col, pattern)).select(
        F.col(key).alias("_fk"), F.col(name_col).alias("foreign_name"))
    if dedupe:
        return fact.join(hits, F.col(key) == F.col("_fk"), "left_semi")
    f = fact.alias("f")
    return (f.join(hits, F.col(f"f.{key}") == F.col("_fk"), "inner")
            .select(*_left_cols(fact, "f"), "foreign_name"))


def join_dimension(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                   dim_filter: Column | None = None, keep=(), prefix: str = "") -> DataFrame:   # J5
    """Fact ⋈ dimension on ``fact_key = dim_key`` with an optional filter on the
    dimension; ``keep`` dimension columns are added under ``prefix``.

    Dimensions (sets, formats, ...) are small: the planner broadcasts them
    after measuring them, so a hot fact key never meets in one task.  A
    dimension too large to broadcast falls back to a sort-merge join."""
    d = dim if dim_filter is None else dim.where(dim_filter)
    d = d.select(F.col(dim_key).alias("_dk"), *[F.col(c).alias(prefix + c) for c in keep])
    out = fact.join(d, F.col(fact_key) == F.col("_dk"), "inner").drop("_dk")
    return out


def join_prices(cards: DataFrame, prices: DataFrame, key: str = "uuid",
                price_cols=("price", "source", "provider", "finish", "date")) -> DataFrame:   # J6
    """Card ⋈ price rows (1:N); price columns keep their names."""
    p = prices.select(F.col(key).alias("_pk"), *[F.col(c) for c in price_cols])
    return cards.join(p, F.col(key) == F.col("_pk"), "inner").drop("_pk")


def latest_rows(df: DataFrame, key, date: str, per=None) -> DataFrame:     # J7
    """Rows at the latest ``date`` of their ``key`` (optionally per ``per``).

    One scan and one shuffle: ``rank() = 1`` plans a WindowGroupLimit on both
    sides of the exchange, so a task ships only the rows at the latest date it
    has seen of a key, however many the key has.  Rows without a date are no
    one's latest.
    """
    keys = ([key] if isinstance(key, str) else list(key)) + list(per or [])
    newest_first = Window.partitionBy(*keys).orderBy(F.col(date).desc())
    return (df.where(F.col(date).isNotNull()).withColumn("_latest", F.rank().over(newest_first))
            .where("_latest = 1").drop("_latest"))


def ordered_fetch(requests: DataFrame, fact: DataFrame, key: str, *,
                  request_col: str | None = None, keys_col: str | None = None,
                  pos_col: str = "pos", fact_key: str | None = None) -> DataFrame:   # J8
    """Fetch fact rows for ordered key lists, keeping order and duplicates and
    dropping misses.

    ``requests`` is either long ``(request_col, pos_col, key)`` rows, or has an
    array column ``keys_col`` that is pos-exploded here.  The result carries
    ``request_col`` and ``pos_col``; order by them to read a request's rows in
    request order.
    """
    fk = fact_key or key
    if keys_col is not None:
        sel = [F.col(request_col)] if request_col else []
        requests = requests.select(*sel, F.posexplode(keys_col).alias(pos_col, key))
    # Many requests may ask for the same key (a popular card): the fact is
    # first narrowed to the requested keys (its only shuffle), and just those
    # rows are replicated against the salted requests.
    from tessera.operators.sampling import salted_join
    salt_by = ([request_col] if request_col else []) + [pos_col]
    fact_cols = [c for c in fact.columns if c != fk]
    f = fact.select(F.col(f"`{fk}`").alias("_fk"), *[F.col(f"`{c}`").alias(f"_f_{c}") for c in fact_cols])
    r = requests.withColumnRenamed(key, "_fk")
    f = f.join(r.select("_fk").distinct(), "_fk", "left_semi")
    out = salted_join(r, f, ["_fk"], salt_by)
    front = ([F.col(f"`{request_col}`")] if request_col else []) + [F.col(f"`{pos_col}`")]
    return out.select(*front, *[F.col("_fk").alias(fk) if c == fk else F.col(f"`_f_{c}`").alias(c)
                                for c in fact.columns])
