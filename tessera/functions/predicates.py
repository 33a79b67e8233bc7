"""Predicate vocabulary (P1-P23) as Spark Column builders.

Every value enters the plan as a typed literal (``F.lit``), never as SQL text,
so a user value cannot change the shape of the query.  All predicates are
built-in expressions: they stay inside whole-stage codegen, and the scalar
ones (equality, ranges, IN, IS NOT NULL, date ranges) push down to the
parquet scan.
"""

from __future__ import annotations

import datetime as _dt
import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

__all__ = [
    "col", "eq", "gte", "lte", "between", "isin", "like_ci", "exact_or_like",
    "contains_ci", "literal_contains_ci", "regex", "any_of", "all_of",
    "contains_all", "not_null", "year_eq", "date_range", "bool_eq", "ascii_ci_eq",
    "upper_key", "filter_map", "validate_column", "apply_filters", "semi_filter",
]


def col(c) -> Column:
    """A Column from a name (dotted names address struct fields) or a Column."""
    return c if isinstance(c, Column) else F.col(c)


def eq(c, v) -> Column:                       # P4
    return col(c) == F.lit(v)


def gte(c, v) -> Column:                      # P5
    return col(c) >= F.lit(v)


def lte(c, v) -> Column:                      # P5
    return col(c) <= F.lit(v)


def between(c, lo=None, hi=None) -> Column | None:   # P5 / P16 (either side optional)
    conds = []
    if lo is not None:
        conds.append(gte(c, lo))
    if hi is not None:
        conds.append(lte(c, hi))
    return all_of(conds)


def isin(c, values) -> Column:                # P6: empty list -> FALSE
    values = list(values)
    if not values:
        return F.lit(False)
    return col(c).isin(values)


def semi_filter(df: DataFrame, c: str, keys: DataFrame, key_col: str | None = None) -> DataFrame:
    """P6 for a large key set: a left-semi join instead of a literal IN list.

    The planner broadcasts ``keys`` only when its measured size is under the
    broadcast threshold; otherwise it is a shuffled semi join.
    """
    k = key_col or keys.columns[0]
    return df.join(keys.select(F.col(k).alias("_k")).distinct(), col(c) == F.col("_k"),
                   "left_semi")


def _escape_char(pattern: str) -> str:
    for ch in "\\!#~^|@\u0001\u0002":
        if ch not in pattern:
            return ch
    raise ValueError("no escape character available for pattern")


def like_ci(c, pattern: str) -> Column:       # P7
    """Case-insensitive LIKE; ``%`` and ``_`` in the pattern stay wildcards and
    every other character (including ``\\``) is literal."""
    esc = _escape_char(pattern)
    return F.like(F.lower(col(c)), F.lower(F.lit(pattern)), F.lit(esc))


def exact_or_like(c, v: str) -> Column:       # P8
    return like_ci(c, v) if "%" in v else eq(c, v)


def contains_ci(c, v: str) -> Column:         # P9 (user wildcards kept)
    return like_ci(c, f"%{v}%")


def literal_contains_ci(c, v: str) -> Column:  # P20 (no wildcards)
    return F.contains(F.lower(col(c)), F.lit(v.lower()))


def regex(c, pattern: str) -> Column:         # P10 unanchored, case-sensitive
    return col(c).rlike(pattern)


def any_of(conds) -> Column | None:           # P12: empty -> no filter (None)
    conds = [x for x in conds if x is not None]
    return functools.reduce(operator.or_, conds) if conds else None


def all_of(conds) -> Column | None:           # P3: conjunction; empty -> None
    conds = [x for x in conds if x is not None]
    return functools.reduce(operator.and_, conds) if conds else None


def contains_all(c, values) -> Column | None:  # P13
    if isinstance(values, str):
        values = [values]
    return all_of([F.array_contains(col(c), F.lit(v)) for v in values])


def not_null(c) -> Column:                    # P14
    return col(c).isNotNull()


def year_eq(c, year: int) -> Column:          # P15 as a pushable range
    lo = _dt.date(int(year), 1, 1)
    hi = _dt.date(int(year) + 1, 1, 1)
    return (col(c) >= F.lit(lo)) & (col(c) < F.lit(hi))


def date_range(c, date_from=None, date_to=None) -> Column | None:   # P16
    return between(c, _as_date(date_from), _as_date(date_to))


def _as_date(v):
    if v is None or isinstance(v, (_dt.date, _dt.datetime)):
        return v
    return _dt.date.fromisoformat(str(v))


def bool_eq(c, v: bool) -> Column:            # P17 (NULL never matches)
    return col(c) == F.lit(bool(v))


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = "abcdefghijklmnopqrstuvwxyz"


def ascii_ci_eq(c, v: str) -> Column:         # P19: only A-Z fold
    fold = v.translate(str.maketrans(_UPPER, _LOWER))
    return F.translate(col(c), _UPPER, _LOWER) == F.lit(fold)


def upper_key(v: str) -> str:                 # P21: normalise the literal, not the column
    return v.upper()


def validate_column(name: str, allowed) -> str:   # P23
    if name not in set(allowed):
        raise ValueError(f"invalid column {name!r}; expected one of {sorted(allowed)}")
    return name


def filter_map(df: DataFrame, filters: dict | None) -> Column | None:   # P22
    """AND of ``column == value`` over a dict; names are checked first."""
    conds = []
    for k, v in (filters or {}).items():
        validate_column(k, df.columns)
        conds.append(eq(k, v))
    return all_of(conds)


def apply_filters(df: DataFrame, *conds) -> DataFrame:
    """``df.where`` of the conjunction of the non-None conditions."""
    c = all_of(conds)
    return df if c is None else df.where(c)

