"""Parameterised SQL (S11) and scalar results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def sql(spark: SparkSession, query: str, params=None) -> DataFrame:
    """Run SQL over registered views with bound values.

    ``params`` is a list (``?`` markers) or a dict (``:name`` markers); values
    are bound as typed literals, never spliced into the text.
    """
    if params:
        return spark.sql(query, args=params)
    return spark.sql(query)


def scalar(df: DataFrame) -> DataFrame:
    """The first column of (at most) the first row, as a DataFrame.

    Call ``.first()`` on the result at the API edge; an empty input gives an
    empty DataFrame (no value)."""
    return df.select(F.col(f"`{df.columns[0]}`")).limit(1)


def scalar_value(df: DataFrame):
    """API-edge convenience: the scalar itself, or None."""
    row = scalar(df).first()
    return None if row is None else row[0]
