"""Deterministic, partitioning-independent pseudo-random numbers.

``hash_uniform(seed, key)`` maps a seed and a key to a double in (0, 1) from
the first 52 bits of md5(seed || '|' || key).  It depends only on the row's
key, never on partitioning or task order, so a re-run after an executor loss
draws exactly the same sample, and the same formula in SQL reproduces it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_TWO_52 = float(2 ** 52)


def _part(k) -> Column:
    """One part of a composite key: `|` and `\\` escaped, NULL spelled out, so
    that different keys never read alike."""
    s = (k if isinstance(k, Column) else F.col(k)).cast("string")
    for c in ("\\", "|"):
        s = F.replace(s, F.lit(c), F.lit("\\" + c))
    return F.coalesce(s, F.lit("\\N"))


def composite_key(key) -> Column:
    """One string for the values of several columns, never NULL."""
    return F.concat_ws("|", *[_part(k) for k in key])


def _key(key) -> Column:
    if isinstance(key, (list, tuple)):
        return composite_key(key)
    return (key if isinstance(key, Column) else F.col(key)).cast("string")


def hash_bits(seed: str, key) -> Column:
    """The 52-bit integer behind ``hash_uniform`` (bigint)."""
    h = F.md5(F.concat(F.lit(f"{seed}|"), _key(key)))
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("bigint")


def hash_uniform(seed: str, key) -> Column:
    """u in (0, 1): (bits + 0.5) / 2^52."""
    return (hash_bits(seed, key).cast("double") + F.lit(0.5)) / F.lit(_TWO_52)


def hash_bucket(seed: str, key, n: int) -> Column:
    """Deterministic bucket in [0, n) (bigint)."""
    return F.floor(hash_uniform(seed, key) * F.lit(float(n))).cast("bigint")
