"""Nested data (N1-N3): explode tagged children, filter documents, explode
vocabulary maps.  All are per-row generators (no shuffle)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.predicates import all_of, ascii_ci_eq, literal_contains_ci


def explode_tagged(df: DataFrame, array_col: str, tags: dict[str, str] | list[str],
                   element_schema: T.DataType | str | None = None,
                   position: str | None = None, require_present: bool = True) -> DataFrame:   # N1
    """One row per element of ``array_col`` (array of structs, or JSON text of
    one when ``element_schema`` is given), with the parent's ``tags`` columns
    (``{source: alias}`` or names).  NULL and empty arrays yield no rows; a
    missing column yields an empty relation with the fields of
    ``element_schema`` (none if it is not given) and the tags."""
    tag_map = tags if isinstance(tags, dict) else {t: t for t in tags}
    if array_col not in df.columns:
        if require_present:
            raise ValueError(f"column {array_col!r} not present")
        et = T._parse_datatype_string(element_schema) if isinstance(element_schema, str) else element_schema
        inner = [] if et is None else et.fields if isinstance(et, T.StructType) else [T.StructField("value", et)]
        lead = [T.StructField(position, T.IntegerType())] if position else []
        tag_fields = [T.StructField(a, df.schema[s].dataType) for s, a in tag_map.items()]
        return df.sparkSession.createDataFrame([], T.StructType([*lead, *inner, *tag_fields]))
    arr = F.col(array_col)
    if element_schema is not None:
        et = element_schema if isinstance(element_schema, T.DataType) else T._parse_datatype_string(element_schema)
        arr = F.from_json(arr, T.ArrayType(et))
    tag_cols = [F.col(s).alias(a) for s, a in tag_map.items()]
    if position:
        ex = df.select(F.posexplode(arr).alias(position, "_e"), *tag_cols)
    else:
        ex = df.select(F.explode(arr).alias("_e"), *tag_cols)
    et = ex.schema["_e"].dataType
    inner = [F.col("_e.*")] if isinstance(et, T.StructType) else [F.col("_e").alias("value")]
    lead = [F.col(position)] if position else []
    return ex.select(*lead, *inner, *[F.col(a) for a in tag_map.values()])


def filter_documents(df: DataFrame, equals_ci: dict | None = None,
                     contains: dict | None = None) -> DataFrame:        # N2
    """Document list filter: ASCII case-insensitive equality per field (a
    missing field never matches) and Unicode case-insensitive literal
    substring per field."""
    conds = []
    for k, v in (equals_ci or {}).items():
        conds.append(ascii_ci_eq(k, v) if k in df.columns else F.lit(False))
    for k, v in (contains or {}).items():
        conds.append(literal_contains_ci(k, v) if k in df.columns else F.lit(False))
    c = all_of(conds)
    return df if c is None else df.where(c)


def explode_vocabulary(df: DataFrame, map_col: str = "data", key: str = "category",
                       value: str = "value") -> DataFrame:               # N3
    """``map<string, array<string>>`` (or a struct of arrays) -> ``(key, value)`` rows."""
    dt = df.schema[map_col].dataType
    if isinstance(dt, T.StructType):
        m = F.map_from_arrays(F.array(*[F.lit(f.name) for f in dt.fields]),
                              F.array(*[F.col(f"{map_col}.`{f.name}`") for f in dt.fields]))
    else:
        m = F.col(map_col)
    pairs = df.select(F.explode(m).alias(key, "_vals"))
    vt = pairs.schema["_vals"].dataType
    if isinstance(vt, T.ArrayType):
        return pairs.select(key, F.explode("_vals").alias(value))
    return pairs.select(key, F.col("_vals").alias(value))


def explode_type_vocabulary(df: DataFrame, map_col: str = "data") -> DataFrame:
    """Card-type documents ``{type: {subTypes: [...], superTypes: [...]}}`` ->
    ``(type, kind, value)`` rows."""
    dt = df.schema[map_col].dataType
    if isinstance(dt, T.StructType):
        m = F.map_from_arrays(F.array(*[F.lit(f.name) for f in dt.fields]),
                              F.array(*[F.to_json(F.col(f"{map_col}.`{f.name}`")) for f in dt.fields]))
        kinds = df.select(F.explode(m).alias("type", "_j")).select(
            "type", F.from_json("_j", "map<string,array<string>>").alias("_k"))
    else:
        kinds = df.select(F.explode(map_col).alias("type", "_k"))
        if isinstance(kinds.schema["_k"].dataType, T.StructType):
            kinds = kinds.select("type", F.from_json(F.to_json("_k"), "map<string,array<string>>").alias("_k"))
    return (kinds.select("type", F.explode("_k").alias("kind", "_v"))
            .select("type", "kind", F.explode("_v").alias("value")))
