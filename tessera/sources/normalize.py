"""Schema-driven normalisers (S3 text lists, S4 JSON text, S5 wide->long).

All three read only ``df.schema`` on the driver and emit a single projection,
so they add no job and no shuffle; Catalyst still prunes unused columns and
pushes scalar filters below them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# List-valued text columns whose names do not end in "s".
STATIC_LIST_COLUMNS = {
    "cards": {
        "artistIds", "attractionLights", "availability", "boosterTypes", "cardParts",
        "colorIdentity", "colorIndicator", "colors", "finishes", "frameEffects",
        "keywords", "originalPrintings", "otherFaceIds", "printings", "producedMana",
        "promoTypes", "rebalancedPrintings", "subsets", "subtypes", "supertypes",
        "types", "variations",
    },
    "tokens": {
        "artistIds", "availability", "boosterTypes", "colorIdentity", "colorIndicator",
        "colors", "finishes", "frameEffects", "keywords", "otherFaceIds", "producedMana",
        "promoTypes", "reverseRelated", "subtypes", "supertypes", "types",
    },
}

# Text columns that are never split even though they end in "s".
NEVER_SPLIT_COLUMNS = {
    "text", "originalText", "flavorText", "printedText", "identifiers", "legalities",
    "leadershipSkills", "purchaseUrls", "relatedCards", "rulings", "sourceProducts",
    "foreignData", "translations", "toughness", "status", "format", "uris", "scryfallUri",
}

# Text columns holding JSON documents.
JSON_TEXT_COLUMNS = {
    "identifiers", "legalities", "leadershipSkills", "purchaseUrls", "relatedCards",
    "rulings", "sourceProducts", "foreignData", "translations",
}

# Fixed value: the only separator that splits a list stored as text.
LIST_SEPARATOR = ", "


def _string_cols(df: DataFrame) -> set[str]:
    return {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}


def csv_columns(df: DataFrame, table: str | None = None, extra=(), ignore=()) -> list[str]:
    """Columns S3 converts: static list ∪ plural-named text columns, minus the
    blocklist, kept only when present as strings."""
    strings = _string_cols(df)
    blocked = NEVER_SPLIT_COLUMNS | set(ignore)
    cands = set(STATIC_LIST_COLUMNS.get(table or "", set())) | set(extra)
    cands |= {c for c in strings if c.endswith("s") and c not in blocked}
    return sorted(c for c in cands if c in strings)


def split_list(c: Column, sep: str = LIST_SEPARATOR) -> Column:
    """NULL or blank -> empty array, else split on the exact separator."""
    import re
    return (F.when(c.isNull() | (F.trim(c) == ""), F.array().cast("array<string>"))
            .otherwise(F.split(c, re.escape(sep))))


def csv_to_array(df: DataFrame, table: str | None = None, columns=None,
                 extra=(), ignore=()) -> DataFrame:
    """S3: text lists (``"a, b"``) to ``array<string>`` in one projection."""
    cols = set(columns if columns is not None else csv_columns(df, table, extra, ignore))
    if not cols:
        return df
    return df.select(*[split_list(F.col(f"`{c}`")).alias(c) if c in cols else F.col(f"`{c}`")
                       for c in df.columns])


def json_to_variant(df: DataFrame, columns=None) -> DataFrame:
    """JSON text to VARIANT; malformed text becomes NULL (not an error)."""
    strings = _string_cols(df)
    cols = set(columns if columns is not None else JSON_TEXT_COLUMNS) & strings
    if not cols:
        return df
    return df.select(*[F.try_parse_json(F.col(f"`{c}`")).alias(c) if c in cols else F.col(f"`{c}`")
                       for c in df.columns])


def _ddl(variant_type: str) -> str:
    """The DDL of a type as ``schema_of_variant`` spells it."""
    return variant_type.replace("OBJECT<", "STRUCT<").replace("VOID", "STRING")


def shred_json(df: DataFrame, column: str, prefix: str = "") -> DataFrame:
    """S4 in bulk: a typed column per top-level field of the JSON text in
    ``column`` (NULL where a row hasn't it, or its text is malformed).

    One pass finds the fields and the type that holds all values of each
    (``schema_of_variant_agg``, a partial aggregate of one row); a second reads
    them all from the text parsed once.  Fields of values too different for one
    type come as JSON text; text that is no object gives no columns.
    """
    parsed = F.try_parse_json(F.col(f"`{column}`"))
    found = df.agg(F.schema_of_variant_agg(parsed)).first()[0] or "VOID"
    rest = [F.col(f"`{c}`") for c in df.columns if c != column]
    if not found.startswith("OBJECT<"):
        return df.select(*rest)
    typed = df.select(*rest, parsed.alias("_json"))

    def field(name: str, kind: T.DataType):
        path = "$[" + "'" + name.replace("'", "\\'") + "']"
        if isinstance(kind, T.VariantType):
            return F.to_json(F.variant_get("_json", path, "variant")).alias(prefix + name)
        return F.try_variant_get("_json", path, kind.simpleString()).alias(prefix + name)

    fields = T.DataType.fromDDL(_ddl(found)).fields
    return typed.select(*rest, *[field(f.name, f.dataType) for f in fields])


def unpivot_status(df: DataFrame, id_col: str = "uuid", name_col: str = "format",
                   value_col: str = "status") -> DataFrame:
    """Wide status table -> long ``(id, name, value)`` without NULL values.

    An already-long table (it has ``id, name, value``) and a table with only the
    id column pass through unchanged.
    """
    cols = df.columns
    if {id_col, name_col, value_col} <= set(cols):
        return df.select(id_col, name_col, value_col)
    others = [c for c in cols if c != id_col]
    if not others:
        return df
    wide = df.select(id_col, *[F.col(f"`{c}`").cast("string").alias(c) for c in others])
    return (wide.unpivot([id_col], others, name_col, value_col)
            .where(F.col(value_col).isNotNull()))


def normalize_table(df: DataFrame, name: str, extra=(), ignore=()) -> DataFrame:
    """The per-dataset normalisation applied when a view is registered.
    ``extra``/``ignore`` adjust the text-list heuristic for this table."""
    if name == "card_legalities":
        return unpivot_status(df)
    return json_to_variant(csv_to_array(df, name, extra=extra, ignore=ignore))
