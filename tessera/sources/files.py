"""File sources and sinks: NDJSON ingest (S6), JSON documents (S7),
table sink (S8) and optional-column probe (S9)."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import scratch_path


def ingest_ndjson(spark: SparkSession, path: str, view: str | None = None,
                  schema: T.StructType | str | None = None) -> DataFrame:
    """Newline-delimited JSON (one object per line) as a table.

    NDJSON is splittable, so this scales with the file size.  Pass ``schema``
    in production: inference costs an extra pass over the data.
    ``view`` (re)registers the result under that name (replace-if-exists).
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.json(path)
    if view:
        df.createOrReplaceTempView(view)
    return df


def unwrap_envelope(df: DataFrame, field: str = "data") -> DataFrame:
    """Unwrap ``{"meta": …, "data": …}`` documents.

    * ``data`` is an array of structs -> one row per element (exploded);
    * ``data`` is an array of scalars -> one ``value`` column;
    * ``data`` is a struct            -> its fields become columns;
    * no ``data`` field (a bare array was read) -> rows as they are.
    """
    if field not in df.columns:
        return df
    dt = df.schema[field].dataType
    if isinstance(dt, T.ArrayType):
        exploded = df.select(F.explode(F.col(field)).alias("_e"))
        if isinstance(dt.elementType, T.StructType):
            return exploded.select("_e.*")
        return exploded.select(F.col("_e").alias("value"))
    if isinstance(dt, T.StructType):
        return df.select(f"{field}.*")
    return df.select(F.col(field))


def read_json_documents(spark: SparkSession, path: str, schema=None,
                        multi_line: bool = True, envelope: str | None = "data") -> DataFrame:
    """Whole-file JSON documents (``.gz`` is read transparently).

    A whole-file document is not splittable: each file is one task.  That is
    right for the small vocabulary documents; large collections should be
    stored as NDJSON (``multi_line=False``), one document per line, so that
    the read splits.

    With a ``schema`` whose ``envelope`` field is an array of structs, a bare
    array of such elements reads to the same rows as an enveloped one.  (An
    element without any known field looks like an empty envelope: no row.)
    """
    reader = spark.read.option("multiLine", multi_line)
    if schema is None:
        df = reader.json(path)
        return unwrap_envelope(df, envelope) if envelope else df
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    wrapped = schema[envelope].dataType if envelope in schema.names else None
    if not (isinstance(wrapped, T.ArrayType) and isinstance(wrapped.elementType, T.StructType)):
        df = reader.schema(schema).json(path)
        return unwrap_envelope(df, envelope) if envelope else df
    element = wrapped.elementType
    read = T.StructType([schema[envelope]] + [f for f in element.fields if f.name != envelope])
    df = reader.schema(read).json(path)
    bare = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) if f.name == envelope else
                      F.col(f"`{f.name}`") for f in element.fields])
    known = F.lit(False)
    for c in read.names[1:]:
        known = known | F.col(f"`{c}`").isNotNull()
    rows = F.when(F.col(envelope).isNotNull(), F.col(envelope)).when(known, F.array(bare))
    return df.select(F.explode(rows).alias("_e")).select("_e.*")


def _collected(df: DataFrame) -> Column:
    """The rows of a group as an array of structs, sorted by their JSON text so
    that a re-run writes the same document."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    both = F.array_sort(F.collect_list(F.struct(F.to_json(row).alias("j"), row.alias("r")))) \
        if all(_orderable(f.dataType) for f in df.schema.fields) else \
        F.collect_list(F.struct(F.to_json(row).alias("j"), row.alias("r")))
    return F.transform(both, lambda x: x["r"])


def _orderable(t: T.DataType) -> bool:
    if isinstance(t, T.StructType):
        return all(_orderable(f.dataType) for f in t.fields)
    if isinstance(t, T.ArrayType):
        return _orderable(t.elementType)
    return not isinstance(t, (T.MapType, T.VariantType))


def write_json_documents(df: DataFrame, path: str, doc_key: Column,
                         meta: dict | None = None, field: str = "data") -> str:
    """Write ``df`` as envelope documents ``{"meta":…, "data":[…]}``, one per
    distinct ``doc_key`` value, one document per line.

    ``doc_key`` decides the document size; pick a key with bounded groups.
    """
    meta = meta or {}
    meta_col = F.struct(*[F.lit(v).alias(k) for k, v in meta.items()]) if meta else F.lit(None)
    docs = (df.groupBy(doc_key.alias("_doc"))
            .agg(_collected(df).alias(field))
            .select(meta_col.alias("meta"), F.col(field)))
    docs.write.mode("overwrite").json(path)
    return path


def write_table(df: DataFrame, path: str | None = None, table: str | None = None,
                mode: str = "overwrite", fmt: str = "parquet", partition_by=None,
                bucket_by: tuple[int, list[str]] | None = None) -> None:
    """Materialise a result (CREATE TABLE AS SELECT).

    ``partition_by`` enables partition pruning on later reads (e.g. price
    history by month); ``bucket_by=(n, cols)`` (tables only) co-locates later
    joins on those columns without a shuffle.
    """
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if table:
        if bucket_by:
            n, cols = bucket_by
            w = w.bucketBy(n, *cols).sortBy(*cols)
        w.saveAsTable(table)
    elif path:
        w.save(path)
    else:
        raise ValueError("give a path or a table name")


def bucketed(df: DataFrame, key, buckets: int, path: str | None = None, table: str | None = None) -> DataFrame:
    """``df`` written in ``buckets`` files by the hash of ``key``, each sorted by
    it, and read back: tables with equal numbers of buckets join, group and rank
    by ``key`` without a shuffle, as often as they are read.

    Rows are dealt by key before the write, so a bucket is one file.  Without a
    ``table`` name the files lie in the scratch folder (or ``path``) and the
    catalog entry that Spark needs to know the buckets is dropped again.
    """
    spark, keys = df.sparkSession, [key] if isinstance(key, str) else list(key)
    name = table or f"tessera_bucketed_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, *keys)
    w = dealt.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).format("parquet")
    w.option("path", path or scratch_path(spark, "bucketed")).saveAsTable(name)
    out = spark.table(name)
    out.schema                                   # resolved before its name goes
    if table is None:
        spark.sql(f"DROP TABLE {name}")          # an external table: the files stay
    return out


def optional_column(df: DataFrame, column: str, schema: T.StructType | str | None = None,
                    select=None) -> DataFrame:
    """``select`` applied when ``column`` exists, else an empty relation with
    the declared ``schema`` (decided from the schema alone, no job)."""
    if column in df.columns:
        return select(df) if select else df
    spark = df.sparkSession
    if schema is None:
        schema = T.StructType([T.StructField(column, T.StringType(), True)])
    return spark.createDataFrame([], schema)
