"""A corpus pipeline over ``documents``: quality ranking, line rules, near
duplicates, mixing and packing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept
and is written as Parquet in the shared scratch folder, where the next one
reads it.  All but the last return the rows they keep with the columns they
were given, whatever these are; the last returns packed pieces.  Rows are never
matched by position, and a document is its id and text together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bradley_terry, kk_pack, line_crf, mixing, simhash
from tessera.llm.common import filter_texts, fold, read_table
from tessera.session import scratch_path


def quality_ranking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose Bradley-Terry score reaches the threshold."""
    model = bradley_terry.fit(docs, read_table(spark, sf_dir, "labels"), learn=fold("__id", 5) != 0)
    return filter_texts(docs, "text", lambda texts: model.scores(texts) >= model.cut)


def line_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are content for the most part."""
    model = line_crf.fit(docs)
    return filter_texts(docs, "text", lambda texts: line_crf.judge(texts, model)["kept"])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints: that of the smallest
    id (null ids last), among several of that id the one of the smallest text
    hash, and one row of those repeated with id and text."""
    # An id may come with several texts, so a document is its id and text.
    named = F.coalesce(F.concat(F.lit("="), F.col("doc_id").cast("string")), F.lit("-"))
    text = F.coalesce(F.concat(F.lit("="), F.col("text")), F.lit("-"))
    key = F.sha2(F.concat_ws("|", named, text), 256)
    rows = docs.select("doc_id", "text", key.alias("key"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key")).alias("first")
    stays = (simhash.grouped(rows, carry=("key",)).groupBy("root").agg(first)
             .select(F.col("first.key").alias("key")))
    once = docs.select(key.alias("key"), F.struct(*docs.columns).alias("row")).dropDuplicates(["key"])
    return once.join(stays, "key").select("row.*")


def mixing_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample by probabilities raked to source, language and topic targets."""
    return mixing.sample(docs, mixing.weights(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 ids."""
    pieces = kk_pack.pack(docs)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [("quality_ranking", quality_ranking), ("line_rules", line_rules),
          ("near_duplicates", near_duplicates), ("mixing_weights", mixing_weights),
          ("packing", packing)]

#: Learned models, fingerprints and a tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
