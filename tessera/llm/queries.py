"""The registered queries of this package, and their DuckDB SQL where SQL can
express them.  Each applies one operator with production parameters to its
whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (bfd_pack, bradley_terry, chat_repair, collocations, divergence, kk_pack, kneser_ney,
                         license_scan, line_crf, mixing, simhash, string_kernel, vamana)
from tessera.llm.common import fold, read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op1_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_repair.repair(read_table(spark, sf_dir, "conversations"))


@_query
def op2_mixing_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    drawn = mixing.draw(docs, mixing.weights(docs))
    return drawn.select("row.doc_id", "source", "lang", "topic",
                        mixing.tokens("row.text").alias("n_tokens"), "p")


ORACLE_SQL["op2_mixing_weights"] = mixing.oracle_sql()


@_query
def op3_robust_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vamana.search(read_table(spark, sf_dir, "embeddings"))


@_query
def op5_packed_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bfd_pack.pack_matrices(read_table(spark, sf_dir, "documents"))


@_query
def op10_kk_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = kk_pack.pack(read_table(spark, sf_dir, "documents"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@_query
def op4_simhash_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


@_query
def op6_bradley_terry_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = bradley_terry.fit(docs, read_table(spark, sf_dir, "labels"),
                              learn=fold("__id", 5) != 0)
    return bradley_terry.score(docs, model)


@_query
def op8_string_kernel_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return string_kernel.identify(docs, string_kernel.fit(docs, learn=fold("__id", 3) != 1))


@_query
def op7_kneser_ney_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = kneser_ney.fit(docs, read_table(spark, sf_dir, "labels"),
                           learn=fold("__id", 5) != 0)
    return kneser_ney.score(docs, model)


@_query
def op9_line_crf_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return line_crf.assess(docs, line_crf.fit(docs))


@_query
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read_table(spark, sf_dir, "documents"))


ORACLE_SQL["op11_source_divergence"] = divergence.oracle_sql()


@_query
def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(read_table(spark, sf_dir, "documents"))


ORACLE_SQL["op12_phrase_collocations"] = collocations.oracle_sql()


@_query
def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(read_table(spark, sf_dir, "documents"))

#: Learned models, tokenizers and graphs are beyond SQL.
WITHOUT_SQL = set(QUERIES) - set(ORACLE_SQL)
