"""The operator inventory exercised on the generated tables.

Stand-ins: ``part`` plays cards (``p_partkey`` key, ``p_name`` name, ``p_brand``
set, ``p_type`` type, ``p_size`` weight); ``lineitem`` plays prices
(``l_extendedprice`` price, ``l_shipdate`` date, ``l_suppkey`` provider);
``orders`` plays sets; ``labels`` a wide status table; ``events.props`` JSON
text; ``customer`` an identifier table; ``documents``/``conversations`` text.

Each entry is ``(spark, sf_dir) -> DataFrame`` over whole tables, with an
equivalent DuckDB SQL oracle in ``ORACLE_SQL`` (same column names and types).
Money averages are exact (integer cents) and other float aggregates are
rounded on both sides; every top-k/page carries a unique tie-break
(``lineitem`` is unique on orderkey, linenumber, partkey, suppkey); sampling
oracles recompute the same md5-derived uniforms in SQL; map-building
stand-ins group by bounded keys (an order's lines, a part's prices).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import predicates as P
from tessera.functions.fuzzy import fuzzy_filter, fuzzy_join
from tessera.operators import aggregates as A
from tessera.operators import joins as J
from tessera.operators import nested as N
from tessera.operators import sampling as X
from tessera.operators import topk as K
from tessera.session import scratch_path
from tessera.sources import files as S
from tessera.sources import normalize as NZ
from tessera.sources.json_array import read_json_array
from tessera.sources.registry import load_table
from tessera.sources.sql import scalar, sql

QUERIES: dict = {}
ORACLE_SQL: dict = {}

LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
NAME = "red widget"          # a part name present at every scale factor


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE_SQL[name] = oracle.strip()
        return fn
    return deco


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return load_table(spark, sf, name)


def _u_sql(seed: str, key_sql: str) -> str:
    """SQL text of ``hash_uniform`` (same bits as the Spark expression)."""
    return (f"((CAST(CAST(('0x' || substr(md5('{seed}|' || {key_sql}), 1, 13)) AS BIGINT) AS DOUBLE)"
            f" + CAST(0.5 AS DOUBLE)) / CAST(4503599627370496 AS DOUBLE))")


# --------------------------------------------------------------------------
# K4 + J6: the flagship — cheapest printings of every name (bulk top-k).
# --------------------------------------------------------------------------
@query("topn_cheapest", """
SELECT * FROM (
  SELECT p.p_name, p.p_partkey, p.p_brand, l.l_orderkey, l.l_linenumber, l.l_suppkey,
         l.l_extendedprice AS price,
         row_number() OVER (PARTITION BY p.p_name ORDER BY l.l_extendedprice ASC NULLS LAST,
           l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey) AS rank
  FROM part p JOIN lineitem l ON p.p_partkey = l.l_partkey) t
WHERE rank <= 3
""")
def topn_cheapest(spark, sf, n: int = 3):
    part = _t(spark, sf, "part").select("p_partkey", "p_name", "p_brand")
    li = _t(spark, sf, "lineitem").select(*LINE_KEY, F.col("l_extendedprice").alias("price"))
    joined = part.join(li, part.p_partkey == li.l_partkey, "inner")
    top = K.top_n_per_group(joined, "p_name", ["price asc"] + LINE_KEY, n, rank_col="rank")
    return top.select("p_name", "p_partkey", "p_brand", "l_orderkey", "l_linenumber", "l_suppkey",
                      "price", F.col("rank").cast("bigint").alias("rank"))


@query("topn_dearest", f"""
SELECT p.p_partkey, p.p_name, l.l_orderkey, l.l_linenumber, l.l_suppkey, l.l_extendedprice AS price
FROM part p JOIN lineitem l ON p.p_partkey = l.l_partkey
WHERE p.p_name = '{NAME}'
ORDER BY l.l_extendedprice DESC NULLS LAST, l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey
LIMIT 5
""")
def topn_dearest(spark, sf):
    part = _t(spark, sf, "part").where(P.eq("p_name", NAME)).select("p_partkey", "p_name")
    li = _t(spark, sf, "lineitem").select(*LINE_KEY, F.col("l_extendedprice").alias("price"))
    joined = part.join(li, part.p_partkey == li.l_partkey, "inner")
    top = K.top_n(joined, ["price desc"] + LINE_KEY, 5)
    return top.select("p_partkey", "p_name", "l_orderkey", "l_linenumber", "l_suppkey", "price")


@query("top1_all_names", """
SELECT p_name, p_partkey, l_orderkey, l_linenumber, l_suppkey, price FROM (
  SELECT p.p_name, p.p_partkey, l.l_orderkey, l.l_linenumber, l.l_suppkey, l.l_extendedprice AS price,
         row_number() OVER (PARTITION BY p.p_name ORDER BY l.l_extendedprice ASC NULLS LAST,
           l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey) AS rn
  FROM part p JOIN lineitem l ON p.p_partkey = l.l_partkey) t WHERE rn = 1
""")
def top1_all_names(spark, sf):
    part = _t(spark, sf, "part").select("p_partkey", "p_name")
    li = _t(spark, sf, "lineitem").select(*LINE_KEY, F.col("l_extendedprice").alias("price"))
    joined = part.join(li, part.p_partkey == li.l_partkey, "inner")
    top = K.top_n_per_group(joined, "p_name", ["price asc"] + LINE_KEY, 1, rank_col=None)
    return top.select("p_name", "p_partkey", "l_orderkey", "l_linenumber", "l_suppkey", "price")


# --------------------------------------------------------------------------
# Sources S1-S12
# --------------------------------------------------------------------------
@query("scan_view", """
SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_quantity > 45
""")
def scan_view(spark, sf):
    _t(spark, sf, "lineitem").createOrReplaceTempView("tessera_lineitem")
    return spark.table("tessera_lineitem").where(F.col("l_quantity") > 45) \
        .select("l_orderkey", "l_partkey", "l_quantity")


@query("csv_to_array", """
SELECT p_partkey, CAST(len(parts) AS BIGINT) AS n_items, CAST(t.ord AS BIGINT) AS item_pos, t.item
FROM (SELECT p_partkey,
        CASE WHEN name_parts IS NULL OR trim(name_parts) = '' THEN []::VARCHAR[]
             ELSE string_split(name_parts, ', ') END AS parts
      FROM (SELECT p_partkey, replace(p_name, ' ', ', ') AS name_parts FROM part)) s,
     unnest(parts) WITH ORDINALITY AS t(item, ord)
""")
def csv_to_array(spark, sf):
    # The derived text column ends in "s", so the schema heuristic picks it up.
    part = _t(spark, sf, "part").select("p_partkey", F.replace("p_name", F.lit(" "), F.lit(", ")).alias("name_parts"))
    norm = NZ.csv_to_array(part)
    return norm.select("p_partkey", F.size("name_parts").cast("bigint").alias("n_items"),
                       F.posexplode("name_parts").alias("item_pos", "item")) \
        .select("p_partkey", "n_items", (F.col("item_pos") + 1).cast("bigint").alias("item_pos"), "item")


@query("json_cast", """
SELECT event_type, CAST(sum((try_cast(props AS JSON)->>'$.k')::INTEGER) AS BIGINT) AS sum_k,
       count(*) AS n
FROM events GROUP BY event_type
""")
def json_cast(spark, sf):
    ev = NZ.json_to_variant(_t(spark, sf, "events").select("event_type", "props"), ["props"])
    return ev.groupBy("event_type").agg(
        F.sum(F.variant_get("props", "$.k", "int")).alias("sum_k"), F.count(F.lit(1)).alias("n"))


@query("json_shred", """
SELECT event_id, event_type, (try_cast(props AS JSON)->>'$.k')::BIGINT AS k FROM events
""")
def json_shred(spark, sf):
    return NZ.shred_json(_t(spark, sf, "events").select("event_id", "event_type", "props"), "props").select(
        "event_id", "event_type", F.col("k").cast("bigint").alias("k"))


@query("unpivot_status", """
SELECT doc_id, format, CAST(status AS VARCHAR) AS status
FROM (UNPIVOT labels ON quality, toxic INTO NAME format VALUE status)
""")
def unpivot_status(spark, sf):
    return NZ.unpivot_status(_t(spark, sf, "labels"), id_col="doc_id")


@query("ndjson_ingest", "SELECT * FROM customer")
def ndjson_ingest(spark, sf):
    cust = _t(spark, sf, "customer")
    path = scratch_path(spark, "ndjson-customer")
    cust.write.mode("overwrite").json(path)
    return S.ingest_ndjson(spark, path, schema=cust.schema).select(*cust.columns)


@query("json_envelope", "SELECT * FROM supplier")
def json_envelope(spark, sf):
    sup = _t(spark, sf, "supplier")
    path = scratch_path(spark, "envelope-supplier")
    # One document per 1000 keys: document size stays bounded as data grows.
    S.write_json_documents(sup, path, F.floor(F.col("s_suppkey") / 1000), meta={"version": "1"})
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("meta", T.StructType([T.StructField("version", T.StringType())])),
                           T.StructField("data", T.ArrayType(sup.schema))])
    docs = S.read_json_documents(spark, path, schema=schema, multi_line=False)
    return docs.select(*sup.columns)


@query("json_array_file", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
""")
def json_array_file(spark, sf):
    """One document that holds all customers, read in byte ranges."""
    cust = _t(spark, sf, "customer")
    first = cust.agg(F.min("c_custkey")).first()[0]
    comma = F.when(F.col("c_custkey") == F.lit(first), "").otherwise(",")
    lines = cust.select(F.when(comma == "", 1).otherwise(2).alias("at"),
                        F.concat(comma, F.to_json(F.struct(*cust.columns))).alias("value"))
    ends = spark.createDataFrame([(0, '{"meta": {"list": [1, {"data": []}]}, "data": ['), (3, "]}")], "at int, value string")
    path = scratch_path(spark, "one-document")
    lines.unionByName(ends).repartition(1).sortWithinPartitions("at").select("value").write.text(path)
    return read_json_array(spark, path, cust.schema)


@query("table_sink", """
SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_extendedprice), 2) AS revenue
FROM lineitem GROUP BY l_returnflag, l_linestatus
""")
def table_sink(spark, sf):
    agg = _t(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("revenue"))
    path = scratch_path(spark, "sink-summary")
    S.write_table(agg, path=path)
    return spark.read.parquet(path)


@query("bucket_join", """
SELECT * FROM (SELECT p_partkey, p_name, l_orderkey, l_linenumber, l_suppkey, l_extendedprice AS price,
  row_number() OVER (PARTITION BY p_partkey ORDER BY l_extendedprice NULLS LAST, l_orderkey, l_linenumber, l_suppkey) AS rank
  FROM part JOIN lineitem ON p_partkey = l_partkey) t WHERE rank <= 2
""")
def bucket_join(spark, sf):
    """Cards and prices written in buckets of their key: the join and the
    ranking that follow move no row."""
    part = S.bucketed(_t(spark, sf, "part").select("p_partkey", "p_name"), "p_partkey", 8)
    lines = S.bucketed(_t(spark, sf, "lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_orderkey", "l_linenumber",
                                                        "l_suppkey", F.col("l_extendedprice").alias("price")), "p_partkey", 8)
    joined = J.join_prices(part, lines, key="p_partkey", price_cols=("l_orderkey", "l_linenumber", "l_suppkey", "price"))
    top = K.top_n_per_group(joined, "p_partkey", ["price asc", "l_orderkey", "l_linenumber", "l_suppkey"], 2)
    return top.withColumn("rank", F.col("rank").cast("bigint"))


@query("optional_column_missing", """
SELECT p_partkey, p_type AS value FROM part WHERE p_size > 40
""")
def optional_column_missing(spark, sf):
    """Columns a file may have: the rows of those it has, none of those it hasn't."""
    part = _t(spark, sf, "part").where(P.gte("p_size", 41))
    found = [S.optional_column(part, c, schema="p_partkey bigint, value string",
                               select=lambda d, c=c: d.select("p_partkey", F.col(c).alias("value")))
             for c in ("p_container", "p_type")]
    return found[0].unionByName(found[1])


@query("optional_column_present", """
SELECT p_partkey, p_type FROM part WHERE p_type IS NOT NULL
""")
def optional_column_present(spark, sf):
    return S.optional_column(_t(spark, sf, "part"), "p_type",
                             schema="p_partkey bigint, p_type string",
                             select=lambda d: d.where(P.not_null("p_type")).select("p_partkey", "p_type"))


@query("sql_params", """
SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_extendedprice), 2) AS revenue
FROM lineitem WHERE l_quantity >= 10 AND l_returnflag IN ('A', 'R')
GROUP BY l_returnflag, l_linestatus
""")
def sql_params(spark, sf):
    _t(spark, sf, "lineitem").createOrReplaceTempView("tessera_lineitem")
    return sql(spark, """
        SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_extendedprice), 2) AS revenue
        FROM tessera_lineitem WHERE l_quantity >= ? AND l_returnflag IN (?, ?)
        GROUP BY l_returnflag, l_linestatus""", [10, "A", "R"])


@query("sql_scalar", "SELECT max(l_extendedprice) AS max_price FROM lineitem")
def sql_scalar(spark, sf):
    return scalar(_t(spark, sf, "lineitem").agg(F.max("l_extendedprice").alias("max_price")))


# --------------------------------------------------------------------------
# Projections and predicates P1-P23
# --------------------------------------------------------------------------
@query("project", "SELECT p_partkey, p_name FROM part")
def project(spark, sf):
    return _t(spark, sf, "part").select("p_partkey", "p_name")


@query("distinct_rows", "SELECT DISTINCT p_brand, p_type FROM part")
def distinct_rows(spark, sf):
    return _t(spark, sf, "part").select("p_brand", "p_type").distinct()


@query("filter_eq", "SELECT p_partkey, p_name, p_brand FROM part WHERE p_brand = 'Brand#3'")
def filter_eq(spark, sf):
    return _t(spark, sf, "part").where(P.eq("p_brand", "Brand#3")).select("p_partkey", "p_name", "p_brand")


@query("filter_range", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
WHERE l_quantity >= 10 AND l_quantity <= 20
""")
def filter_range(spark, sf):
    return _t(spark, sf, "lineitem").where(P.between("l_quantity", 10.0, 20.0)) \
        .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


@query("filter_in", "SELECT p_partkey, p_type FROM part WHERE p_type IN ('SMALL', 'PROMO')")
def filter_in(spark, sf):
    return _t(spark, sf, "part").where(P.isin("p_type", ["SMALL", "PROMO"])).select("p_partkey", "p_type")


@query("filter_in_empty", "SELECT p_partkey, p_type, p_type IN ('SMALL', 'LARGE') AS listed FROM part WHERE p_size > 25")
def filter_in_empty(spark, sf):
    """An empty list holds nothing: alone FALSE, beside another condition no matter."""
    none = P.isin("p_type", [])
    return (_t(spark, sf, "part").where(none | P.gte("p_size", 26))
            .select("p_partkey", "p_type", (none | P.isin("p_type", ["SMALL", "LARGE"])).alias("listed")))


@query("like_ci", "SELECT p_partkey, p_name FROM part WHERE lower(p_name) LIKE lower('%WIDG_T')")
def like_ci(spark, sf):
    return _t(spark, sf, "part").where(P.like_ci("p_name", "%WIDG_T")).select("p_partkey", "p_name")


@query("name_exact_or_like", """
SELECT p_partkey, p_name, 'like' AS mode FROM part WHERE lower(p_name) LIKE lower('Red%')
UNION ALL
SELECT p_partkey, p_name, 'exact' AS mode FROM part WHERE p_name = 'blue bolt'
""")
def name_exact_or_like(spark, sf):
    part = _t(spark, sf, "part")
    a = part.where(P.exact_or_like("p_name", "Red%")).select("p_partkey", "p_name", F.lit("like").alias("mode"))
    b = part.where(P.exact_or_like("p_name", "blue bolt")).select("p_partkey", "p_name", F.lit("exact").alias("mode"))
    return a.unionByName(b)


@query("substring_ci", "SELECT doc_id, lang FROM documents WHERE lower(text) LIKE lower('%The Of%')")
def substring_ci(spark, sf):
    return _t(spark, sf, "documents").where(P.contains_ci("text", "The Of")).select("doc_id", "lang")


@query("literal_contains", "SELECT doc_id, source FROM documents WHERE contains(lower(text), 'copyright')")
def literal_contains(spark, sf):
    return _t(spark, sf, "documents").where(P.literal_contains_ci("text", "COPYRIGHT")).select("doc_id", "source")


@query("regex_text", """
SELECT doc_id, lang FROM documents WHERE regexp_matches(text, '[0-9]{3}-[0-9]{4}')
""")
def regex_text(spark, sf):
    return _t(spark, sf, "documents").where(P.regex("text", "[0-9]{3}-[0-9]{4}")).select("doc_id", "lang")


@query("fuzzy_name", """
SELECT p_partkey, p_name, round(jaro_winkler_similarity(p_name, 'red widgit'), 9) AS similarity
FROM part WHERE jaro_winkler_similarity(p_name, 'red widgit') > 0.8
""")
def fuzzy_name(spark, sf):
    out = fuzzy_filter(_t(spark, sf, "part").select("p_partkey", "p_name"), "p_name", "red widgit", 0.8)
    return out.select("p_partkey", "p_name", F.round("similarity", 9).alias("similarity"))


@query("fuzzy_ranked", """
SELECT c_custkey, c_name, round(jaro_winkler_similarity(c_name, 'Customer#00000042'), 9) AS similarity
FROM customer WHERE jaro_winkler_similarity(c_name, 'Customer#00000042') > 0.9
ORDER BY jaro_winkler_similarity(c_name, 'Customer#00000042') DESC, c_custkey LIMIT 10
""")
def fuzzy_ranked(spark, sf):
    out = fuzzy_filter(_t(spark, sf, "customer").select("c_custkey", "c_name"), "c_name",
                       "Customer#00000042", 0.9)
    top = K.top_n(out, ["similarity desc", "c_custkey asc"], 10)
    return top.select("c_custkey", "c_name", F.round("similarity", 9).alias("similarity"))


@query("fuzzy_join", """
WITH names AS (SELECT DISTINCT p_name AS name FROM part UNION SELECT c_name FROM customer),
asked AS (SELECT DISTINCT replace(p_name, 'i', 'ie') AS wanted FROM part UNION SELECT s_name FROM supplier),
pairs AS (SELECT name, wanted, jaro_winkler_similarity(name, wanted) AS s FROM names, asked)
SELECT name, wanted, round(s, 9) AS similarity FROM pairs WHERE s > 0.8
""")
def fuzzy_join_query(spark, sf):
    """All part and customer names against misspelt part names and supplier names."""
    names = _t(spark, sf, "part").select(F.col("p_name").alias("name")).union(
        _t(spark, sf, "customer").select("c_name")).distinct()
    asked = _t(spark, sf, "part").select(F.replace("p_name", F.lit("i"), F.lit("ie")).alias("wanted")).union(
        _t(spark, sf, "supplier").select("s_name")).distinct()
    return fuzzy_join(names, "name", asked, "wanted").select("name", "wanted",
                                                             F.round("similarity", 9).alias("similarity"))


@query("or_group", """
SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
WHERE (o_orderpriority = '1-URGENT' OR o_orderstatus = 'F')
""")
def or_group(spark, sf):
    cond = P.any_of([P.eq("o_orderpriority", "1-URGENT"), P.eq("o_orderstatus", "F")])
    return P.apply_filters(_t(spark, sf, "orders"), cond).select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query("free_predicate", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 300000 AND o_orderstatus = 'O'
""")
def free_predicate(spark, sf):
    return P.apply_filters(_t(spark, sf, "orders"), F.col("o_totalprice") > F.lit(300000.0),
                           P.eq("o_orderstatus", "O")).select("o_orderkey", "o_totalprice")


@query("not_null", "SELECT o_orderkey FROM orders WHERE o_orderpriority IS NOT NULL")
def not_null(spark, sf):
    return _t(spark, sf, "orders").where(P.not_null("o_orderpriority")).select("o_orderkey")


@query("array_contains_all", """
SELECT p_partkey, p_name FROM part
WHERE list_contains(string_split(p_name, ' '), 'red') AND list_contains(string_split(p_name, ' '), 'widget')
""")
def array_contains_all(spark, sf):
    part = _t(spark, sf, "part").select("p_partkey", "p_name", F.split("p_name", " ").alias("words"))
    return part.where(P.contains_all("words", ["red", "widget"])).select("p_partkey", "p_name")


@query("year_filter", """
SELECT o_orderkey, o_orderdate FROM orders WHERE extract(year FROM o_orderdate) = 1997
""")
def year_filter(spark, sf):
    return _t(spark, sf, "orders").where(P.year_eq("o_orderdate", 1997)).select("o_orderkey", "o_orderdate")


@query("date_range", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM lineitem
WHERE l_shipdate >= DATE '1996-01-01' AND l_shipdate <= DATE '1996-03-31'
""")
def date_range(spark, sf):
    return _t(spark, sf, "lineitem").where(P.date_range("l_shipdate", "1996-01-01", "1996-03-31")) \
        .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")


@query("bool_filter", "SELECT doc_id FROM labels WHERE CAST(toxic AS BOOLEAN) = true")
def bool_filter(spark, sf):
    lab = _t(spark, sf, "labels").withColumn("is_toxic", F.col("toxic").cast("boolean"))
    return lab.where(P.bool_eq("is_toxic", True)).select("doc_id")


@query("ci_equality", """
SELECT c_custkey, c_mktsegment FROM customer WHERE lower(c_mktsegment) = 'building'
""")
def ci_equality(spark, sf):
    return _t(spark, sf, "customer").where(P.ascii_ci_eq("c_mktsegment", "Building")) \
        .select("c_custkey", "c_mktsegment")


@query("upper_key", "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'MACHINERY'")
def upper_key(spark, sf):
    return _t(spark, sf, "customer").where(P.eq("c_mktsegment", P.upper_key("machinery"))) \
        .select("c_custkey", "c_name")


@query("filter_map_count", """
SELECT count(*) AS n FROM part WHERE p_brand = 'Brand#3' AND p_type = 'SMALL'
""")
def filter_map_count(spark, sf):
    return A.count_rows(_t(spark, sf, "part"), filters={"p_brand": "Brand#3", "p_type": "SMALL"})


@query("search_all_filters", """
SELECT p_partkey, p_name, p_type, p_size FROM part p
WHERE lower(p_name) LIKE lower('%widget%') AND p_size >= 10 AND p_size <= 40
  AND p_type IN ('SMALL', 'ECONOMY', 'PROMO')
  AND EXISTS (SELECT 1 FROM lineitem l WHERE l.l_partkey = p.p_partkey AND l.l_returnflag = 'R')
ORDER BY p_size DESC NULLS LAST, p_partkey ASC LIMIT 20 OFFSET 5
""")
def search_all_filters(spark, sf):
    part = _t(spark, sf, "part")
    li = _t(spark, sf, "lineitem").where(P.eq("l_returnflag", "R")).select(F.col("l_partkey").alias("p_partkey"))
    hits = P.apply_filters(part, P.contains_ci("p_name", "widget"), P.between("p_size", 10, 40),
                           P.isin("p_type", ["SMALL", "ECONOMY", "PROMO"]))
    hits = hits.join(li, "p_partkey", "left_semi")
    return K.page(hits.select("p_partkey", "p_name", "p_type", "p_size"),
                  ["p_size desc", "p_partkey asc"], limit=20, offset=5)


# --------------------------------------------------------------------------
# Joins J2-J8
# --------------------------------------------------------------------------
@query("join_ids", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_name = 'Customer#000000042')
""")
def join_ids(spark, sf):
    orders = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    ids = _t(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    return J.join_by_identifier(orders, ids, "c_name", "Customer#000000042", key="o_custkey")


@query("ids_bulk_lookup", """
WITH ids AS (
  SELECT c_custkey, 'c_name' AS id_type, c_name AS id_value FROM customer WHERE c_name IS NOT NULL
  UNION ALL
  SELECT c_custkey, 'c_mktsegment', c_mktsegment FROM customer WHERE c_mktsegment IS NOT NULL),
lookups AS (
  SELECT DISTINCT 'c_name' AS id_type, c_name AS id_value FROM customer WHERE c_acctbal > 9000)
SELECT o.o_orderkey, i.c_custkey, i.id_type, i.id_value
FROM ids i JOIN lookups k ON i.id_type = k.id_type AND i.id_value = k.id_value
JOIN orders o ON o.o_custkey = i.c_custkey
""")
def ids_bulk_lookup(spark, sf):
    cust = _t(spark, sf, "customer")
    ids = cust.select("c_custkey", "c_name", "c_mktsegment")
    lookups = cust.where(F.col("c_acctbal") > 9000).select(
        F.lit("c_name").alias("id_type"), F.col("c_name").alias("id_value")).distinct()
    orders = _t(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    out = J.resolve_identifiers(orders, ids, lookups, key="c_custkey")
    return out.select("o_orderkey", "c_custkey", "id_type", "id_value")


@query("join_status", """
SELECT d.doc_id, d.lang FROM documents d
WHERE d.doc_id IN (SELECT doc_id FROM (UNPIVOT labels ON quality, toxic INTO NAME format VALUE status)
                   WHERE format = 'quality' AND CAST(status AS VARCHAR) = '1')
""")
def join_status(spark, sf):
    status = NZ.unpivot_status(_t(spark, sf, "labels"), id_col="doc_id")
    docs = _t(spark, sf, "documents").select("doc_id", "lang")
    return J.join_status(docs, status, "quality", "1", key="doc_id")


@query("join_translations", """
SELECT d.doc_id, d.lang, c.text AS foreign_name FROM documents d
JOIN conversations c ON d.doc_id = c.conv_id
WHERE lower(c.text) LIKE lower('%der%')
""")
def join_translations(spark, sf):
    docs = _t(spark, sf, "documents").select("doc_id", "lang")
    conv = _t(spark, sf, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("text").alias("name"))
    return J.join_translations(docs, conv, "der", key="doc_id")


@query("join_translations_dedupe", """
SELECT d.doc_id, d.lang FROM documents d
WHERE EXISTS (SELECT 1 FROM conversations c WHERE c.conv_id = d.doc_id AND lower(c.text) LIKE lower('%der%'))
""")
def join_translations_dedupe(spark, sf):
    docs = _t(spark, sf, "documents").select("doc_id", "lang")
    conv = _t(spark, sf, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("text").alias("name"))
    return J.join_translations(docs, conv, "der", key="doc_id", dedupe=True)


@query("join_dimension", """
SELECT c.c_custkey, c.c_name, n.n_name AS nation_n_name FROM customer c
JOIN nation n ON c.c_nationkey = n.n_nationkey WHERE n.n_regionkey = 1
""")
def join_dimension(spark, sf):
    cust = _t(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    nation = _t(spark, sf, "nation")
    out = J.join_dimension(cust, nation, "c_nationkey", "n_nationkey", P.eq("n_regionkey", 1),
                           keep=["n_name"], prefix="nation_")
    return out.select("c_custkey", "c_name", "nation_n_name")


@query("latest_rows", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice FROM lineitem l
WHERE l_shipdate = (SELECT max(l_shipdate) FROM lineitem m WHERE m.l_partkey = l.l_partkey)
""")
def latest_rows(spark, sf):
    li = _t(spark, sf, "lineitem").select(*LINE_KEY, "l_shipdate", "l_extendedprice")
    return J.latest_rows(li, "l_partkey", "l_shipdate")


@query("latest_per_group", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice FROM lineitem l
WHERE l_shipdate = (SELECT max(l_shipdate) FROM lineitem m
                    WHERE m.l_partkey = l.l_partkey AND m.l_returnflag = l.l_returnflag)
""")
def latest_per_group(spark, sf):
    li = _t(spark, sf, "lineitem").select(*LINE_KEY, "l_returnflag", "l_shipdate", "l_extendedprice")
    return J.latest_rows(li, "l_partkey", "l_shipdate", per=["l_returnflag"]).drop("l_returnflag")


@query("ordered_batch_fetch", """
SELECT l.l_orderkey, l.l_linenumber AS pos, p.p_partkey, p.p_name FROM lineitem l
JOIN part p ON l.l_partkey = p.p_partkey WHERE p.p_size > 25
""")
def ordered_batch_fetch(spark, sf):
    req = _t(spark, sf, "lineitem").select("l_orderkey", F.col("l_linenumber").alias("pos"), "l_partkey")
    part = _t(spark, sf, "part").where(F.col("p_size") > 25).select("p_partkey", "p_name")
    return J.ordered_fetch(req, part, "l_partkey", request_col="l_orderkey", pos_col="pos",
                           fact_key="p_partkey")


@query("today_single", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice FROM lineitem
WHERE l_partkey = 7 AND l_shipdate = (SELECT max(l_shipdate) FROM lineitem WHERE l_partkey = 7)
""")
def today_single(spark, sf):
    # J7 for one key: the key filter pushes to the scan before the max.
    li = _t(spark, sf, "lineitem").where(P.eq("l_partkey", 7)).select(
        *LINE_KEY, "l_shipdate", "l_extendedprice")
    return J.latest_rows(li, "l_partkey", "l_shipdate")


# --------------------------------------------------------------------------
# Aggregates A1-A10
# --------------------------------------------------------------------------
@query("price_trend", """
SELECT l_partkey, min(l_extendedprice) AS min_price, max(l_extendedprice) AS max_price,
       sum(CAST(round(l_extendedprice * 100.0) AS BIGINT)) / count(l_extendedprice) / 100.0 AS avg_price,
       min(l_shipdate) AS first_date,
       max(l_shipdate) AS last_date, count(*) AS data_points
FROM lineitem GROUP BY l_partkey
""")
def price_trend(spark, sf):
    return A.price_trend(_t(spark, sf, "lineitem"), key="l_partkey", price="l_extendedprice",
                         date="l_shipdate", money_scale=2)


@query("price_trend_missing", """
SELECT min(l_extendedprice) AS min_price, max(l_extendedprice) AS max_price,
       avg(l_extendedprice) AS avg_price, min(l_shipdate) AS first_date,
       max(l_shipdate) AS last_date, count(*) AS data_points
FROM lineitem WHERE l_partkey = -1
""")
def price_trend_missing(spark, sf):
    return A.price_trend(_t(spark, sf, "lineitem"), price="l_extendedprice", date="l_shipdate",
                         where=P.eq("l_partkey", -1))


@query("trend_single", """
SELECT min(l_extendedprice) AS min_price, max(l_extendedprice) AS max_price,
       sum(CAST(round(l_extendedprice * 100.0) AS BIGINT)) / count(l_extendedprice) / 100.0 AS avg_price,
       min(l_shipdate) AS first_date, max(l_shipdate) AS last_date, count(*) AS data_points
FROM lineitem WHERE l_partkey = 7
""")
def trend_single(spark, sf):
    return A.price_trend(_t(spark, sf, "lineitem"), price="l_extendedprice", date="l_shipdate",
                         where=P.eq("l_partkey", 7), money_scale=2)


@query("exists_single", """
SELECT count(*) > 0 AS is_legal FROM (UNPIVOT labels ON quality, toxic INTO NAME format VALUE status)
WHERE doc_id = 4 AND format = 'quality' AND CAST(status AS VARCHAR) = '1'
""")
def exists_single(spark, sf):
    status = NZ.unpivot_status(_t(spark, sf, "labels"), id_col="doc_id")
    hits = status.where(P.eq("doc_id", 4) & P.eq("format", "quality") & P.eq("status", "1"))
    return hits.agg((F.count(F.lit(1)) > 0).alias("is_legal"))


@query("financial_summary", """
SELECT p.p_brand, count(DISTINCT p.p_partkey) AS card_count,
       coalesce(sum(CAST(round(l.l_extendedprice * 100.0) AS BIGINT)) / 100.0, 0) AS total_value,
       coalesce(sum(CAST(round(l.l_extendedprice * 100.0) AS BIGINT)) / count(l.l_extendedprice) / 100.0, 0)
         AS avg_value,
       coalesce(min(l.l_extendedprice), 0) AS min_value, coalesce(max(l.l_extendedprice), 0) AS max_value,
       max(l.l_shipdate) AS date
FROM part p JOIN lineitem l ON p.p_partkey = l.l_partkey GROUP BY p.p_brand
""")
def financial_summary(spark, sf):
    part = _t(spark, sf, "part").select("p_partkey", "p_brand")
    li = _t(spark, sf, "lineitem").select(F.col("l_partkey").alias("p_partkey"),
                                          F.col("l_extendedprice").alias("price"), F.col("l_shipdate").alias("date"))
    return A.financial_summary(part.join(li, "p_partkey"), group="p_brand", item="p_partkey", money_scale=2)


@query("group_having", """
SELECT l_suppkey, count(*) AS n, round(sum(l_quantity), 2) AS qty FROM lineitem
GROUP BY l_suppkey HAVING count(*) > 600
""")
def group_having(spark, sf):
    return A.group_having(_t(spark, sf, "lineitem"), "l_suppkey",
                          [F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty")],
                          having=F.col("n") > 600)


@query("exists_flag", """
SELECT d.doc_id, EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 1) AS "exists"
FROM documents d
""")
def exists_flag(spark, sf):
    docs = _t(spark, sf, "documents").select("doc_id")
    return A.exists_flag(docs, _t(spark, sf, "labels"), ["doc_id"], cond=P.eq("quality", 1))


@query("distinct_on", """
SELECT DISTINCT ON (p_name, p_brand) p_partkey, p_name, p_brand, p_type, p_size, p_retailprice
FROM part ORDER BY p_name, p_brand, p_retailprice ASC NULLS LAST, p_partkey ASC
""")
def distinct_on(spark, sf):
    return A.distinct_on(_t(spark, sf, "part"), ["p_name", "p_brand"], ["p_retailprice", "p_partkey"])


@query("atomic_fallback", """
WITH req AS (SELECT DISTINCT p_name AS request FROM part UNION SELECT DISTINCT p_type FROM part),
cand AS (
  SELECT r.request, p.*, 1 AS prio FROM req r JOIN part p ON p.p_name = r.request
  UNION ALL
  SELECT r.request, p.*, 2 AS prio FROM req r JOIN part p ON p.p_type = r.request),
best AS (SELECT request, min(prio) AS prio FROM cand GROUP BY request)
SELECT DISTINCT ON (c.request, c.p_name, c.p_type) c.request, c.p_partkey, c.p_name, c.p_brand, c.p_type,
       c.p_size, c.p_retailprice
FROM cand c JOIN best b ON c.request = b.request AND c.prio = b.prio
ORDER BY c.request, c.p_name, c.p_type, c.p_partkey
""")
def atomic_fallback(spark, sf):
    part = _t(spark, sf, "part")
    req = part.select(F.col("p_name").alias("request")).unionByName(part.select(F.col("p_type").alias("request")))
    out = A.distinct_on_with_fallback(req, part, "request", "p_name", "p_type", ["p_name", "p_type"], ["p_partkey"])
    return out.select("request", "p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")


@query("distinct_sorted", "SELECT DISTINCT p_type FROM part WHERE p_type IS NOT NULL ORDER BY p_type")
def distinct_sorted(spark, sf):
    return A.distinct_sorted(_t(spark, sf, "part"), "p_type")


def _price_rows(spark, sf):
    li = _t(spark, sf, "lineitem")
    return li.select(
        F.col("l_partkey").alias("uuid"), F.col("l_returnflag").alias("source"),
        F.col("l_suppkey").cast("string").alias("provider"), F.col("l_linestatus").alias("currency"),
        F.when(F.col("l_discount") > 0.05, "buylist").otherwise("retail").alias("price_type"),
        F.when(F.col("l_tax") > 0.04, "foil").otherwise("normal").alias("finish"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"),
        F.col("l_extendedprice").alias("price"))


_PRICE_ROWS_SQL = """
SELECT l_partkey AS uuid, l_returnflag AS source, CAST(l_suppkey AS VARCHAR) AS provider,
       l_linestatus AS currency, CASE WHEN l_discount > 0.05 THEN 'buylist' ELSE 'retail' END AS price_type,
       CASE WHEN l_tax > 0.04 THEN 'foil' ELSE 'normal' END AS finish,
       strftime(l_shipdate, '%Y-%m-%d') AS date, l_extendedprice AS price
FROM lineitem"""


@query("nested_price_map", f"""
SELECT uuid, source, provider, currency, price_type, finish, date, max(price) AS price
FROM ({_PRICE_ROWS_SQL}) t
GROUP BY uuid, source, provider, currency, price_type, finish, date
""")
def nested_price_map(spark, sf):
    levels = ["source", "provider", "currency", "price_type", "finish"]
    nested = A.nested_map(_price_rows(spark, sf), ["uuid"], levels, "date", "price", out="prices", task_rows=200_000)
    return A.flatten_nested_map(nested, ["uuid"], levels, "date", "price")


@query("nested_price_map_parts", f"""
SELECT uuid, source, provider, currency, price_type, finish, date, max(price) AS price
FROM ({_PRICE_ROWS_SQL}) t
GROUP BY uuid, source, provider, currency, price_type, finish, date
""")
def nested_price_map_parts(spark, sf):
    """Maps of at most about 8 entries, so that most parts have several."""
    levels = ["source", "provider", "currency", "price_type", "finish"]
    parts = A.nested_map_parts(_price_rows(spark, sf), ["uuid"], levels, "date", "price", most=8)
    return A.flatten_nested_map(parts, ["uuid", "part"], levels, "date", "price").drop("part")


_GROUP_MAP_SQL = """
WITH c AS (SELECT l_orderkey, 'line' || CAST(l_linenumber AS VARCHAR) AS sheet,
                  max(CAST(l_quantity AS BIGINT)) AS picks
           FROM lineitem GROUP BY l_orderkey, sheet),
t AS (SELECT o.o_orderkey, CAST(coalesce(CAST(floor(o.o_totalprice / 100000) AS BIGINT), 1) AS BIGINT) AS weight,
             c.sheet, c.picks, count(c.sheet) OVER (PARTITION BY o.o_orderkey) AS n_sheets
      FROM orders o LEFT JOIN c ON c.l_orderkey = o.o_orderkey)
"""


def _template_tables(spark, sf):
    weights = _t(spark, sf, "orders").select(
        "o_orderkey", F.floor(F.col("o_totalprice") / 100000).cast("bigint").alias("w"))
    contents = _t(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.concat(F.lit("line"), F.col("l_linenumber").cast("string")).alias("sheet"),
        F.col("l_quantity").cast("bigint").alias("picks"))
    return weights, contents


def _templates(spark, sf):
    tpl = A.templates(*_template_tables(spark, sf), [], "o_orderkey", "w", "sheet", "picks")
    return tpl.withColumn("n_sheets", F.size("sheets").cast("bigint"))


@query("group_map", _GROUP_MAP_SQL + "SELECT o_orderkey, weight, sheet, picks, n_sheets FROM t WHERE n_sheets > 0")
def group_map(spark, sf):
    # Templates with contents: one row per (template, sheet).
    return _templates(spark, sf).select("o_orderkey", "weight", "n_sheets",
                                        F.explode("sheets").alias("sheet", "picks")) \
        .select("o_orderkey", "weight", "sheet", "picks", "n_sheets")


@query("group_map_empty", _GROUP_MAP_SQL + "SELECT DISTINCT o_orderkey, weight, n_sheets FROM t WHERE n_sheets = 0")
def group_map_empty(spark, sf):
    return (A.empty_templates(*_template_tables(spark, sf), [], "o_orderkey", "w", "sheet")
            .select("o_orderkey", "weight", F.lit(0).cast("bigint").alias("n_sheets")))


@query("weight_map", """
SELECT l_orderkey, CAST(l_partkey AS VARCHAR) AS card, max(coalesce(CAST(l_quantity AS BIGINT), 1)) AS weight,
       count(*) OVER (PARTITION BY l_orderkey) AS n_cards
FROM lineitem GROUP BY l_orderkey, l_partkey
""")
def weight_map(spark, sf):
    # Sheet = order (a bounded group: a handful of lines), card = part,
    # weight = quantity; repeated parts in an order resolve to the max.
    li = _t(spark, sf, "lineitem").select(
        "l_orderkey", F.col("l_partkey").cast("string").alias("card"),
        F.col("l_quantity").cast("bigint").alias("qty"))
    m = A.weight_map(li, ["l_orderkey"], "card", "qty", out="cards")
    return m.select("l_orderkey", F.size("cards").cast("bigint").alias("n_cards"),
                    F.explode("cards").alias("card", "weight")) \
        .select("l_orderkey", "card", "weight", "n_cards")


# --------------------------------------------------------------------------
# Sort / page / lookup K1-K6
# --------------------------------------------------------------------------
@query("page", """
SELECT o_orderkey, o_totalprice FROM orders
ORDER BY o_totalprice DESC NULLS LAST, o_orderkey ASC LIMIT 20 OFFSET 40
""")
def page(spark, sf):
    return K.page(_t(spark, sf, "orders").select("o_orderkey", "o_totalprice"),
                  ["o_totalprice desc", "o_orderkey asc"], limit=20, offset=40)


@query("page_deep", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM (
  SELECT *, row_number() OVER (ORDER BY l_extendedprice DESC NULLS LAST, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS r,
         count(*) OVER () AS n FROM lineitem) t
WHERE r > n // 2 AND r <= n // 2 + 50
""")
def page_deep(spark, sf):
    """The page in the middle of all lines, from one range of a rank index."""
    lines = _t(spark, sf, "lineitem").select(*LINE_KEY, "l_extendedprice")
    index = K.RankIndex(lines, ["l_extendedprice desc", *LINE_KEY], rows=20_000)
    return index.page(sum(n for _, n in index.counts) // 2, 50)


@query("page_keyset", """
SELECT o_orderdate, o_orderkey FROM orders
WHERE o_orderdate > TIMESTAMP '1997-06-01 00:00:00'
   OR (o_orderdate = TIMESTAMP '1997-06-01 00:00:00' AND o_orderkey > 100)
ORDER BY o_orderdate, o_orderkey LIMIT 20
""")
def page_keyset(spark, sf):
    # An ISO string literal casts to the column's timestamp_ntz type directly
    # (no session time zone involved).
    orders = _t(spark, sf, "orders").select("o_orderdate", "o_orderkey")
    return K.page_after(orders, ["o_orderdate", "o_orderkey"], ("1997-06-01 00:00:00", 100), limit=20)


@query("newest_first", """
SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC NULLS LAST, o_orderkey ASC LIMIT 25
""")
def newest_first(spark, sf):
    return K.top_n(_t(spark, sf, "orders").select("o_orderkey", "o_orderdate"),
                   ["o_orderdate desc", "o_orderkey asc"], 25)


@query("history_sorted", """
SELECT l_shipdate, l_extendedprice, l_orderkey, l_linenumber FROM lineitem
WHERE l_partkey = 7 AND l_shipdate >= DATE '1996-01-01' ORDER BY l_shipdate ASC
""")
def history_sorted(spark, sf):
    li = _t(spark, sf, "lineitem").where(P.eq("l_partkey", 7) & P.date_range("l_shipdate", "1996-01-01", None))
    return K.order_by(li.select("l_shipdate", "l_extendedprice", "l_orderkey", "l_linenumber"),
                      "l_shipdate asc", "l_orderkey asc", "l_linenumber asc")


@query("point_lookup", "SELECT * FROM part WHERE p_partkey = 42 LIMIT 1")
def point_lookup(spark, sf):
    return K.point_lookup(_t(spark, sf, "part"), "p_partkey", 42)


@query("bulk_lookup", """
SELECT p.* FROM part p WHERE p.p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity = 50)
""")
def bulk_lookup(spark, sf):
    keys = _t(spark, sf, "lineitem").where(P.eq("l_quantity", 50.0)).select("l_partkey")
    return K.bulk_lookup(_t(spark, sf, "part"), "p_partkey", keys)


# --------------------------------------------------------------------------
# Nested N1-N3
# --------------------------------------------------------------------------
@query("explode_tagged", """
SELECT CAST(t.ord - 1 AS INTEGER) AS line_no, t.line AS text, d.doc_id AS docId, d.lang AS docLang
FROM documents d, unnest(string_split(d.text, chr(10))) WITH ORDINALITY AS t(line, ord)
""")
def explode_tagged(spark, sf):
    docs = _t(spark, sf, "documents")
    # Children as an array of structs, built per row (no grouping).
    lines = docs.select("doc_id", "lang",
                        F.transform(F.split("text", "\n"), lambda x: F.struct(x.alias("text"))).alias("lines"))
    return N.explode_tagged(lines, "lines", {"doc_id": "docId", "lang": "docLang"}, position="line_no")


@query("doc_filter", """
SELECT event_id, user_id, event_type, props FROM events
WHERE lower(event_type) = 'click' AND contains(lower(props), '7')
""")
def doc_filter(spark, sf):
    ev = _t(spark, sf, "events").select("event_id", "user_id", "event_type", "props")
    return N.filter_documents(ev, equals_ci={"event_type": "CLICK"}, contains={"props": "7"})


@query("vocab_explode", """
SELECT e.event_id, k.category, k.value FROM events e,
  (SELECT unnest(map_keys(m)) AS category, unnest(map_values(m)) AS value
   FROM (SELECT CAST(CAST(e.props AS JSON) AS MAP(VARCHAR, INTEGER)) AS m)) k
""")
def vocab_explode(spark, sf):
    ev = _t(spark, sf, "events").select("event_id", F.from_json("props", "map<string,int>").alias("data"))
    return ev.select("event_id", F.explode("data").alias("category", "value"))


# --------------------------------------------------------------------------
# Sampling X1-X5
# --------------------------------------------------------------------------
@query("sample_n", f"""
SELECT p_partkey, p_name FROM part
ORDER BY {_u_sql('s1', 'CAST(p_partkey AS VARCHAR)')}, p_partkey LIMIT 25
""")
def sample_n(spark, sf):
    return X.sample_n(_t(spark, sf, "part").select("p_partkey", "p_name"), 25, "p_partkey", seed="s1")


@query("weighted_pick", f"""
SELECT p_brand, arg_min(p_partkey, (k, p_partkey)) AS p_partkey FROM (
  SELECT p_brand, p_partkey, p_size,
    CASE WHEN tot > 0 THEN (CASE WHEN coalesce(p_size, 1) > 0
         THEN -ln({_u_sql('pick', "p_brand || '|' || CAST(p_partkey AS VARCHAR)")}) / coalesce(p_size, 1) END)
         ELSE {_u_sql('pick', "p_brand || '|' || CAST(p_partkey AS VARCHAR)")} END AS k
  FROM (SELECT *, sum(coalesce(p_size, 1)) OVER (PARTITION BY p_brand) AS tot FROM part)) t
WHERE k IS NOT NULL GROUP BY p_brand
""")
def weighted_pick(spark, sf):
    part = _t(spark, sf, "part").select("p_brand", "p_partkey", "p_size")
    return X.weighted_pick(part, "p_brand", "p_partkey", "p_size", seed="pick").select("p_brand", "p_partkey")


@query("weighted_without_repl", f"""
SELECT p_brand, p_partkey, draw FROM (
  SELECT p_brand, p_partkey,
         row_number() OVER (PARTITION BY p_brand ORDER BY k, p_partkey) AS draw
  FROM (SELECT p_brand, p_partkey,
          -ln({_u_sql('wor', "p_brand || '|' || CAST(p_partkey AS VARCHAR)")}) / coalesce(p_size, 1) AS k
        FROM part WHERE coalesce(p_size, 1) > 0) s) t
WHERE draw <= 3
""")
def weighted_without_repl(spark, sf):
    part = _t(spark, sf, "part").select("p_brand", "p_partkey", "p_size")
    out = X.weighted_without_replacement(part, "p_brand", "p_partkey", "p_size", 3, seed="wor")
    return out.select("p_brand", "p_partkey", F.col("draw").cast("bigint").alias("draw"))


@query("weighted_with_repl", f"""
WITH items AS (
  SELECT p_brand, p_partkey, CAST(coalesce(p_size, 1) AS BIGINT) AS w,
         CAST(floor({_u_sql('blk', 'CAST(p_partkey AS VARCHAR)')} * 1024) AS BIGINT) AS blk
  FROM part WHERE coalesce(p_size, 1) > 0),
iv AS (
  SELECT p_brand, p_partkey,
         sum(w) OVER (PARTITION BY p_brand ORDER BY blk, p_partkey ROWS UNBOUNDED PRECEDING) - w AS lo,
         sum(w) OVER (PARTITION BY p_brand ORDER BY blk, p_partkey ROWS UNBOUNDED PRECEDING) AS hi,
         sum(w) OVER (PARTITION BY p_brand) AS total
  FROM items),
req AS (SELECT DISTINCT p_brand, total FROM iv WHERE total > 0),
draws AS (
  SELECT r.p_brand, CAST(g.draw AS INTEGER) AS draw,
         CAST(floor({_u_sql('wr', "r.p_brand || '|' || CAST(g.draw AS VARCHAR)")} * r.total) AS BIGINT) AS roll
  FROM req r, generate_series(0, 4) AS g(draw))
SELECT d.p_brand, d.draw, i.p_partkey FROM draws d JOIN iv i
  ON d.p_brand = i.p_brand AND d.roll >= i.lo AND d.roll < i.hi
""")
def weighted_with_repl(spark, sf):
    part = _t(spark, sf, "part").select("p_brand", "p_partkey", "p_size")
    req = part.select("p_brand").distinct()
    return X.weighted_with_replacement(part, req, "p_brand", "p_partkey", "p_size", 5, "p_brand", seed="wr")


def booster_tables(spark, sf):
    """A booster configuration derived from ``part``: set = part type, sheet =
    brand, card weight = size; odd brand numbers allow duplicates; two
    templates per set (weights 3 and 1; the second picks two per sheet)."""
    part = _t(spark, sf, "part")
    sheet_cards = part.select(F.upper("p_type").alias("setCode"), F.lit("draft").alias("boosterName"),
                              F.col("p_brand").alias("sheetName"), F.col("p_partkey").cast("string").alias("cardUuid"),
                              F.col("p_size").cast("bigint").alias("cardWeight"))
    sheet_keys = sheet_cards.select("setCode", "boosterName", "sheetName").distinct()
    brand_no = F.regexp_extract("sheetName", r"(\d+)$", 1).cast("int")
    sheets = sheet_keys.select("*", (brand_no % 2 == 1).alias("sheetAllowDuplicates"),
                               F.lit(False).alias("sheetIsFoil"))
    weights = sheet_keys.select("setCode", "boosterName").distinct() \
        .select("*", F.explode(F.array(F.struct(F.lit(0).cast("bigint").alias("i"), F.lit(3).cast("bigint").alias("w")),
                                       F.struct(F.lit(1).cast("bigint").alias("i"), F.lit(1).cast("bigint").alias("w"))))
                .alias("t")) \
        .select("setCode", "boosterName", F.col("t.i").alias("boosterIndex"), F.col("t.w").alias("boosterWeight"))
    contents = sheet_keys.select("*", F.explode(F.array(F.lit(0).cast("bigint"), F.lit(1).cast("bigint")))
                                 .alias("boosterIndex")) \
        .select("setCode", "boosterName", "boosterIndex", "sheetName",
                (F.col("boosterIndex") + 1).cast("bigint").alias("sheetPicks"))
    return weights, contents, sheets, sheet_cards


def _u(seed, key_sql):
    return _u_sql(seed, key_sql)


# Requests that one dominant weight leaves short: rounds over what is left.
_SHORT_ROUNDS = 5


def _short_sql() -> str:
    """Round 0 rolls 2k times over everything; round i twice per missing pick
    over the weight not taken, a roll moving on by each taken interval that
    begins at or before it."""
    ctes = ["""items AS MATERIALIZED (SELECT p_brand, p_partkey,
  CASE WHEN p_partkey % 97 = 0 THEN 1000000 ELSE p_size END::BIGINT AS w,
  CAST(floor(""" + _u("blk", "CAST(p_partkey AS VARCHAR)") + """ * 1024) AS BIGINT) AS blk FROM part WHERE p_size > 0)""",
            """iv AS MATERIALIZED (SELECT p_brand, p_partkey, w,
  sum(w) OVER (PARTITION BY p_brand ORDER BY blk, p_partkey ROWS UNBOUNDED PRECEDING) - w AS lo,
  sum(w) OVER (PARTITION BY p_brand) AS total FROM items)""",
            """req AS MATERIALIZED (SELECT c_custkey, p_brand, 3 + c_custkey % 4 AS k,
  (SELECT sum(w) FROM items i WHERE i.p_brand = part.p_brand) AS total
  FROM customer JOIN part ON p_partkey = 1 + c_custkey % 200)""",
            """taken0 AS (SELECT 0 AS c_custkey, 0 AS p_partkey, 0::HUGEINT AS lo, 0::BIGINT AS w, 0 AS draw WHERE false)"""]
    for i in range(_SHORT_ROUNDS + 1):
        seed, per = (f"wq|r|{i}", "2 * (k - n)") if i else ("wq|c", "2 * k")
        u = _u(seed, "CAST(c_custkey AS VARCHAR) || '|' || CAST(d AS VARCHAR)")
        ctes += [f"""short{i} AS (SELECT r.*, coalesce(t.n, 0) AS n, r.total - coalesce(t.w, 0) AS left_w FROM req r
  LEFT JOIN (SELECT c_custkey, count(*) AS n, sum(w) AS w FROM taken{i} GROUP BY c_custkey) t USING (c_custkey)
  WHERE coalesce(t.n, 0) < k AND r.total > coalesce(t.w, 0))""",
                 f"""roll{i} AS MATERIALIZED (SELECT *, CAST(floor({u} * left_w) AS BIGINT) AS roll FROM (
  SELECT *, unnest(generate_series(0, {per} - 1)) AS d FROM short{i}))""",
                 f"""gap{i} AS (SELECT c_custkey, w, lo - coalesce(sum(w) OVER (PARTITION BY c_custkey ORDER BY lo
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS at FROM taken{i})""",
                 f"""moved{i} AS (SELECT r.c_custkey, r.p_brand, r.k, r.n, r.d, r.roll + coalesce(sum(g.w), 0) AS roll
  FROM roll{i} r LEFT JOIN gap{i} g ON g.c_custkey = r.c_custkey AND g.at <= r.roll
  GROUP BY r.c_custkey, r.p_brand, r.k, r.n, r.d, r.roll)""",
                 f"""taken{i + 1} AS MATERIALIZED (SELECT * FROM taken{i} UNION ALL
  SELECT c_custkey, p_partkey, lo, w, n + place - 1 FROM (
    SELECT m.c_custkey, v.p_partkey, v.lo, v.w, any_value(m.n) AS n, any_value(m.k) AS k,
           row_number() OVER (PARTITION BY m.c_custkey ORDER BY min(m.d)) AS place
    FROM moved{i} m JOIN iv v ON v.p_brand = m.p_brand AND m.roll >= v.lo AND m.roll < v.lo + v.w
    GROUP BY m.c_custkey, v.p_partkey, v.lo, v.w) WHERE place <= k - n)"""]
    return "WITH " + ",\n".join(ctes) + f"""
SELECT c_custkey, p_brand, CAST(draw AS INTEGER) AS draw, p_partkey
FROM taken{_SHORT_ROUNDS + 1} JOIN req USING (c_custkey)"""


@query("weighted_without_repl_requests", _short_sql())
def weighted_without_repl_requests(spark, sf):
    """Every customer draws 3 to 6 parts of a brand in which a few weights are
    so large that most requests are left short by their first rolls."""
    part = _t(spark, sf, "part").select("p_brand", "p_partkey", "p_size")
    items = part.select("p_brand", "p_partkey",
                        F.when(F.col("p_partkey") % 97 == 0, 1_000_000).otherwise(F.col("p_size")).alias("w"))
    req = (_t(spark, sf, "customer").select("c_custkey", (1 + F.col("c_custkey") % 200).alias("p_partkey"),
                                            (3 + F.col("c_custkey") % 4).alias("k"))
           .join(part.select("p_partkey", "p_brand"), "p_partkey"))
    return X.weighted_without_replacement_draws(items, req, "p_brand", "p_partkey", "w", "k", "c_custkey",
                                                seed="wq").select("c_custkey", "p_brand", "draw", "p_partkey")


@query("sample_n_large", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (
  SELECT *, row_number() OVER (ORDER BY u, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS r,
         count(*) OVER () AS n
  FROM (SELECT *, {_u_sql('large', "concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey)")} AS u
        FROM lineitem) x) t
WHERE r <= n * 3 // 5
""")
def sample_n_large(spark, sf):
    """Three fifths of all lines: far more than one task should sort."""
    lines = _t(spark, sf, "lineitem").select(*LINE_KEY)
    return X.sample_n(lines, lines.count() * 3 // 5, LINE_KEY, seed="large")


_PACK_SQL = f"""
WITH sheet_cards AS (
  SELECT upper(p_type) AS setCode, 'draft' AS boosterName, p_brand AS sheetName,
         CAST(p_partkey AS VARCHAR) AS cardUuid, CAST(p_size AS BIGINT) AS cardWeight FROM part),
sheet_keys AS (SELECT DISTINCT setCode, boosterName, sheetName FROM sheet_cards),
sheets AS (
  SELECT setCode, boosterName, sheetName,
         CAST(regexp_extract(sheetName, '(\\d+)$', 1) AS INTEGER) % 2 = 1 AS allow_dup FROM sheet_keys),
weights AS (
  SELECT k.setCode, k.boosterName, t.boosterIndex, t.boosterWeight
  FROM (SELECT DISTINCT setCode, boosterName FROM sheet_keys) k,
       (VALUES (0::BIGINT, 3::BIGINT), (1::BIGINT, 1::BIGINT)) AS t(boosterIndex, boosterWeight)
  UNION ALL
  SELECT DISTINCT setCode, 'bare', 0::BIGINT, 1::BIGINT FROM sheet_keys),
contents AS (
  SELECT s.setCode, s.boosterName, i.boosterIndex, s.sheetName, CAST(i.boosterIndex + 1 AS INTEGER) AS picks
  FROM sheet_keys s, (VALUES (0::BIGINT), (1::BIGINT)) AS i(boosterIndex)),
asked AS (
  SELECT CASE WHEN c.c_custkey % 3 = 0 THEN c.c_custkey - 1 ELSE c.c_custkey END AS request_id,
         coalesce(upper(p.p_type), 'NONE') AS setCode, 'draft' AS boosterName
  FROM customer c LEFT JOIN part p ON c.c_custkey = p.p_partkey
  UNION ALL
  SELECT c.c_custkey, upper(p.p_type), 'draft'
  FROM customer c JOIN part p ON c.c_custkey = p.p_partkey WHERE c.c_custkey % 5 = 0
  UNION ALL
  SELECT c.c_custkey, upper(p.p_type), 'bare'
  FROM customer c JOIN part p ON c.c_custkey = p.p_partkey WHERE c.c_custkey % 4 = 0),
req AS (
  SELECT *, md5(coalesce(CAST(request_id AS VARCHAR), '\\N') || '|' || setCode || '|' || boosterName || '|'
                || CAST(copy AS VARCHAR)) AS rid
  FROM (SELECT *, row_number() OVER (PARTITION BY request_id, setCode, boosterName) AS copy FROM asked) x),
totals AS (SELECT setCode, boosterName, sum(boosterWeight) AS total FROM weights GROUP BY ALL),
tpl_keys AS (
  SELECT r.rid, r.request_id, r.copy, r.setCode, r.boosterName, w.boosterIndex,
    CASE WHEN t.total > 0 THEN (CASE WHEN w.boosterWeight > 0 THEN
           -ln({_u('pack|tpl', "r.rid || '|' || CAST(w.boosterIndex AS VARCHAR)")})
           / w.boosterWeight END)
         ELSE {_u('pack|tpl', "r.rid || '|' || CAST(w.boosterIndex AS VARCHAR)")} END AS k
  FROM req r JOIN weights w USING (setCode, boosterName) JOIN totals t USING (setCode, boosterName)),
picked AS (
  SELECT rid, request_id, copy, setCode, boosterName, arg_min(boosterIndex, (k, boosterIndex)) AS boosterIndex
  FROM tpl_keys WHERE k IS NOT NULL GROUP BY ALL),
per_sheet AS (
  SELECT p.rid, p.request_id, p.copy, p.setCode, p.boosterName, p.boosterIndex, c.sheetName, c.picks,
         coalesce(s.allow_dup, false) AS allow_dup
  FROM picked p JOIN contents c USING (setCode, boosterName, boosterIndex)
  LEFT JOIN sheets s USING (setCode, boosterName, sheetName) WHERE c.picks > 0),
items AS (
  SELECT setCode, boosterName, sheetName, cardUuid, coalesce(cardWeight, 1) AS w,
         CAST(floor({_u('blk', 'cardUuid')} * 1024) AS BIGINT) AS blk
  FROM sheet_cards WHERE cardUuid IS NOT NULL AND trim(cardUuid) <> ''),
iv AS (
  SELECT setCode, boosterName, sheetName, cardUuid, w,
    sum(w) OVER (PARTITION BY setCode, boosterName, sheetName ORDER BY blk, cardUuid
                 ROWS UNBOUNDED PRECEDING) - w AS lo,
    sum(w) OVER (PARTITION BY setCode, boosterName, sheetName ORDER BY blk, cardUuid
                 ROWS UNBOUNDED PRECEDING) AS hi,
    sum(w) OVER (PARTITION BY setCode, boosterName, sheetName) AS total
  FROM items WHERE w > 0),
stats AS (SELECT DISTINCT setCode, boosterName, sheetName, total FROM iv),
draws AS (
  SELECT ps.*, CAST(g.d AS INTEGER) AS d,
    CAST(floor({_u('pack|draw', "ps.rid || '|' || ps.sheetName || '|' || CAST(g.d AS VARCHAR)")}
               * st.total) AS BIGINT) AS roll
  FROM per_sheet ps JOIN stats st USING (setCode, boosterName, sheetName),
       generate_series(0, CASE WHEN ps.allow_dup THEN ps.picks ELSE ps.picks * 2 END - 1) AS g(d)
  WHERE st.total > 0),
cand AS (
  SELECT d.rid, d.request_id, d.copy, d.setCode, d.boosterName, d.boosterIndex, d.sheetName, d.picks, d.allow_dup, d.d,
         i.cardUuid
  FROM draws d JOIN iv i ON d.setCode = i.setCode AND d.boosterName = i.boosterName
   AND d.sheetName = i.sheetName AND d.roll >= i.lo AND d.roll < i.hi),
dup AS (SELECT rid, request_id, copy, setCode, boosterName, boosterIndex, sheetName, d AS draw, cardUuid
        FROM cand WHERE allow_dup),
firsts AS (
  SELECT rid, request_id, copy, setCode, boosterName, boosterIndex, sheetName, picks, cardUuid, min(d) AS first_d
  FROM cand WHERE NOT allow_dup GROUP BY ALL),
got AS (
  SELECT *, row_number() OVER (PARTITION BY rid, sheetName ORDER BY first_d) AS r,
         count(*) OVER (PARTITION BY rid, sheetName) AS n
  FROM firsts),
phase1 AS (SELECT rid, request_id, copy, setCode, boosterName, boosterIndex, sheetName, CAST(r - 1 AS INTEGER) AS draw,
                  cardUuid FROM got WHERE r <= picks),
short AS (
  SELECT g.*, i.lo AS taken_lo, i.w AS taken_w, i.total - i.w AS left_w FROM got g JOIN iv i
    USING (setCode, boosterName, sheetName, cardUuid) WHERE g.r = 1 AND g.n < g.picks AND i.total > i.w),
again AS (
  SELECT *, CAST(floor({_u('pack|nodup|1', "rid || '|' || sheetName || '|0'")} * left_w) AS BIGINT) AS roll FROM short),
phase2 AS (
  SELECT a.rid, a.request_id, a.copy, a.setCode, a.boosterName, a.boosterIndex, a.sheetName,
         CAST(a.n AS INTEGER) AS draw, i.cardUuid
  FROM (SELECT *, CASE WHEN roll >= taken_lo THEN roll + taken_w ELSE roll END AS over_all FROM again) a
  JOIN iv i ON a.setCode = i.setCode AND a.boosterName = i.boosterName AND a.sheetName = i.sheetName
   AND a.over_all >= i.lo AND a.over_all < i.hi)
SELECT request_id, setCode, boosterName, copy, boosterIndex, sheetName, draw, cardUuid, false AS isFoil, 'ok' AS status
FROM (SELECT * FROM dup UNION ALL SELECT * FROM phase1 UNION ALL SELECT * FROM phase2) a
UNION ALL
SELECT r.request_id, r.setCode, r.boosterName, r.copy, p.boosterIndex, NULL::VARCHAR, NULL::INTEGER, NULL::VARCHAR,
       NULL::BOOLEAN, CASE WHEN p.rid IS NULL THEN 'no_template' ELSE 'empty' END
FROM req r LEFT JOIN picked p ON p.rid = r.rid WHERE r.rid NOT IN (SELECT rid FROM cand)
"""


@query("multi_stage_draw", _PACK_SQL)
def multi_stage_draw(spark, sf):
    weights, contents, sheets, sheet_cards = booster_tables(spark, sf)
    cust = _t(spark, sf, "customer").select("c_custkey")
    part = _t(spark, sf, "part").select("p_partkey", "p_type")
    # Each customer opens one pack of the set named by the part with its key
    # (customers without such a part ask for an unknown set).  Some share their
    # id with another customer, some ask twice, and some also ask for the bare
    # booster, whose template has no contents.
    key = F.col("c_custkey")
    both = cust.join(part, cust.c_custkey == part.p_partkey, "left")
    set_code = F.coalesce(F.upper("p_type"), F.lit("NONE")).alias("setCode")
    known = both.where("p_partkey IS NOT NULL")
    req = (both.select(F.when(key % 3 == 0, key - 1).otherwise(key).alias("request_id"), set_code,
                       F.lit("draft").alias("boosterName"))
           .unionByName(known.where(key % 5 == 0).select(key.alias("request_id"), set_code,
                                                         F.lit("draft").alias("boosterName")))
           .unionByName(known.where(key % 4 == 0).select(key.alias("request_id"), set_code,
                                                         F.lit("bare").alias("boosterName"))))
    bare = weights.select("setCode", F.lit("bare").alias("boosterName"), F.lit(0).cast("bigint").alias("boosterIndex"),
                          F.lit(1).cast("bigint").alias("boosterWeight")).distinct()
    weights = weights.unionByName(bare)
    return X.open_packs(req, weights, contents, sheets, sheet_cards, seed="pack")
