"""The catalogue's public methods over the generated tables.

``catalogue`` shows the tables as a catalogue: part = cards, orders = sets,
customer = tokens, lineitem = prices, and identifiers, statuses, translations
and vocabularies derived from part, nation and region.  Every query calls the
methods a user calls; the oracle spells out the same in SQL.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import joins as J
from tessera.plans.catalogue import CardData
from tessera.plans.standins import ORACLE_SQL, QUERIES, _t, query
from tessera.session import scratch_path
from tessera.sources.registry import CATALOGUE_PARQUET

_CARDS = """cards AS (SELECT CAST(p_partkey AS VARCHAR) AS uuid, p_name AS name, 'O' || (p_partkey % 1000) AS setCode,
  p_type AS type, CAST(p_size AS DOUBLE) / 4 AS manaValue, string_split(p_name, ' ') AS colors, p_brand AS artist,
  p_size % 3 = 0 AS isPromo, CASE WHEN p_retailprice > 950 THEN 'rare' ELSE 'common' END AS rarity FROM part)"""
_SETS = """sets AS (SELECT 'O' || o_orderkey AS code, 'Order of ' || CAST(o_orderdate AS DATE) AS name,
  o_orderpriority AS type, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS releaseDate, o_orderstatus AS block FROM orders)"""
_STATUS = """legal AS (SELECT CAST(p_partkey AS VARCHAR) AS uuid FROM part WHERE p_size % 5 < 3)"""
_FOREIGN = """foreign_names AS (SELECT CAST(p_partkey AS VARCHAR) AS uuid, lang, lang || ' ' || p_name AS name
  FROM part, (VALUES ('fr'), ('de')) AS v(lang))"""
_PRICES = """prices AS (SELECT CAST(l_partkey AS VARCHAR) AS uuid, CAST(l_suppkey AS VARCHAR) AS provider,
  l_linestatus AS currency, l_returnflag AS price_type, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS date,
  l_extendedprice AS price FROM lineitem)"""


def catalogue(spark, sf) -> CardData:
    part, orders, cust = (_t(spark, sf, n) for n in ("part", "orders", "customer"))
    uuid = F.col("p_partkey").cast("string").alias("uuid")
    words = F.replace("p_name", F.lit(" "), F.lit(", "))          # lists come as joined text
    cards = part.select(
        uuid, F.col("p_name").alias("name"), F.concat(F.lit("O"), F.col("p_partkey") % 1000).alias("setCode"),
        F.col("p_type").alias("type"), (F.col("p_size").cast("double") / 4).alias("manaValue"), words.alias("colors"),
        F.col("p_brand").alias("artist"), (F.col("p_size") % 3 == 0).alias("isPromo"),
        F.when(F.col("p_retailprice") > 950, "rare").otherwise("common").alias("rarity"))
    day = F.col("o_orderdate").cast("date").cast("string")
    sets = orders.select(F.concat(F.lit("O"), "o_orderkey").alias("code"), F.concat(F.lit("Order of "), day).alias("name"),
                         F.col("o_orderpriority").alias("type"), day.alias("releaseDate"),
                         F.col("o_orderstatus").alias("block"))
    tokens = cust.select(F.col("c_custkey").cast("string").alias("uuid"), F.col("c_name").alias("name"),
                         F.concat(F.lit("O"), F.col("c_nationkey")).alias("setCode"),
                         F.concat(F.lit("Token "), "c_mktsegment").alias("type"),
                         F.concat_ws(", ", "c_mktsegment", F.col("c_nationkey").cast("string")).alias("colors"),
                         F.concat(F.lit("artist "), F.col("c_nationkey") % 7).alias("artist"))
    ids = part.select(uuid, F.concat(F.lit("s-"), F.col("p_partkey") % 500).alias("scryfallId"),
                      F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("m-"), "p_size")).alias("mcmId"),
                      F.col("p_retailprice").cast("long").alias("mtgoId"))
    status = F.when(F.col("p_size") % 5 < 3, "Legal").otherwise("Banned")
    legalities = part.select(uuid, status.alias("modern"), F.lit(None).cast("string").alias("duel"))
    foreign = part.select(uuid, F.explode(F.array(F.lit("fr"), F.lit("de"))).alias("language"),
                          F.col("p_name").alias("_n")).select("uuid", "language",
                                                              F.concat_ws(" ", "language", "_n").alias("name"))
    prices = _t(spark, sf, "lineitem").select(
        F.col("l_partkey").cast("string").alias("uuid"), F.lit("paper").alias("source"),
        F.col("l_suppkey").cast("string").alias("provider"), F.col("l_linestatus").alias("currency"),
        F.col("l_returnflag").alias("price_type"), F.lit("normal").alias("finish"),
        F.col("l_shipdate").cast("date").cast("string").alias("date"), F.col("l_extendedprice").alias("price"))
    nations = (_t(spark, sf, "nation").join(_t(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
               .groupBy("r_name").agg(F.sort_array(F.collect_list("n_name")).alias("n"))
               .agg(F.map_from_entries(F.collect_list(F.struct("r_name", "n"))).alias("data")))
    kinds = (part.groupBy("p_type").agg(F.struct(F.sort_array(F.collect_set("p_name")).alias("subTypes"),
                                                 F.sort_array(F.collect_set("p_brand")).alias("superTypes")).alias("k"))
             .agg(F.map_from_entries(F.collect_list(F.struct("p_type", "k"))).alias("data")))
    return CardData(spark, overrides={
        "cards": cards, "sets": sets, "tokens": tokens, "card_identifiers": ids, "card_legalities": legalities,
        "card_foreign_data": foreign, "all_prices_today": prices, "keywords": nations, "card_types": kinds})


def _tagged(found: dict[str, DataFrame], *cols: str) -> DataFrame:
    parts = [df.select(F.lit(name).alias("search"), *cols) for name, df in found.items()]
    return reduce(DataFrame.unionByName, parts)


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


@query("cards_search", _with(_CARDS, _SETS, _STATUS, _FOREIGN) + """
SELECT 'bounds' AS search, uuid, name, manaValue FROM cards WHERE manaValue >= 2.5 AND manaValue <= 7.75
  AND name LIKE 'r%' AND uuid IN (SELECT uuid FROM legal)
UNION ALL SELECT 'lists', uuid, name, manaValue FROM cards c WHERE list_contains(colors, 'red')
  AND list_contains(colors, 'widget') AND isPromo AND EXISTS (SELECT 1 FROM sets s WHERE s.code = c.setCode AND s.type = '5-LOW')
UNION ALL SELECT 'localized', c.uuid, c.name, manaValue FROM cards c JOIN foreign_names f ON f.uuid = c.uuid
  WHERE lower(f.name) LIKE '%fr blue%' AND rarity = 'common' AND lower(type) LIKE '%econ%'
UNION ALL SELECT 'fuzzy', uuid, name, manaValue FROM cards WHERE jaro_winkler_similarity(name, 'gren nut') > 0.9
  AND lower(artist) LIKE '%brand#1%'
UNION ALL SELECT 'none', uuid, name, manaValue FROM cards WHERE FALSE
UNION ALL SELECT * FROM (SELECT 'page', uuid, name, manaValue FROM cards WHERE manaValue = 3.25 ORDER BY uuid LIMIT 7 OFFSET 5)
""")
def cards_search(spark, sf):
    """The filters in five combinations over all cards, and a page."""
    search = catalogue(spark, sf).cards.search
    return _tagged({
        "bounds": search(name="r%", mana_value_gte=2.5, mana_value_lte=7.75, legal_in="modern", limit=None),
        "lists": search(colors=["red", "widget"], is_promo=True, set_type="5-LOW", limit=None),
        "localized": search(localized_name="fr blue", rarity="common", types="econ", limit=None),
        "fuzzy": search(fuzzy_name="gren nut", fuzzy_threshold=0.9, artist="brand#1", limit=None),
        "none": search(legal_in="duel", limit=None),
        "page": search(mana_value=3.25, limit=7, offset=5)}, "uuid", "name", "manaValue")


@query("float_bounds", _with(_CARDS) + """
SELECT 'eq' AS search, uuid, manaValue FROM cards WHERE manaValue = 1.75
UNION ALL SELECT 'lte', uuid, manaValue FROM cards WHERE manaValue <= 1.6
UNION ALL SELECT 'gte', uuid, manaValue FROM cards WHERE manaValue >= 11.125
UNION ALL SELECT 'between', uuid, manaValue FROM cards WHERE manaValue >= 5 AND manaValue <= 5.5
""")
def float_bounds(spark, sf):
    """Bounds and equality given as floats, whole ones as ints too."""
    search = catalogue(spark, sf).cards.search
    return _tagged({"eq": search(mana_value=1.75, limit=None), "lte": search(mana_value_lte=1.6, limit=None),
                    "gte": search(mana_value_gte=11.125, limit=None),
                    "between": search(mana_value_gte=5, mana_value_lte=5.5, limit=None)}, "uuid", "manaValue")


@query("tokens_and_sets_search", _with(_SETS, """tokens AS (SELECT CAST(c_custkey AS VARCHAR) AS uuid, c_name AS name,
  c_nationkey, c_mktsegment, 'artist ' || (c_nationkey % 7) AS artist FROM customer)""") + """
SELECT 'tokens' AS search, uuid AS key, name FROM tokens WHERE c_mktsegment = 'BUILDING' AND artist LIKE '%t 3%'
UNION ALL SELECT 'exact', uuid, name FROM tokens WHERE name = 'Customer#000000007'
UNION ALL SELECT 'like', uuid, name FROM tokens WHERE lower(name) LIKE '%#00000001_' AND 'O' || c_nationkey = 'O11'
UNION ALL SELECT 'sets', code, name FROM sets WHERE type = '1-URGENT' AND releaseDate >= '1997-01-01' AND releaseDate < '1998-01-01'
  AND block = 'O'
UNION ALL SELECT * FROM (SELECT 'newest', code, name FROM sets WHERE lower(name) LIKE '%order of 1996%'
  ORDER BY releaseDate DESC, code LIMIT 50 OFFSET 20)
""")
def tokens_and_sets_search(spark, sf):
    """P25."""
    cd = catalogue(spark, sf)
    key = F.col("code").alias("key")
    tokens = {"tokens": cd.tokens.search(types="token building", colors=["BUILDING"], artist="t 3", limit=None),
              "exact": cd.tokens.search(name="Customer#000000007", limit=None),
              "like": cd.tokens.search(name="%#00000001_", set_code="O11", limit=None)}
    sets = {"sets": cd.sets.search(set_type="1-URGENT", release_year=1997, block="O", limit=None),
            "newest": cd.sets.search(name="order of 1996", limit=50, offset=20)}
    return _tagged(tokens, F.col("uuid").alias("key"), "name").unionByName(_tagged(sets, key, "name"))


@query("find_by_identifier", """
WITH cards AS (SELECT CAST(p_partkey AS VARCHAR) AS uuid, * FROM part)
SELECT 'scryfallId' AS search, uuid, p_name AS name FROM cards WHERE p_partkey % 500 = 17
UNION ALL SELECT 'mcmId', uuid, p_name FROM cards WHERE p_size = 24
UNION ALL SELECT 'mtgoId', uuid, p_name FROM cards WHERE CAST(trunc(p_retailprice) AS BIGINT) = 905
UNION ALL SELECT 'refused', uuid, p_name FROM cards WHERE FALSE
""")
def find_by_identifier(spark, sf):
    """P23 + J2: identifier columns on the allow-list; another is refused."""
    ids = catalogue(spark, sf).identifiers
    found = {"scryfallId": ids.find_by("scryfallId", "s-17"), "mcmId": ids.find_by_mcm_id("m-24"),
             "mtgoId": ids.find_by("mtgoId", "905")}
    try:
        found["refused"] = ids.find_by("p_size", 1)
    except ValueError:
        pass
    return _tagged(found, "uuid", "name")


@query("price_methods", _with(_CARDS, _PRICES) + """
SELECT 'cheapest' AS search, name AS key, uuid, price FROM (
  SELECT name, uuid, price, row_number() OVER (PARTITION BY name ORDER BY price, uuid, date DESC) AS r
  FROM cards JOIN prices USING (uuid) WHERE currency = 'F') WHERE r <= 2
UNION ALL SELECT 'dearest', name, uuid, price FROM (
  SELECT name, uuid, price FROM cards JOIN prices USING (uuid) WHERE name = 'red widget'
  ORDER BY price DESC, uuid, date DESC LIMIT 4)
UNION ALL SELECT 'total', setCode, CAST(count(DISTINCT uuid) AS VARCHAR), round(sum(price), 2)
  FROM cards JOIN prices USING (uuid) GROUP BY setCode
""")
def price_methods(spark, sf):
    """J6 as the price methods use it."""
    cd = catalogue(spark, sf)
    rows = {"cheapest": cd.prices.cheapest_printings_all(2, currency="F"),
            "dearest": cd.prices.most_expensive_printings("red widget", 4)}
    total = cd.sets.get_financial_summary(money_scale=2)
    return _tagged(rows, F.col("name").alias("key"), "uuid", "price").unionByName(total.select(
        F.lit("total").alias("search"), F.col("setCode").alias("key"), F.col("card_count").cast("string").alias("uuid"),
        F.round("total_value", 2).alias("price")))


@query("sql_join", _with(_CARDS, _SETS, _PRICES) + """
SELECT s.type, c.rarity, count(*) AS n, min(p.price) AS lowest FROM cards c
JOIN sets s ON s.code = c.setCode JOIN prices p ON p.uuid = c.uuid
WHERE p.price_type = 'R' AND c.manaValue > 1.5 GROUP BY s.type, c.rarity
""")
def sql_join(spark, sf):
    """A user's own join over registered views, with bound values."""
    return catalogue(spark, sf).sql("""
        SELECT s.type, c.rarity, count(*) AS n, min(p.price) AS lowest FROM cards c
        JOIN sets s ON s.code = c.setCode JOIN all_prices_today p ON p.uuid = c.uuid
        WHERE p.price_type = :kind AND c.manaValue > :least GROUP BY s.type, c.rarity""",
                                    {"kind": "R", "least": 1.5}, views=["cards", "sets", "all_prices_today"])


@query("generic_join", """
SELECT 'left' AS how, c_custkey AS key, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON c_custkey = o_custkey
  AND o_totalprice > 150000 GROUP BY c_custkey
UNION ALL SELECT 'anti', c_custkey, 0 FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
UNION ALL SELECT 'inner', o_orderkey, count(*) FROM orders JOIN lineitem ON o_orderkey = l_orderkey
  AND l_shipdate > o_orderdate GROUP BY o_orderkey
""")
def generic_join(spark, sf):
    """Any condition, any kind, one after the other."""
    cust, orders, lines = (_t(spark, sf, n) for n in ("customer", "orders", "lineitem"))
    dear = F.col("o_totalprice") > 150000
    left = (J.join(cust, orders, (F.col("c_custkey") == F.col("o_custkey")) & dear, "left", by=("c_custkey", "o_custkey"))
            .groupBy(F.col("c_custkey").alias("key")).agg(F.count("o_orderkey").alias("n")))
    anti = J.join(cust, orders, F.col("c_custkey") == F.col("o_custkey"), "left_anti",
                  by=("c_custkey", "o_custkey")).select(
        F.col("c_custkey").alias("key"), F.lit(0).cast("bigint").alias("n"))
    inner = (J.join(orders, lines, (F.col("o_orderkey") == F.col("l_orderkey")) & (F.col("l_shipdate") > F.col("o_orderdate")),
                    by=("o_orderkey", "l_orderkey"))
             .groupBy(F.col("o_orderkey").alias("key")).agg(F.count("*").alias("n")))
    parts = [df.select(F.lit(how).alias("how"), "key", "n") for how, df in (("left", left), ("anti", anti), ("inner", inner))]
    return reduce(DataFrame.unionByName, parts)


@query("vocabularies", """
SELECT 'keyword' AS kind, r_name AS category, n_name AS value FROM nation JOIN region ON n_regionkey = r_regionkey
UNION ALL SELECT DISTINCT 'subTypes', p_type, p_name FROM part
UNION ALL SELECT DISTINCT 'superTypes', p_type, p_brand FROM part
""")
def vocabularies(spark, sf):
    """Vocabulary documents as rows."""
    enums = catalogue(spark, sf).enums
    return enums.keywords().select(F.lit("keyword").alias("kind"), "category", "value").unionByName(
        enums.card_types().select("kind", F.col("type").alias("category"), "value"))


@query("registered_views", """
SELECT 'before' AS state, 'cards' AS view, (SELECT count(*) FROM part) AS n
UNION ALL SELECT 'before', 'sets', (SELECT count(*) FROM orders)
UNION ALL SELECT 'again', 'sets', (SELECT count(*) FROM orders WHERE o_orderstatus = 'O')
""")
def registered_views(spark, sf):
    """S2 + S10: a data root's files by their published names, listed, reset
    and registered again after a file was written anew; an unknown name fails."""
    source = catalogue(spark, sf)
    root = scratch_path(spark, "catalogue-root")
    for name in ("cards", "sets"):
        source.catalog.overrides[name].write.parquet(f"{root}/{CATALOGUE_PARQUET[name]}")
    cd = CardData(spark, root=root)
    cd.catalog.ensure_views(["cards", "sets"])

    def counted(state: str) -> list[DataFrame]:
        return [spark.table(v).agg(F.count("*").alias("n")).select(F.lit(state).alias("state"), F.lit(v).alias("view"), "n")
                for v in cd.views()]

    # Counted now, as the files change below.
    before = [spark.createDataFrame(df.collect(), df.schema) for df in counted("before")]
    cd.reset_views()
    source.catalog.overrides["sets"].where("block = 'O'").write.mode("overwrite").parquet(f"{root}/{CATALOGUE_PARQUET['sets']}")
    cd.catalog.ensure_view("sets")
    try:
        cd.catalog.ensure_view("no such dataset")
    except KeyError:
        return reduce(DataFrame.unionByName, before + counted("again"))
    raise AssertionError("an unknown dataset was accepted")


__all__ = ["ORACLE_SQL", "QUERIES", "catalogue"]
