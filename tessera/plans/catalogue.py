"""The catalogue's public query surface as compositions of tessera operators.

``CardData`` is the client: views are registered lazily from a data root (or
from DataFrames given as overrides) and every method returns a DataFrame.
Keyed methods have bulk forms (``*_all`` / key-DataFrame arguments) that
answer every key in one job instead of one query per key.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import predicates as P
from tessera.functions.fuzzy import check_threshold, fuzzy_filter
from tessera.operators import aggregates as A
from tessera.operators import joins as J
from tessera.operators import nested as N
from tessera.operators import sampling as X
from tessera.operators import topk as K
from tessera.sources.files import ingest_ndjson
from tessera.sources.registry import Catalog
from tessera.sources.sql import scalar, sql

# Identifier columns of the card identifier table that may be
# searched.
KNOWN_ID_COLUMNS = [
    "cardKingdomEtchedId", "cardKingdomFoilId", "cardKingdomId", "cardsphereId",
    "cardsphereFoilId", "mcmId", "mcmMetaId", "mtgArenaId", "mtgjsonFoilVersionId",
    "mtgjsonNonFoilVersionId", "mtgjsonV4Id", "mtgoFoilId", "mtgoId", "multiverseId",
    "scryfallId", "scryfallCardBackId", "scryfallIllustrationId", "scryfallOracleId",
    "tcgplayerEtchedProductId", "tcgplayerProductId",
]

# Legality statuses.
STATUSES = {"legal": "Legal", "banned": "Banned", "restricted": "Restricted",
            "suspended": "Suspended", "not_legal": "Not Legal"}

PRICE_COLS = ("price", "source", "provider", "finish", "date")
#: Ends every price order, so that rows that tie are alike in all columns returned.
PRICE_TIES = ("provider asc", "source asc", "finish asc")
PRICE_FILTERS = ("source", "provider", "currency", "price_type", "finish")


def _price_rows(prices: DataFrame, filters: dict) -> DataFrame:
    """Price rows narrowed by optional equality filters on their dimensions."""
    for k in filters:
        if k not in PRICE_FILTERS:
            raise ValueError(f"unknown price filter {k!r}; expected one of {PRICE_FILTERS}")
    return P.apply_filters(prices, *[P.eq(k, v) for k, v in filters.items() if v is not None])


def _typed_eq(df: DataFrame, column: str, value) -> Column:
    """Equality with the literal cast to the column's type (string inputs
    are accepted for numeric columns, since callers often pass ids as text)."""
    dt = df.schema[column].dataType
    return F.col(column) == F.lit(value).cast(dt)


def _finder_name(column: str) -> str:
    """camelCase column -> snake_case method suffix (scryfallId -> scryfall_id)."""
    return re.sub(r"(?<=[a-z0-9])([A-Z])", r"_\1", column).lower()


class _Part:
    def __init__(self, client: "CardData"):
        self.c = client

    def t(self, name: str) -> DataFrame:
        return self.c.catalog.ensure_view(name)


class Cards(_Part):
    def get_by_uuid(self, uuid: str) -> DataFrame:
        return K.point_lookup(self.t("cards"), "uuid", uuid)

    def get_by_uuids(self, uuids) -> DataFrame:
        cards = self.t("cards")
        if isinstance(uuids, DataFrame):
            return P.semi_filter(cards, "uuid", uuids)
        return cards.where(P.isin("uuid", uuids))

    def get_by_name(self, name: str, set_code: str | None = None) -> DataFrame:
        return P.apply_filters(self.t("cards"), P.eq("name", name),
                               None if set_code is None else P.eq("setCode", set_code))

    def get_printings(self, name: str) -> DataFrame:
        return self.get_by_name(name)

    def get_atomic(self, name) -> DataFrame:
        """DISTINCT ON (name, faceName) of the cards named ``name``, or, when
        none is, of those whose faceName is ``name``.  ``name`` may be a
        DataFrame of names (column ``name``): all answered in one job."""
        cards = self.t("cards")
        if isinstance(name, DataFrame):
            req = name.select(F.col(name.columns[0]).alias("_request"))
            return A.distinct_on_with_fallback(req, cards, "_request", "name", "faceName",
                                               ["name", "faceName"], ["uuid"])
        # One name: both equalities reach the scan.  The window covers one row
        # per (name, faceName) pair of that name.
        hits = cards.where(P.eq("name", name) | P.eq("faceName", name)) \
            .withColumn("_prio", F.when(P.eq("name", name), 1).otherwise(2))
        best = A.distinct_on(hits, ["name", "faceName"], ["_prio", "uuid"])
        least = F.min("_prio").over(Window.partitionBy(F.lit(1)))
        return best.withColumn("_least", least).where("_prio = _least").drop("_prio", "_least")

    def find_by_scryfall_id(self, scryfall_id: str) -> DataFrame:
        return self.c.identifiers.find_by("scryfallId", scryfall_id)

    def random(self, n: int, seed: str = "random") -> DataFrame:
        return X.sample_n(self.t("cards"), n, "uuid", seed=seed)

    def count(self, filters: dict | None = None) -> DataFrame:
        return A.count_rows(self.t("cards"), filters=filters, alias="cnt")

    def search(self, name=None, fuzzy_name=None, localized_name=None, set_code=None, colors=None,
               color_identity=None, types=None, rarity=None, legal_in=None, mana_value=None,
               mana_value_lte=None, mana_value_gte=None, text=None, text_regex=None, power=None,
               toughness=None, artist=None, keyword=None, is_promo=None, availability=None,
               language=None, layout=None, set_type=None, limit: int | None = 100,
               offset: int = 0, fuzzy_threshold: float = 0.8,
               localized_dedupe: bool = False) -> DataFrame:
        """Conjunctive search (P24): every given filter narrows the result;
        joins appear only when their filter is set.  Ordered by similarity
        (fuzzy searches) then uuid, then paged."""
        cards = self.t("cards")
        conds = [
            None if name is None else P.exact_or_like("name", name),
            None if set_code is None else P.eq("setCode", set_code),
            None if colors is None else P.contains_all("colors", colors),
            None if color_identity is None else P.contains_all("colorIdentity", color_identity),
            None if types is None else P.contains_ci("type", types),
            None if rarity is None else P.eq("rarity", rarity),
            None if mana_value is None else P.eq("manaValue", float(mana_value)),
            None if mana_value_lte is None else P.lte("manaValue", float(mana_value_lte)),
            None if mana_value_gte is None else P.gte("manaValue", float(mana_value_gte)),
            None if text is None else P.contains_ci("text", text),
            None if text_regex is None else P.regex("text", text_regex),
            None if power is None else P.eq("power", power),
            None if toughness is None else P.eq("toughness", toughness),
            None if artist is None else P.contains_ci("artist", artist),
            None if keyword is None else P.contains_all("keywords", [keyword]),
            None if is_promo is None else P.bool_eq("isPromo", is_promo),
            None if availability is None else P.contains_all("availability", [availability]),
            None if language is None else P.eq("language", language),
            None if layout is None else P.eq("layout", layout),
        ]
        out = P.apply_filters(cards, *conds)
        if legal_in is not None:
            out = J.join_status(out, self.t("card_legalities"), legal_in, "Legal")
        if set_type is not None:
            sets = self.t("sets").where(P.eq("type", set_type)).select(F.col("code").alias("setCode"))
            out = out.join(sets, "setCode", "left_semi")
        if localized_name is not None:
            # Default: one row per matching translation (a card matching in two
            # languages appears twice); localized_dedupe=True keeps one row.
            out = J.join_translations(out, self.t("card_foreign_data"), localized_name, dedupe=localized_dedupe)
            out = out.drop("foreign_name") if "foreign_name" in out.columns else out
        order = ["uuid asc"]
        if fuzzy_name is not None:
            check_threshold(fuzzy_threshold)
            out = fuzzy_filter(out, "name", fuzzy_name, fuzzy_threshold, score_col="_similarity")
            order = ["_similarity desc"] + order
        res = K.page(out, order, limit=limit, offset=offset)
        return res.drop("_similarity") if fuzzy_name is not None else res


class Tokens(_Part):
    def get_by_uuid(self, uuid: str) -> DataFrame:
        return K.point_lookup(self.t("tokens"), "uuid", uuid)

    def get_by_uuids(self, uuids) -> DataFrame:
        tokens = self.t("tokens")
        if isinstance(uuids, DataFrame):
            return P.semi_filter(tokens, "uuid", uuids)
        return tokens.where(P.isin("uuid", uuids))

    def get_by_name(self, name: str, set_code: str | None = None) -> DataFrame:
        return P.apply_filters(self.t("tokens"), P.eq("name", name),
                               None if set_code is None else P.eq("setCode", set_code))

    def search(self, name=None, set_code=None, colors=None, types=None, artist=None,
               limit: int = 100, offset: int = 0) -> DataFrame:
        out = P.apply_filters(
            self.t("tokens"),
            None if name is None else P.exact_or_like("name", name),
            None if set_code is None else P.eq("setCode", set_code),
            None if colors is None else P.contains_all("colors", colors),
            None if types is None else P.contains_ci("type", types),
            None if artist is None else P.contains_ci("artist", artist))
        return K.page(out, ["uuid asc"], limit=limit, offset=offset)

    def for_set(self, set_code: str) -> DataFrame:
        return self.t("tokens").where(P.eq("setCode", set_code))

    def count(self, filters: dict | None = None) -> DataFrame:
        return A.count_rows(self.t("tokens"), filters=filters, alias="cnt")


class Sets(_Part):
    def get(self, code: str) -> DataFrame:
        return K.point_lookup(self.t("sets"), "code", P.upper_key(code))

    def _year(self, sets: DataFrame, year: int) -> Column:
        # Range on the stored value, so the predicate pushes down: ISO text
        # compares like the date it spells.
        if isinstance(sets.schema["releaseDate"].dataType, T.StringType):
            return (F.col("releaseDate") >= F.lit(f"{int(year):04d}-01-01")) & \
                   (F.col("releaseDate") < F.lit(f"{int(year) + 1:04d}-01-01"))
        return P.year_eq("releaseDate", year)

    def list(self, set_type=None, name=None, limit=None, offset=None) -> DataFrame:
        out = P.apply_filters(self.t("sets"),
                              None if set_type is None else P.eq("type", set_type),
                              None if name is None else P.contains_ci("name", name))
        order = ["releaseDate desc", "code asc"]
        if limit is None and not offset:
            return K.order_by(out, *order)
        if limit is None:
            return K.order_by(out, *order).offset(int(offset))
        return K.page(out, order, limit=limit, offset=offset or 0)

    def search(self, name=None, set_type=None, block=None, release_year=None,
               limit: int = 100, offset: int = 0) -> DataFrame:
        sets = self.t("sets")
        out = P.apply_filters(sets,
                              None if name is None else P.contains_ci("name", name),
                              None if set_type is None else P.eq("type", set_type),
                              None if block is None else P.eq("block", block),
                              None if release_year is None else self._year(sets, release_year))
        return K.page(out, ["releaseDate desc", "code asc"], limit=limit, offset=offset)

    def get_financial_summary(self, set_code: str | None = None, money_scale: int | None = None,
                              **price_filters) -> DataFrame:
        """card_count, total/avg/min/max value and latest date of a set's
        priced printings; ``set_code=None`` answers every set (one row each).
        Optional ``currency=``/``price_type=``/``finish=``/``provider=`` keep
        the sums within one kind of price."""
        cards = self.t("cards").select("uuid", "setCode")
        if set_code is not None:
            cards = cards.where(P.eq("setCode", P.upper_key(set_code)))
        joined = J.join_prices(cards, _price_rows(self.t("all_prices_today"), price_filters))
        return A.financial_summary(joined, group=None if set_code is not None else "setCode",
                                   money_scale=money_scale)

    def count(self, set_type: str | None = None) -> DataFrame:
        return A.count_rows(self.t("sets"), None if set_type is None else P.eq("type", set_type), alias="cnt")


class Identifiers(_Part):
    def find_by(self, column: str, value) -> DataFrame:
        P.validate_column(column, KNOWN_ID_COLUMNS)
        ids = self.t("card_identifiers")
        if column not in ids.columns:
            raise ValueError(f"identifier column {column!r} not present in the data")
        hits = ids.where(_typed_eq(ids, column, value)).select("uuid")
        return self.t("cards").join(hits, "uuid", "left_semi")

    def resolve(self, lookups: DataFrame) -> DataFrame:
        """Bulk: ``(id_type, id_value)`` rows -> matching cards (tagged)."""
        ids = self.t("card_identifiers")
        cols = [c for c in KNOWN_ID_COLUMNS if c in ids.columns]
        return J.resolve_identifiers(self.t("cards"), ids, lookups, key="uuid", columns=cols)

    def get_identifiers(self, uuid: str) -> DataFrame:
        return K.point_lookup(self.t("card_identifiers"), "uuid", uuid)


def _make_finder(column: str):
    def finder(self, value):
        return self.find_by(column, value)
    finder.__name__ = f"find_by_{_finder_name(column)}"
    finder.__doc__ = f"Cards whose {column} equals ``value``."
    return finder


for _col in KNOWN_ID_COLUMNS:
    setattr(Identifiers, f"find_by_{_finder_name(_col)}", _make_finder(_col))


class Legalities(_Part):
    def formats_for_card(self, uuid: str) -> DataFrame:
        return self.t("card_legalities").where(P.eq("uuid", uuid))

    def is_legal(self, uuid: str, fmt: str) -> DataFrame:
        """One row, ``is_legal`` boolean (``.first()[0]`` at the edge)."""
        hits = self.t("card_legalities").where(P.eq("uuid", uuid) & P.eq("format", fmt) & P.eq("status", "Legal"))
        return hits.agg((F.count(F.lit(1)) > 0).alias("is_legal"))

    def is_legal_all(self, requests: DataFrame) -> DataFrame:
        """Bulk A5: ``(uuid, format)`` request rows with an ``is_legal`` flag."""
        return A.exists_flag(requests, self.t("card_legalities"), ["uuid", "format"],
                             cond=P.eq("status", "Legal"), flag="is_legal")

    def with_status(self, fmt: str, status: str) -> DataFrame:
        return J.join_status(self.t("cards"), self.t("card_legalities"), fmt, status)

    def legal_in(self, fmt: str) -> DataFrame:
        return self.with_status(fmt, STATUSES["legal"])

    def banned_in(self, fmt: str) -> DataFrame:
        return self.with_status(fmt, STATUSES["banned"])

    def restricted_in(self, fmt: str) -> DataFrame:
        return self.with_status(fmt, STATUSES["restricted"])

    def suspended_in(self, fmt: str) -> DataFrame:
        return self.with_status(fmt, STATUSES["suspended"])

    def not_legal_in(self, fmt: str) -> DataFrame:
        return self.with_status(fmt, STATUSES["not_legal"])


class Prices(_Part):
    LEVELS = ["source", "provider", "currency", "price_type", "finish"]

    def get(self, uuid: str | None = None, as_json: bool = False, split_levels: int = 0) -> DataFrame:
        """Nested ``source -> provider -> currency -> price_type -> finish ->
        {date: price}`` map per uuid (``uuid=None``: every card).
        ``as_json`` renders it as JSON text (keys in sorted order);
        ``split_levels=k`` returns one row per (uuid, first k levels) instead,
        the bulk form that keeps rows bounded when one card has huge history."""
        rows = self.t("all_prices_today")
        if uuid is not None:
            rows = rows.where(P.eq("uuid", uuid))
        rows = rows.withColumn("date", F.col("date").cast("string"))
        out = A.nested_map(rows, ["uuid"], self.LEVELS, "date", "price", out="prices",
                           split_levels=split_levels)
        return out.withColumn("prices", F.to_json("prices")) if as_json else out

    def today(self, uuid: str | None = None, per=None) -> DataFrame:
        """Rows at the card's latest date (``per``: latest per those columns,
        the documented variant)."""
        rows = self.t("all_prices_today")
        if uuid is not None:
            rows = rows.where(P.eq("uuid", uuid))
        return J.latest_rows(rows, "uuid", "date", per=per)

    def history(self, uuid: str, date_from=None, date_to=None) -> DataFrame:
        rows = self.t("all_prices")
        dt = rows.schema["date"].dataType
        if isinstance(dt, T.StringType):
            rng = P.between("date", date_from, date_to)
        else:
            rng = P.date_range("date", date_from, date_to)
        return K.order_by(P.apply_filters(rows, P.eq("uuid", uuid), rng), "date asc",
                          *[f"{x} asc" for x in rows.columns if x not in ("uuid", "date")])

    def price_trend(self, uuid: str | None = None, money_scale: int | None = None) -> DataFrame:
        rows = self.t("all_prices")
        if uuid is None:
            return A.price_trend(rows, key="uuid", money_scale=money_scale)
        return A.price_trend(rows, where=P.eq("uuid", uuid), money_scale=money_scale)

    def _joined(self, name: str | None, **price_filters) -> DataFrame:
        """Cards ⋈ today's prices.  By default all currencies, buylist and
        retail and all finishes are mixed (as the catalogue's own methods do);
        ``provider=``, ``currency=``, ``price_type=``, ``finish=`` narrow the
        price rows first (pushed to their scan)."""
        cards = self.t("cards")
        if name is not None:
            cards = cards.where(P.eq("name", name))
        return J.join_prices(cards, _price_rows(self.t("all_prices_today"), price_filters), price_cols=PRICE_COLS)

    def cheapest_printing(self, name: str, **price_filters) -> DataFrame:
        return self.cheapest_printings(name, 1, **price_filters)

    def cheapest_printings(self, name: str, limit: int = 10, **price_filters) -> DataFrame:
        return K.top_n(self._joined(name, **price_filters), ["price asc", "uuid asc", "date desc", *PRICE_TIES],
                       limit)

    def most_expensive_printings(self, name: str, limit: int = 10, **price_filters) -> DataFrame:
        return K.top_n(self._joined(name, **price_filters), ["price desc", "uuid asc", "date desc", *PRICE_TIES],
                       limit)

    def cheapest_printings_all(self, limit: int = 1, **price_filters) -> DataFrame:
        """Bulk K4: the ``limit`` cheapest printings of every name."""
        return K.top_n_per_group(self._joined(None, **price_filters), "name",
                                 ["price asc", "uuid asc", "date desc", *PRICE_TIES], limit)


class Decks(_Part):
    def _decks(self) -> DataFrame:
        return self.t("deck_list")

    def list(self, set_code=None, deck_type=None) -> DataFrame:
        eq = {}
        if set_code is not None:
            eq["code"] = set_code
        if deck_type is not None:
            eq["type"] = deck_type
        return N.filter_documents(self._decks(), equals_ci=eq)

    def search(self, name: str, set_code=None) -> DataFrame:
        return N.filter_documents(self._decks(), equals_ci=None if set_code is None else {"code": set_code},
                                  contains={"name": name})

    def count(self, set_code=None, deck_type=None) -> DataFrame:
        return A.count_rows(self.list(set_code, deck_type), alias="cnt")


# ``contents`` stays JSON text (it nests without bound).
SEALED_ELEMENT = ("struct<uuid:string,name:string,category:string,subtype:string,language:string,"
                  "releaseDate:string,cardCount:long,productSize:long,contents:string,"
                  "identifiers:map<string,string>,purchaseUrls:map<string,string>>")


class Sealed(_Part):
    def list(self, set_code: str | None = None) -> DataFrame:
        sets = self.t("sets")
        if "sealedProduct" not in sets.columns:
            return N.explode_tagged(sets, "sealedProduct", {"code": "setCode", "name": "setName"},
                                    element_schema=SEALED_ELEMENT, require_present=False)
        if set_code is not None:
            sets = sets.where(P.eq("code", P.upper_key(set_code)))
        sets = sets.where(P.not_null("sealedProduct"))
        is_text = isinstance(sets.schema["sealedProduct"].dataType, T.StringType)
        return N.explode_tagged(sets, "sealedProduct", {"code": "setCode", "name": "setName"},
                                element_schema=SEALED_ELEMENT if is_text else None)

    def get(self, set_code: str) -> DataFrame:
        return self.list(set_code)


class Skus(_Part):
    def _by(self, column: str, value) -> DataFrame:
        skus = self.t("tcgplayer_skus")
        return skus.where(_typed_eq(skus, column, value))

    def get(self, uuid: str) -> DataFrame:
        return self._by("uuid", uuid)

    def find_by_sku_id(self, sku_id) -> DataFrame:
        return self._by("skuId", sku_id)

    def find_by_product_id(self, product_id) -> DataFrame:
        return self._by("productId", product_id)


class Enums(_Part):
    def _doc(self, name: str) -> DataFrame:
        from tessera.sources.files import read_json_documents
        given = self.c.catalog.overrides.get(name)
        if isinstance(given, DataFrame):
            return given
        return read_json_documents(self.c.spark, given or self.c.catalog.path_of(name), envelope=None)

    def keywords(self) -> DataFrame:
        return N.explode_vocabulary(self._doc("keywords"), "data", "category", "value")

    def card_types(self) -> DataFrame:
        return N.explode_type_vocabulary(self._doc("card_types"), "data")

    def enum_values(self) -> DataFrame:
        """(dataset, field, value) rows."""
        return N.explode_type_vocabulary(self._doc("enum_values"), "data").toDF("dataset", "field", "value")


class Booster(_Part):
    def available_types(self, set_code: str) -> DataFrame:
        w = self.t("set_booster_content_weights").where(P.eq("setCode", P.upper_key(set_code)))
        return A.distinct_sorted(w, "boosterName")

    def sheet_contents(self, set_code: str, booster_type: str, sheet_name: str | None = None) -> DataFrame:
        sc = self.t("set_booster_sheet_cards").where(
            P.eq("setCode", P.upper_key(set_code)) & P.eq("boosterName", booster_type))
        if sheet_name is not None:
            sc = sc.where(P.eq("sheetName", sheet_name))
        return A.weight_map(sc, ["setCode", "boosterName", "sheetName"], "cardUuid", "cardWeight")

    def templates(self, set_code: str, booster_type: str) -> DataFrame:
        keys = ["setCode", "boosterName"]
        cond = P.eq("setCode", P.upper_key(set_code)) & P.eq("boosterName", booster_type)
        return A.templates(self.t("set_booster_content_weights").where(cond),
                           self.t("set_booster_contents").where(cond), keys,
                           "boosterIndex", "boosterWeight", "sheetName", "sheetPicks")

    def open_packs(self, requests: DataFrame, seed: str = "pack", with_cards: bool = True) -> DataFrame:
        return X.open_packs(requests, self.t("set_booster_content_weights"), self.t("set_booster_contents"),
                            self.t("set_booster_sheets"), self.t("set_booster_sheet_cards"),
                            self.t("cards") if with_cards else None, seed=seed)

    def open_box(self, set_code: str, booster_type: str, packs: int, seed: str = "box",
                 with_cards: bool = True) -> DataFrame:
        req = self.c.spark.range(int(packs)).select(
            F.col("id").alias("request_id"), F.lit(P.upper_key(set_code)).alias("setCode"),
            F.lit(booster_type).alias("boosterName"))
        return self.open_packs(req, seed=seed, with_cards=with_cards)

    def open_pack(self, set_code: str, booster_type: str, seed: str = "pack", with_cards: bool = True) -> DataFrame:
        return self.open_box(set_code, booster_type, 1, seed=seed, with_cards=with_cards)


class CardData:
    """Client over a catalogue data root (or DataFrame overrides)."""

    def __init__(self, spark: SparkSession, root: str | None = None, overrides: dict | None = None,
                 normalize: bool = True, list_columns: dict | None = None):
        self.spark = spark
        self.catalog = Catalog(spark, root, overrides, normalize=normalize, list_columns=list_columns)
        self.cards = Cards(self)
        self.tokens = Tokens(self)
        self.sets = Sets(self)
        self.identifiers = Identifiers(self)
        self.legalities = Legalities(self)
        self.prices = Prices(self)
        self.decks = Decks(self)
        self.sealed = Sealed(self)
        self.skus = Skus(self)
        self.enums = Enums(self)
        self.booster = Booster(self)

    def sql(self, query: str, params=None, views=()) -> DataFrame:
        """S11 over registered views (register with ``views=[...]`` first)."""
        self.catalog.ensure_views(views)
        return sql(self.spark, query, params)

    def execute_scalar(self, query: str, params=None) -> DataFrame:
        return scalar(self.sql(query, params))

    def register_table_from_ndjson(self, name: str, path: str, schema=None) -> DataFrame:
        df = ingest_ndjson(self.spark, path, view=name, schema=schema)
        self.catalog._views[name] = df
        return df

    def views(self) -> list[str]:
        return self.catalog.views()

    def has_view(self, name: str) -> bool:
        return self.catalog.has_view(name)

    def reset_views(self) -> None:
        """Drop the registered views; they are re-registered on next use."""
        self.catalog.reset_views()

    def close(self) -> None:
        """Release the client's views (the Spark session belongs to the caller)."""
        self.catalog.reset_views()

    def meta(self) -> DataFrame:
        return Enums(self)._doc("meta").select("data.*")
