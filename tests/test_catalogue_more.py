"""Prices, SKUs, sealed products, decks, vocabularies, boosters and
translations on the fixture rows."""

import gzip
import json

import pytest

from tests.conftest import CARDS, IDENTIFIERS, LEGALITIES, SETS, TOKENS

PRICES = [
    # uuid, source, provider, currency, price_type, finish, date, price
    ("u-ember", "paper", "cardhall", "EUR", "retail", "normal", "2025-03-01", 1.20),
    ("u-ember", "paper", "cardhall", "EUR", "retail", "normal", "2025-03-04", 1.60),
    ("u-ember", "paper", "boxshop", "EUR", "retail", "normal", "2025-03-01", 2.40),
    ("u-ember", "paper", "boxshop", "EUR", "buylist", "foil", "2025-03-04", None),
    ("u-tide", "paper", "cardhall", "EUR", "retail", "normal", "2025-03-04", 0.40),
    ("u-tide", "paper", "cardhall", "EUR", "retail", "normal", "2025-03-04", 0.70),  # duplicate key
    ("u-dusk", "online", "tixbot", "EUR", "retail", "normal", "2025-03-04", 0.05),
    ("u-ember-p", "paper", "cardhall", "EUR", "retail", "foil", "2025-03-04", 9.00),
]
PRICE_SCHEMA = ("uuid string, source string, provider string, currency string, price_type string, "
                "finish string, date string, price double")


@pytest.fixture(scope="module")
def full(spark, tmp_path_factory):
    from tessera.plans.catalogue import CardData
    tmp = tmp_path_factory.mktemp("full")
    leg = [dict(uuid=u, format=f, status=s) for u, f, s in LEGALITIES]
    sets = [dict(s) for s in SETS]
    sets[1]["sealedProduct"] = [
        dict(uuid="p-box", name="Tides Box", category="box", subtype="play", language="English",
             releaseDate="2022-02-04", cardCount=None, productSize=24, contents={"sealed": [{"uuid": "p-pack"}]},
             identifiers={"tcgplayerProductId": "7001"}, purchaseUrls={"shop": "https://shop.invalid/7001"}),
        dict(uuid="p-pack", name="Tides Pack", category="pack", subtype="play", releaseDate=None, cardCount=14)]
    sets[0]["sealedProduct"] = []
    docs = {
        "deck_list": {"meta": {}, "data": [
            dict(code="tid", name="Iron Starter", fileName="Starter_TID", type="Starter", releaseDate="2022-02-04"),
            dict(code="HRB", name="Harbour Duel", fileName="Duel_HRB", type="Duel Deck", releaseDate=None),
            dict(code="HRB", fileName="Nameless_HRB", type="DUEL deck", releaseDate="2019-07-12")]},
        "keywords": {"meta": {}, "data": {"actions": ["Foresight"], "abilities": ["Quick", "Bulwark"]}},
        "card_types": {"meta": {}, "data": {"creature": {"subTypes": ["Crab", "Golem"], "superTypes": ["Fabled"]},
                                            "ritual": {"subTypes": [], "superTypes": ["Quiet"]}}},
        "enum_values": {"meta": {}, "data": {"card": {"rarity": ["common", "rare"], "layout": ["split"]},
                                             "set": {"type": ["core"]}}},
        "meta": {"meta": {}, "data": {"version": "9.1", "date": "2025-03-04"}},
    }
    paths = {}
    for name, doc in docs.items():
        p = tmp / f"{name}.json.gz"
        with gzip.open(p, "wt") as f:
            json.dump(doc, f)
        paths[name] = str(p)
    foreign = [("u-tide", "German", "Flutwallhüter"), ("u-tide", "Dutch", "Hoeder van de Flutwal"),
               ("u-dusk", "German", "Dämmerung")]
    weights = [("TID", "play", 0, 7), ("TID", "play", 1, 1), ("TID", "play", 2, 1),
               ("OLD", "play", 0, 0), ("OLD", "play", 1, 0)]
    contents = [("TID", "play", 0, "base", 2), ("TID", "play", 0, "showcase", 1),
                ("TID", "play", 1, "base", None), ("TID", "play", 1, "shiny", 1),
                ("OLD", "play", 0, "base", 1), ("OLD", "play", 1, "base", 1)]
    sheets = [("TID", "play", "base", False, False, False, False, 3),
              ("TID", "play", "showcase", False, False, False, True, 1),
              ("TID", "play", "shiny", False, True, False, False, 2),
              ("OLD", "play", "base", False, False, False, False, 1)]
    sheet_cards = [("TID", "play", "base", "u-ember", 1), ("TID", "play", "base", "u-tide", None),
                   ("TID", "play", "base", "u-dusk", 1), ("TID", "play", "base", " ", 4),
                   ("TID", "play", "showcase", "u-dusk", 1),
                   ("TID", "play", "shiny", "u-ember", 0), ("TID", "play", "shiny", "u-tide", 2),
                   ("OLD", "play", "base", "u-blank", 1)]
    overrides = {
        "cards": spark.createDataFrame(
            [tuple(c.values()) for c in CARDS],
            ", ".join(f"{k} {'double' if k == 'manaValue' else 'boolean' if k == 'isPromo' else 'string'}"
                      for k in CARDS[0])),
        "sets": spark.read.json(spark.sparkContext.parallelize([json.dumps(s) for s in sets])),
        "tokens": spark.read.json(spark.sparkContext.parallelize([json.dumps(t) for t in TOKENS])),
        "card_identifiers": spark.read.json(spark.sparkContext.parallelize([json.dumps(i) for i in IDENTIFIERS])),
        "card_legalities": spark.read.json(spark.sparkContext.parallelize([json.dumps(x) for x in leg])),
        "all_prices_today": spark.createDataFrame(PRICES, PRICE_SCHEMA),
        "all_prices": spark.createDataFrame(PRICES, PRICE_SCHEMA),
        "tcgplayer_skus": spark.createDataFrame(
            [("u-ember", 501, 90017, "Mint", "English", "Plain", None),
             ("u-ember", 502, 90017, "Worn", "English", "Plain", None),
             ("u-tide", 640, 90031, "Mint", "German", "Foil", "foil")],
            "uuid string, skuId long, productId long, condition string, language string, printing string, finish string"),
        "card_foreign_data": spark.createDataFrame(foreign, "uuid string, language string, name string"),
        "set_booster_content_weights": spark.createDataFrame(
            weights, "setCode string, boosterName string, boosterIndex long, boosterWeight long"),
        "set_booster_contents": spark.createDataFrame(
            contents, "setCode string, boosterName string, boosterIndex long, sheetName string, sheetPicks long"),
        "set_booster_sheets": spark.createDataFrame(
            sheets, "setCode string, boosterName string, sheetName string, sheetHasBalanceColors boolean, "
                    "sheetIsFoil boolean, sheetIsFixed boolean, sheetAllowDuplicates boolean, totalWeight long"),
        "set_booster_sheet_cards": spark.createDataFrame(
            sheet_cards, "setCode string, boosterName string, sheetName string, cardUuid string, cardWeight long"),
        **paths,
    }
    return CardData(spark, overrides=overrides)


def test_price_map(full):
    m = full.prices.get("u-ember").first()["prices"]["paper"]
    assert m["cardhall"]["EUR"]["retail"]["normal"] == {"2025-03-01": 1.2, "2025-03-04": 1.6}
    assert m["boxshop"]["EUR"]["buylist"]["foil"] == {"2025-03-04": 0.0}         # NULL price -> 0.0
    dup = json.loads(full.prices.get("u-tide", as_json=True).first()["prices"])
    assert dup == {"paper": {"cardhall": {"EUR": {"retail": {"normal": {"2025-03-04": 0.7}}}}}}
    from tessera.operators.aggregates import flatten_nested_map
    lv = ["source", "provider", "currency", "price_type", "finish"]
    whole = flatten_nested_map(full.prices.get(), ["uuid"], lv, "date", "price")
    bulk = full.prices.get(split_levels=2)                                       # (uuid, source, provider)
    split = flatten_nested_map(bulk, ["uuid"] + lv[:2], lv[2:], "date", "price")
    assert full.prices.get().count() == 4 and bulk.count() == 5
    assert sorted(map(tuple, whole.select(*sorted(whole.columns)).collect())) == \
        sorted(map(tuple, split.select(*sorted(split.columns)).collect()))


def test_today_history_trend(full):
    assert sorted(r["provider"] for r in full.prices.today("u-ember").collect()) == ["boxshop", "cardhall"]
    assert full.prices.today("u-ember", per=["provider", "price_type"]).count() == 3
    rows = full.prices.history("u-ember").collect()
    assert [(r["date"], r["provider"]) for r in rows] == [
        ("2025-03-01", "boxshop"), ("2025-03-01", "cardhall"), ("2025-03-04", "boxshop"), ("2025-03-04", "cardhall")]
    assert full.prices.history("u-ember", "2025-03-02").count() == 2
    t = full.prices.price_trend("u-ember").first()
    assert (t["data_points"], t["min_price"], t["last_date"]) == (4, 1.2, "2025-03-04")
    t = full.prices.price_trend("absent").collect()
    assert len(t) == 1 and t[0]["data_points"] == 0 and t[0]["min_price"] is None


def test_cheapest_and_dearest(full):
    x = full.prices
    assert x.cheapest_printing("Ember Courier").first()["price"] == 1.2
    assert [r["price"] for r in x.most_expensive_printings("Ember Courier", 9).collect()] == [9.0, 2.4, 1.6, 1.2, None]
    assert {r["name"]: r["price"] for r in x.cheapest_printings_all(1).collect()} == {
        "Ember Courier": 1.2, "Tidewall Keeper": 0.4, "Dusk // Dawnlight": 0.05}
    assert x.cheapest_printing("Ember Courier", provider="boxshop").first()["price"] == 2.4
    assert x.most_expensive_printings("Ember Courier", 9, finish="foil").count() == 2
    with pytest.raises(ValueError):
        x.cheapest_printing("Ember Courier", colour="red")


def test_financial_summary(full):
    s = full.sets.get_financial_summary("tid").first()
    assert (s["card_count"], s["max_value"], s["date"]) == (3, 9.0, "2025-03-04")
    assert abs(s["total_value"] - 10.15) < 1e-9
    assert full.sets.get_financial_summary("TID", money_scale=2).first()["total_value"] == 10.15
    assert full.sets.get_financial_summary("HRB", price_type="retail").first()["card_count"] == 1
    assert full.sets.get_financial_summary().count() == 2


def test_skus(full):
    assert full.skus.get("u-ember").count() == 2 == full.skus.find_by_product_id(90017).count()
    assert full.skus.find_by_sku_id("640").first()["uuid"] == "u-tide"


def test_sealed(full, spark):
    from tessera.plans.catalogue import CardData
    rows = full.sealed.list().collect()
    assert sorted((r["uuid"], r["setCode"], r["setName"]) for r in rows) == [
        ("p-box", "TID", "Tides of Iron"), ("p-pack", "TID", "Tides of Iron")]
    assert full.sealed.get("hrb").count() == 0 and full.sealed.get("tid").count() == 2
    text = json.dumps([{"uuid": "p-box", "language": "English", "productSize": 24, "contents": {"card": [{"n": 1}]},
                        "identifiers": {"a": "7"}, "purchaseUrls": {"shop": "https://shop.invalid"}}])
    sets = "code string, name string, sealedProduct string"
    stored = CardData(spark, overrides={"sets": spark.createDataFrame([("TID", "Tides", text)], sets)})
    r = stored.sealed.list().first()
    assert (r["language"], r["productSize"], r["identifiers"]["a"], r["purchaseUrls"]) == (
        "English", 24, "7", {"shop": "https://shop.invalid"})
    assert json.loads(r["contents"]) == {"card": [{"n": 1}]}
    bare = CardData(spark, overrides={"sets": spark.createDataFrame([("TID",)], "code string")})
    with pytest.raises(Exception):
        bare.sealed.list().select("absent").count()


def test_missing_nested_column_keeps_the_schema(spark):
    from tessera.operators.nested import explode_tagged
    df = spark.createDataFrame([("TID", 3)], "code string, n long")
    out = explode_tagged(df, "products", {"code": "setCode"}, "struct<uuid:string,size:long>", position="pos",
                         require_present=False)
    assert out.dtypes == [("pos", "int"), ("uuid", "string"), ("size", "bigint"), ("setCode", "string")]
    assert out.count() == 0


def test_decks(full):
    def files(df):
        return sorted(r["fileName"] for r in df.collect())

    assert files(full.decks.list(set_code="TID")) == ["Starter_TID"]
    assert files(full.decks.list(deck_type="duel deck")) == ["Duel_HRB", "Nameless_HRB"]
    assert files(full.decks.search("HARBOUR")) == ["Duel_HRB"]
    assert full.decks.count(set_code="hrb").first()["cnt"] == 2


def test_vocabularies(full, spark):
    from tessera.plans.catalogue import CardData
    words = [("abilities", "Bulwark"), ("abilities", "Quick"), ("actions", "Foresight")]
    assert sorted(map(tuple, full.enums.keywords().collect())) == words
    assert sorted(map(tuple, full.enums.card_types().collect())) == [
        ("creature", "subTypes", "Crab"), ("creature", "subTypes", "Golem"), ("creature", "superTypes", "Fabled"),
        ("ritual", "superTypes", "Quiet")]
    assert sorted(map(tuple, full.enums.enum_values().collect())) == [
        ("card", "layout", "split"), ("card", "rarity", "common"), ("card", "rarity", "rare"),
        ("set", "type", "core")]
    assert full.meta().first()["version"] == "9.1"
    given = CardData(spark, overrides={"keywords": full.enums._doc("keywords")})   # a DataFrame instead of a path
    assert sorted(map(tuple, given.enums.keywords().collect())) == words


def test_documents_bare_or_enveloped(spark, tmp_path):
    from tessera.sources.files import read_json_documents
    rows = [{"code": "TID", "n": 1}, {"code": None, "n": 2}, {"code": "HRB"}]
    schema = "meta struct<version:string>, data array<struct<code:string,n:long>>"
    for i, doc in enumerate([rows, {"meta": {"version": "1"}, "data": rows}]):
        path = tmp_path / f"{i}.json"
        path.write_text(json.dumps(doc, indent=1))
        got = read_json_documents(spark, str(path), schema=schema)
        assert got.columns == ["code", "n"]
        assert sorted(map(tuple, got.collect()), key=str) == sorted([("TID", 1), (None, 2), ("HRB", None)], key=str)


def test_pages_after_null_keys(spark):
    from tessera.operators.topk import page_after
    rows = [(a, b) for a in (1, 2, None) for b in ("x", "y", None)]
    df = spark.createDataFrame(rows, "a long, b string")
    seen, after = [], None
    while part := [tuple(r) for r in page_after(df, ["a", "b"], after, 2).collect()]:
        seen, after = seen + part, part[-1]
    assert seen == sorted(rows, key=lambda r: [(v is None, v or 0) if i == 0 else (v is None, v or "")
                                               for i, v in enumerate(r)])


def test_localized_search(full):
    rows = full.cards.search(localized_name="flutwal").collect()
    assert [r["uuid"] for r in rows] == ["u-tide", "u-tide"]                     # one row per translation
    assert full.cards.search(localized_name="flutwal", localized_dedupe=True).count() == 1


def test_booster(full):
    assert [r[0] for r in full.booster.available_types("tid").collect()] == ["play"]
    sheet = full.booster.sheet_contents("TID", "play", "base").first()["cards"]
    assert sheet == {"u-dusk": 1, "u-ember": 1, "u-tide": 1}                     # NULL -> 1, blank dropped
    tpl = {r["boosterIndex"]: (r["weight"], r["sheets"]) for r in full.booster.templates("TID", "play").collect()}
    assert tpl == {0: (7, {"base": 2, "showcase": 1}), 1: (1, {"base": 1, "shiny": 1}), 2: (1, {})}
    box = full.booster.open_box("TID", "play", 300, with_cards=True).toPandas()
    assert set(box.request_id) == set(range(300)) and "rarity" in box.columns
    none = box[box.status == "empty"]
    assert set(none.boosterIndex) == {2} and none.cardUuid.isna().all()
    for (_, name), pack in box[box.status == "ok"].groupby(["request_id", "sheetName"]):
        assert pack.cardUuid.is_unique and pack.isFoil.all() == (name == "shiny")
        assert name != "shiny" or set(pack.cardUuid) == {"u-tide"}               # zero weight never drawn
    zero = full.booster.open_box("OLD", "play", 200, with_cards=False).toPandas()
    assert set(zero.boosterIndex) == {0, 1}                                      # all-zero weights: uniform pick
    assert [r["status"] for r in full.booster.open_pack("NOPE", "play").collect()] == ["no_template"]


def test_every_request_is_answered(full, spark):
    rows = [(1, "TID", "play"), (1, "OLD", "play"), (1, "OLD", "play"), (None, "OLD", "play"), (2, None, "play"),
            (3, "OLD", None)]
    asked = spark.createDataFrame(rows, "request_id long, setCode string, boosterName string")
    got = full.booster.open_packs(asked, with_cards=False).toPandas()
    keys = ["request_id", "setCode", "boosterName", "copy"]
    assert len(got.drop_duplicates(keys)) == len(rows)
    assert (got[got.request_id.isin([2, 3])].status == "no_template").all()


def test_fractional_weights_are_drawn(spark):
    from tessera.operators.sampling import weighted_with_replacement
    items = spark.createDataFrame([("g", "a", 0.5), ("g", "b", 1.5), ("g", "c", 0.0)], "g string, i string, w double")
    asked = spark.createDataFrame([("g", n) for n in range(400)], "g string, n long")
    got = weighted_with_replacement(items, asked, "g", "i", "w", 5, "n").toPandas().i.value_counts()
    assert set(got.index) == {"a", "b"} and 0.2 < got["a"] / got.sum() < 0.3
