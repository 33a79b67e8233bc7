"""Catalogue methods on the fixture rows."""

import pytest

EMBERS = ["u-ember", "u-ember-p"]


def uuids(df):
    return sorted(r["uuid"] for r in df.collect())


def test_normalised_lists(client):
    rows = {r["uuid"]: r for r in client.catalog.ensure_view("cards").collect()}
    assert rows["u-dusk"]["colors"] == ["B", "W"] and rows["u-tide"]["availability"] == ["arcade", "paper"]
    assert rows["u-dusk"]["keywords"] == [] and rows["u-blank"]["colors"] == []       # null and blank text


def test_lookups(client, spark):
    c = client.cards
    assert uuids(c.get_by_name("Ember Courier")) == EMBERS == uuids(c.get_printings("Ember Courier"))
    assert uuids(c.get_by_name("Ember Courier", set_code="TID")) == ["u-ember-p"]
    assert uuids(c.get_by_uuids(["u-tide", "absent", "u-blank"])) == ["u-blank", "u-tide"]
    assert uuids(c.get_by_uuids(spark.createDataFrame([("u-dusk",), ("absent",)], "k string"))) == ["u-dusk"]
    assert uuids(c.get_by_uuids([])) == uuids(c.get_by_uuid("absent")) == uuids(c.get_by_name("absent")) == []
    row = c.get_by_uuid("u-blank").first()
    assert row["text"] is None and row["isPromo"] is None and row["manaValue"] == 0.0


def test_atomic(client, spark):
    """One row per (name, faceName), the smallest uuid; a face's name serves
    where no card has the name."""
    c = client.cards
    assert uuids(c.get_atomic("Ember Courier")) == ["u-ember"]
    assert uuids(c.get_atomic("Dusk")) == uuids(c.get_atomic("Dusk // Dawnlight")) == ["u-dusk"]
    assert uuids(c.get_atomic("Dawnlight")) == []
    asked = spark.createDataFrame([("Dusk",), ("Blank Marker",), ("absent",), ("Ember Courier",)], "n string")
    assert uuids(c.get_atomic(asked)) == ["u-blank", "u-dusk", "u-ember"]


def test_atomic_pushes_the_name(client, spark, tmp_path):
    from tessera.plans.catalogue import CardData
    client.catalog.ensure_view("cards").write.parquet(str(tmp_path / "c"))
    stored = CardData(spark, overrides={"cards": spark.read.parquet(str(tmp_path / "c"))})
    plan = stored.cards.get_atomic("Dusk")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(name,Dusk)" in plan and "EqualTo(faceName,Dusk)" in plan and plan.count("FileScan") == 1


@pytest.mark.parametrize("given, want", [
    (dict(name="Tidewall Keeper"), ["u-tide"]),
    (dict(name="%marker"), ["u-blank"]),
    (dict(colors=["W"]), ["u-dusk"]),
    (dict(colors=["U", "W"]), []),
    (dict(color_identity=["G"]), ["u-tide"]),
    (dict(types="golem"), ["u-tide"]),
    (dict(types="artifact", rarity="common"), ["u-blank"]),
    (dict(text="TAPPED"), ["u-dusk"]),
    (dict(text_regex="ahead [0-9]"), EMBERS),
    (dict(artist="varga", set_code="TID"), ["u-tide"]),
    (dict(keyword="Foresight", is_promo=True), ["u-ember-p"]),
    (dict(availability="arcade"), ["u-tide"]),
    (dict(power="0", toughness="6"), ["u-tide"]),
    (dict(layout="split", language="English"), ["u-dusk"]),
    (dict(mana_value=3), EMBERS),
    (dict(mana_value_gte=3.5, mana_value_lte=5), ["u-dusk", "u-tide"]),
    (dict(set_type="core"), ["u-blank", "u-ember"]),
    (dict(legal_in="eternal"), EMBERS),
    (dict(legal_in="budget", set_type="expansion"), []),
    (dict(fuzzy_name="Embr Courier"), EMBERS),
    (dict(limit=2, offset=3), ["u-ember-p", "u-tide"]),
    (dict(limit=None, offset=4), ["u-tide"]),
])
def test_search(client, given, want):
    assert uuids(client.cards.search(**given)) == want


def test_search_refuses_a_threshold_over_one(client):
    with pytest.raises(ValueError):
        client.cards.search(fuzzy_name="Ember", fuzzy_threshold=1.2)


def test_random_and_counts(client):
    assert uuids(client.cards.random(3)) == uuids(client.cards.random(3)) and client.cards.random(3).count() == 3
    assert client.cards.random(50).count() == 5
    assert client.cards.count().first()["cnt"] == 5
    assert client.cards.count({"setCode": "TID", "rarity": "rare"}).first()["cnt"] == 2
    assert client.tokens.count({"name": "Iron Crab"}).first()["cnt"] == 2
    with pytest.raises(ValueError):
        client.tokens.count({"colour": "red"})


def test_legalities(client, spark):
    x = client.legalities
    assert uuids(x.legal_in("eternal")) == EMBERS and uuids(x.legal_in("duel")) == ["u-dusk"]
    assert uuids(x.banned_in("budget")) == ["u-ember-p"] and uuids(x.restricted_in("eternal")) == ["u-tide"]
    assert uuids(x.not_legal_in("eternal")) == ["u-dusk"] and uuids(x.banned_in("duel")) == []
    assert x.formats_for_card("u-dusk").count() == 2 and x.formats_for_card("u-blank").count() == 0
    asked = [("u-ember", "budget", True), ("u-ember-p", "budget", False), ("u-tide", "eternal", False),
             ("u-tide", "duel", False), ("absent", "duel", False)]
    for uuid, fmt, want in asked:
        assert x.is_legal(uuid, fmt).first()[0] is want
    bulk = x.is_legal_all(spark.createDataFrame([r[:2] for r in asked], "uuid string, format string"))
    assert sorted((r["uuid"], r["format"], r["is_legal"]) for r in bulk.collect()) == sorted(asked)


def test_identifiers(client):
    x = client.identifiers
    assert uuids(x.find_by("multiverseId", "m-5")) == uuids(x.find_by_multiverse_id("m-5")) == EMBERS
    assert uuids(x.find_by_mtg_arena_id("a-31")) == ["u-tide"] and uuids(x.find_by_mtgo_id("o-88")) == ["u-ember-p"]
    assert uuids(x.find_by_tcgplayer_product_id("90017")) == uuids(client.cards.find_by_scryfall_id("s-17")) == ["u-ember"]
    assert x.find_by_scryfall_id("absent").count() == 0 and x.get_identifiers("u-blank").count() == 0
    assert x.get_identifiers("u-tide").first()["scryfallId"] is None
    with pytest.raises(ValueError):
        x.find_by("uuid; drop", "x")


def test_sets(client):
    def codes(df):
        return [r["code"] for r in df.collect()]

    x = client.sets
    assert codes(x.list()) == ["TID", "HRB", "OLD"]                       # newest first, undated last
    assert codes(x.list(set_type="core")) == ["HRB", "OLD"] and codes(x.list(name="OF IRON")) == ["TID"]
    assert codes(x.list(limit=1, offset=1)) == ["HRB"] and codes(x.list(offset=2)) == ["OLD"]
    assert codes(x.search(release_year=2019)) == ["HRB"] and codes(x.search(name="drawer")) == ["OLD"]
    assert x.get("tid").first()["block"] == "Iron" and x.get("absent").count() == 0
    assert [x.count(t).first()["cnt"] for t in (None, "core", "absent")] == [3, 2, 0]


def test_tokens(client):
    x = client.tokens
    assert uuids(x.get_by_name("Iron Crab")) == ["t-crab", "t-crab-o"]
    assert uuids(x.get_by_name("Iron Crab", set_code="OLD")) == uuids(x.for_set("OLD")) == ["t-crab-o"]
    assert uuids(x.search(colors=["U"])) == uuids(x.search(name="spark%")) == ["t-wisp"]
    assert uuids(x.search(types="crab", artist="kern")) == ["t-crab"]
    assert uuids(x.get_by_uuids(["t-wisp", "absent"])) == uuids(x.get_by_uuid("t-wisp")) == ["t-wisp"]


def test_sql_and_views(client, spark):
    from tessera.plans.catalogue import CardData
    from tessera.sources.sql import scalar_value
    joined = client.sql("SELECT c.uuid FROM cards c JOIN sets s ON s.code = c.setCode WHERE s.block = ?", ["Iron"],
                        views=["cards", "sets"])
    assert uuids(joined) == ["u-dusk", "u-ember-p", "u-tide"] and {"cards", "sets"} <= set(client.views())
    assert scalar_value(client.execute_scalar("SELECT max(totalSetSize) FROM sets")) == 260
    assert scalar_value(client.sql("SELECT name FROM cards WHERE uuid = ?", ["absent"])) is None
    own = CardData(spark, overrides={"tokens": spark.createDataFrame([("t",)], "uuid string")})
    assert own.views() == [] and not own.has_view("tokens")
    own.catalog.ensure_view("tokens")
    assert own.views() == ["tokens"]
    own.reset_views()
    assert own.views() == []


def test_a_table_registered_again_replaces_the_first(spark, tmp_path):
    from tessera.plans.catalogue import CardData
    c = CardData(spark)
    for i, rows in enumerate(['{"n": 1}\n{"n": 2}\n', '{"n": 30}\n']):
        path = tmp_path / f"{i}.ndjson"
        path.write_text(rows)
        c.register_table_from_ndjson("numbers", str(path))
    assert [r["n"] for r in spark.sql("SELECT n FROM numbers").collect()] == [30]
