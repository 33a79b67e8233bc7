"""CardData over a data root laid out as the catalogue publishes it: parquet
files normalised on registration (text lists, JSON text, wide legalities)."""

import gzip
import json
import os

import pytest

from tests.conftest import CARDS, SETS


def test_root_layout(spark, tmp_path):
    from tessera.plans.catalogue import CardData
    root = str(tmp_path)
    os.makedirs(os.path.join(root, "parquet"))
    cards = [dict(c, rulings='[{"date": "2020-01-01", "text": "ok"}]' if i == 0 else "{bad")
             for i, c in enumerate(CARDS)]
    spark.createDataFrame(
        [tuple(c.values()) for c in cards],
        ", ".join(f"{k} {'double' if k == 'manaValue' else 'boolean' if k == 'isPromo' else 'string'}"
                  for k in cards[0])).write.parquet(os.path.join(root, "parquet/cards.parquet"))
    spark.read.json(spark.sparkContext.parallelize([json.dumps(s) for s in SETS])) \
        .write.parquet(os.path.join(root, "parquet/sets.parquet"))
    spark.createDataFrame([("u-ember", "Legal", "Legal", None), ("u-tide", None, "Restricted", "Not Legal"),
                           ("u-blank", None, None, None)],
                          "uuid string, budget string, eternal string, duel string") \
        .write.parquet(os.path.join(root, "parquet/cardLegalities.parquet"))
    with gzip.open(os.path.join(root, "Meta.json.gz"), "wt") as f:   # compressed document
        json.dump({"meta": {}, "data": {"version": "9", "date": "2025-03-04"}}, f)
    cd = CardData(spark, root=root)
    row = cd.cards.get_by_uuid("u-dusk").first()
    assert row["colors"] == ["B", "W"] and row["keywords"] == []
    from pyspark.sql import functions as F
    rulings = cd.catalog.ensure_view("cards").select("uuid", F.variant_get("rulings", "$[0].text", "string").alias("t"))
    assert {r["uuid"]: r["t"] for r in rulings.collect()} == {c["uuid"]: "ok" if i == 0 else None
                                                              for i, c in enumerate(CARDS)}
    assert [r["uuid"] for r in cd.legalities.legal_in("eternal").collect()] == ["u-ember"]
    assert cd.legalities.formats_for_card("u-blank").count() == 0
    assert cd.catalog.ensure_view("card_legalities").count() == 4
    assert [r["code"] for r in cd.sets.search(release_year=2022).collect()] == ["TID"]
    assert cd.meta().first()["version"] == "9"
    # Card rows carry VARIANT columns from here on: the keyed methods must not
    # group, hash or sort on them.
    assert [r["faceName"] for r in cd.cards.get_atomic("Dusk").collect()] == ["Dusk"]
    assert cd.cards.get_atomic(spark.createDataFrame([("Ember Courier",), ("Dusk",)], "n string")).count() == 2
    assert cd.cards.random(2).count() == 2
    assert cd.cards.search(types="creature", limit=2, offset=1).count() == 2
    assert cd.cards.get_by_uuids(spark.createDataFrame([("u-tide",)], "k string")).count() == 1
    assert cd.cards.search(fuzzy_name="Tidewal Keeper").count() == 1
    with pytest.raises(KeyError):
        cd.catalog.ensure_view("nope")
