import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tessera.session import get_spark, checkpoint_dir
    s = get_spark("local[8]", 8, app_name="tessera-tests", extra={"spark.ui.enabled": "false"})
    checkpoint_dir(s)
    yield s


# Invented catalogue rows, written as NDJSON the way a catalogue ships them
# (lists as ", "-joined text): one name printed twice, a two-faced card, a card
# with most fields empty, an undated set, a shared identifier.
def _card(uuid, name, set_code, number, **given):
    row = dict(uuid=uuid, name=name, setCode=set_code, colors="", colorIdentity="", manaValue=0.0, manaCost=None,
               type="Artifact", text=None, rarity="common", power=None, toughness=None, layout="normal",
               artist=None, keywords=None, availability="paper", isPromo=None, language="English",
               faceName=None, side=None, number=number)
    return row | given


_COURIER = dict(colors="R", colorIdentity="R", manaValue=3.0, manaCost="{2}{R}", type="Creature — Messenger",
                text="Quick. When Ember Courier arrives, look ahead 1.", power="2", toughness="1",
                keywords="Quick, Foresight")
CARDS = [
    _card("u-ember", "Ember Courier", "HRB", "17", **_COURIER, artist="Ilse Varga", availability="online, paper",
          isPromo=False),
    _card("u-ember-p", "Ember Courier", "TID", "88p", **_COURIER, artist="Odo Kern", rarity="rare", isPromo=True),
    _card("u-tide", "Tidewall Keeper", "TID", "31", colors="U", colorIdentity="G, U", manaValue=4.0,
          type="Artifact Creature — Golem", text="Blocks only.", rarity="uncommon", power="0", toughness="6",
          artist="Ilse Varga", keywords="Bulwark", availability="arcade, paper", isPromo=False),
    _card("u-dusk", "Dusk // Dawnlight", "TID", "54", colors="B, W", colorIdentity="B, W", manaValue=5.0,
          type="Ritual // Ritual", text="Remove all tapped creatures.", rarity="rare", layout="split",
          artist="Odo Kern", isPromo=False, faceName="Dusk", side="a"),
    _card("u-blank", "Blank Marker", "OLD", "1"),
]
SETS = [
    dict(code="HRB", name="Harbour Lights", type="core", releaseDate="2019-07-12", baseSetSize=120,
         totalSetSize=135, block=None),
    dict(code="TID", name="Tides of Iron", type="expansion", releaseDate="2022-02-04", baseSetSize=210,
         totalSetSize=260, block="Iron"),
    dict(code="OLD", name="Old Drawer", type="core", releaseDate=None, baseSetSize=1, totalSetSize=1, block=None),
]
TOKENS = [
    dict(uuid="t-wisp", name="Spark Wisp", setCode="HRB", colors="R, U", type="Token Creature — Elemental",
         artist="Ilse Varga", number="T1", layout="token", availability="paper"),
    dict(uuid="t-crab", name="Iron Crab", setCode="TID", colors="", type="Token Artifact Creature — Crab",
         artist="Odo Kern", number="T4", layout="token", availability="paper"),
    dict(uuid="t-crab-o", name="Iron Crab", setCode="OLD", colors=None, type="Token Artifact Creature — Crab",
         artist=None, number="T1", layout="token", availability="paper"),
]
IDENTIFIERS = [
    dict(uuid="u-ember", scryfallId="s-17", tcgplayerProductId="90017", mtgoId=None, mtgArenaId=None,
         multiverseId="m-5"),
    dict(uuid="u-ember-p", scryfallId="s-88", tcgplayerProductId="90088", mtgoId="o-88", mtgArenaId=None,
         multiverseId="m-5"),
    dict(uuid="u-tide", scryfallId=None, tcgplayerProductId="90031", mtgoId=None, mtgArenaId="a-31",
         multiverseId=None),
]
LEGALITIES = [
    ("u-ember", "budget", "Legal"), ("u-ember", "eternal", "Legal"), ("u-ember-p", "budget", "Banned"),
    ("u-ember-p", "eternal", "Legal"), ("u-tide", "eternal", "Restricted"), ("u-dusk", "eternal", "Not Legal"),
    ("u-dusk", "duel", "Legal"),
]


def _ndjson(tmp, name, rows):
    import json
    p = os.path.join(tmp, f"{name}.ndjson")
    with open(p, "w") as f:
        for r in rows:
            f.write(json.dumps(r) + "\n")
    return p


@pytest.fixture(scope="session")
def client(spark, tmp_path_factory):
    from tessera.plans.catalogue import CardData
    tmp = str(tmp_path_factory.mktemp("catalogue"))
    leg = [dict(uuid=u, format=f, status=s) for u, f, s in LEGALITIES]
    paths = {n: _ndjson(tmp, n, rows) for n, rows in
             [("cards", CARDS), ("sets", SETS), ("tokens", TOKENS), ("card_identifiers", IDENTIFIERS),
              ("card_legalities", leg)]}
    overrides = {n: spark.read.json(p) for n, p in paths.items()}
    return CardData(spark, overrides=overrides)
