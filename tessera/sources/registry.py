"""Dataset registry and lazily registered views."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

# Logical dataset name -> file under the data root.  These are
# the catalogue's published file names and must stay as they are.
CATALOGUE_PARQUET = {
    "cards": "parquet/cards.parquet",
    "tokens": "parquet/tokens.parquet",
    "sets": "parquet/sets.parquet",
    "card_identifiers": "parquet/cardIdentifiers.parquet",
    "card_legalities": "parquet/cardLegalities.parquet",
    "card_foreign_data": "parquet/cardForeignData.parquet",
    "card_rulings": "parquet/cardRulings.parquet",
    "card_purchase_urls": "parquet/cardPurchaseUrls.parquet",
    "set_translations": "parquet/setTranslations.parquet",
    "token_identifiers": "parquet/tokenIdentifiers.parquet",
    "set_booster_content_weights": "parquet/setBoosterContentWeights.parquet",
    "set_booster_contents": "parquet/setBoosterContents.parquet",
    "set_booster_sheet_cards": "parquet/setBoosterSheetCards.parquet",
    "set_booster_sheets": "parquet/setBoosterSheets.parquet",
    "all_printings": "parquet/AllPrintings.parquet",
    "all_prices_today": "parquet/AllPricesToday.parquet",
    "all_prices": "parquet/AllPrices.parquet",
    "tcgplayer_skus": "parquet/TcgplayerSkus.parquet",
}

CATALOGUE_JSON = {
    "keywords": "Keywords.json",
    "card_types": "CardTypes.json",
    "deck_list": "DeckList.json",
    "enum_values": "EnumValues.json",
    "meta": "Meta.json",
}

# The driver's generated tables: one parquet file each under an sf directory.
TEST_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


_SCANS: dict = {}


def listing(spark: SparkSession, path: str) -> tuple | None:
    """(path, length, time) of every file under ``path``, through the Hadoop
    FileSystem; None if it can't be listed (a Spark Connect client)."""
    try:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
        top = fs.getFileStatus(p)
        if not top.isDirectory():
            return ((top.getPath().toString(), top.getLen(), top.getModificationTime()),)
        out, files = [], fs.listFiles(p, True)
        while files.hasNext():
            f = files.next()
            out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
        return tuple(sorted(out))
    except Exception:  # noqa: BLE001
        return None


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan of one generated table (projection/filters push down).

    The DataFrame (its file listing and footer schema, not data) is reused
    within a session as long as the listing stays the same: re-reading footers
    costs more than small queries themselves, and a table that was written
    anew is read anew.
    """
    if name not in TEST_TABLES:
        raise KeyError(f"unknown table {name!r}")
    path = os.path.join(sf_dir, f"{name}.parquet")
    now = listing(spark, path)
    hit = _SCANS.get(path)
    if now is not None and hit is not None and hit[0] == now and hit[1].sparkSession is spark:
        return hit[1]
    df = spark.read.parquet(path)
    _SCANS[path] = (now, df)
    return df


class Catalog:
    """Named views over a data root, registered on first use.

    ``ensure_view`` reads only the parquet footer (schema) on the driver and
    builds one normalising ``select``; no job runs until the caller acts.
    ``overrides`` maps a logical name to an explicit path or to a DataFrame
    (used by tests and by callers whose files live elsewhere).
    """

    def __init__(self, spark: SparkSession, root: str | None = None,
                 overrides: dict | None = None, normalize: bool = True,
                 list_columns: dict | None = None):
        self.spark = spark
        self.root = root
        self.overrides = dict(overrides or {})
        self.normalize = normalize
        # Per-table adjustments of the text-list heuristic:
        # {"cards": {"extra": ["otherLists"], "ignore": ["names"]}}.
        self.list_columns = dict(list_columns or {})
        self._views: dict[str, DataFrame] = {}

    # -- registry (S2) -------------------------------------------------------
    def path_of(self, name: str) -> str:
        if name in CATALOGUE_PARQUET:
            rel = CATALOGUE_PARQUET[name]
        elif name in CATALOGUE_JSON:
            rel = CATALOGUE_JSON[name]
        else:
            raise KeyError(f"unknown dataset {name!r}")
        if self.root is None:
            raise ValueError("no data root configured")
        path = os.path.join(self.root, rel)
        if name in CATALOGUE_JSON and not self._exists(path) and self._exists(path + ".gz"):
            path += ".gz"           # documents may be stored gzip-compressed
        return path

    def _exists(self, path: str) -> bool:
        """Existence check through the Hadoop FileSystem (local, HDFS, S3, ...)."""
        try:
            jvm = self.spark._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            return bool(p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p))
        except Exception:  # noqa: BLE001 - no JVM gateway (Spark Connect): assume plain name
            return not path.endswith(".gz")

    # -- views (S1) ----------------------------------------------------------
    def register(self, name: str, df: DataFrame) -> DataFrame:
        """Register (or replace) a view from a DataFrame."""
        if self.normalize:
            from tessera.sources.normalize import normalize_table
            adj = self.list_columns.get(name, {})
            df = normalize_table(df, name, extra=adj.get("extra", ()), ignore=adj.get("ignore", ()))
        df.createOrReplaceTempView(name)
        self._views[name] = df
        return df

    def ensure_view(self, name: str) -> DataFrame:
        if name in self._views:
            return self._views[name]
        src = self.overrides.get(name)
        if isinstance(src, DataFrame):
            df = src
        else:
            path = src or self.path_of(name)
            if name in CATALOGUE_JSON or str(path).endswith((".json", ".json.gz")):
                from tessera.sources.files import read_json_documents
                df = read_json_documents(self.spark, path)
            else:
                df = self.spark.read.parquet(path)
        return self.register(name, df)

    def ensure_views(self, names) -> list[DataFrame]:
        return [self.ensure_view(n) for n in names]

    def table(self, name: str) -> DataFrame:
        return self.ensure_view(name)

    # -- catalog (S10) -------------------------------------------------------
    def has_view(self, name: str) -> bool:
        return name in self._views

    def views(self) -> list[str]:
        return sorted(self._views)

    def reset_views(self) -> None:
        for name in list(self._views):
            self.spark.catalog.dropTempView(name)
        self._views.clear()
