"""Scans, normalisers, document sources and sinks."""

from tessera.sources.registry import (
    CATALOGUE_PARQUET, CATALOGUE_JSON, TEST_TABLES, Catalog, load_table,
)
from tessera.sources.normalize import (
    csv_columns, csv_to_array, json_to_variant, shred_json, unpivot_status, normalize_table,
)
from tessera.sources.files import (
    bucketed, ingest_ndjson, read_json_documents, unwrap_envelope, optional_column,
    write_table, write_json_documents,
)
from tessera.sources.json_array import read_json_array
from tessera.sources.sql import sql, scalar

__all__ = [
    "CATALOGUE_PARQUET", "CATALOGUE_JSON", "TEST_TABLES", "Catalog", "load_table",
    "bucketed", "csv_columns", "csv_to_array", "json_to_variant", "read_json_array", "shred_json",
    "unpivot_status", "normalize_table", "ingest_ndjson", "read_json_documents", "unwrap_envelope", "optional_column",
    "write_table", "write_json_documents", "sql", "scalar",
]
