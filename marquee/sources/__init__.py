from marquee.sources.catalog import Catalog
from marquee.sources.html import extract_links, match_tables, union_pages
from marquee.sources.readers import (
    CsvFormat,
    JsonFormat,
    Stage,
    batch,
    copy_into,
    list_assets,
    read_csv_format,
    read_json_array,
    read_tsv,
    read_variant,
    sample_batch,
)
from marquee.sources.registry import IdRegistry
from marquee.sources.snapshots import EventHistory, SnapshotTable
from marquee.sources.writers import land, truncate, write_csv_gz, write_json

__all__ = [
    "Catalog", "extract_links", "match_tables", "union_pages", "CsvFormat", "JsonFormat", "Stage",
    "batch", "copy_into", "list_assets", "read_csv_format", "read_json_array", "read_tsv",
    "read_variant", "sample_batch", "IdRegistry", "SnapshotTable", "EventHistory", "land", "truncate", "write_csv_gz", "write_json",
]
