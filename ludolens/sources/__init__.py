"""Sources and sinks."""

from ludolens.sources.documents import (
    read_catalogue,
    read_json_or_empty,
    unwrap_apps,
    write_json,
)
from ludolens.sources.json_lists import read_json_list
from ludolens.sources.lookups import currency_symbols, rate_table
from ludolens.sources.models import load_model, save_model
from ludolens.sources.state import (
    load_cache,
    load_calls,
    load_processed,
    record_calls,
    save_cache,
    save_processed,
)
from ludolens.sources.tables import (
    read_or_empty,
    read_table,
    upsert_table,
    write_partitioned,
    write_table,
)

__all__ = [
    "currency_symbols",
    "load_cache",
    "load_calls",
    "load_model",
    "load_processed",
    "rate_table",
    "read_catalogue",
    "read_json_list",
    "read_json_or_empty",
    "read_or_empty",
    "read_table",
    "record_calls",
    "save_cache",
    "save_model",
    "save_processed",
    "unwrap_apps",
    "upsert_table",
    "write_json",
    "write_partitioned",
    "write_table",
]
