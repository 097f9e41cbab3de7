"""Column functions: text in, typed values out, all inside the JVM."""

from ludolens.functions.dates import release_year, year_label, year_prefix
from ludolens.functions.fields import default_array, fill_unknown, trim_array
from ludolens.functions.json_text import json_bytes
from ludolens.functions.prices import (
    dollars,
    dot_decimals,
    price_amount,
    price_category,
    price_symbol,
    valid_price,
)

__all__ = [
    "default_array",
    "dollars",
    "dot_decimals",
    "fill_unknown",
    "json_bytes",
    "price_amount",
    "price_category",
    "price_symbol",
    "release_year",
    "trim_array",
    "valid_price",
    "year_label",
    "year_prefix",
]
