"""Explicit schemas, so that no read needs an inference pass."""

from pyspark.sql import types as T

_TEXTS = T.ArrayType(T.StringType())

# One catalogue entry, and the nested document that lists them.
APP = T.StructType(
    [
        T.StructField("appid", T.LongType()),
        T.StructField("name", T.StringType()),
    ]
)
APP_LIST = T.StructType(
    [T.StructField("applist", T.StructType([T.StructField("apps", T.ArrayType(APP))]))]
)

# One details answer: {"<appid>": {"success": ..., "data": {...}}}. The data
# stays text at first, which tells an empty object from one with other fields.
DETAILS_ENVELOPE = "map<string, struct<success: boolean, data: string>>"
DETAILS_DATA = (
    "struct<name: string, release_date: struct<date: string>,"
    " price_overview: struct<final_formatted: string>,"
    " genres: array<struct<description: string>>,"
    " developers: array<string>, publishers: array<string>>"
)

RESPONSES = T.StructType(
    [
        T.StructField("batch_no", T.LongType()),
        T.StructField("body", T.StringType()),
        T.StructField("answered_date", T.DateType()),
    ]
)

# The ids to fetch on a day, and the cached details that are served instead.
TO_FETCH = T.StructType(
    [
        T.StructField("appid", T.LongType()),
        T.StructField("batch_no", T.LongType()),
        T.StructField("planned_date", T.DateType()),
    ]
)
SERVED = T.StructType(
    [
        T.StructField("appid", T.LongType()),
        T.StructField("batch_no", T.LongType()),
        T.StructField("details", T.StringType()),
    ]
)

RAW_GAMES = T.StructType(
    [
        T.StructField("appid", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("release_date", T.StringType()),
        T.StructField("price", T.StringType()),
        T.StructField("genres", _TEXTS),
        T.StructField("developers", _TEXTS),
        T.StructField("publishers", _TEXTS),
    ]
)

CLEANED_GAMES = T.StructType(
    [
        T.StructField("appid", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("release_date", T.StringType()),
        T.StructField("price", T.StringType()),
        T.StructField("genres", _TEXTS),
        T.StructField("developers", _TEXTS),
        T.StructField("publishers", _TEXTS),
        T.StructField("price_usd", T.DoubleType()),
        T.StructField("price_category", T.StringType()),
        T.StructField("release_year", T.IntegerType()),
    ]
)

SYMBOLS = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("currency_code", T.StringType()),
    ]
)
RATES = T.StructType(
    [
        T.StructField("currency_code", T.StringType()),
        T.StructField("usd_per_unit", T.DoubleType()),
    ]
)

CALLS = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("calls", T.LongType()),
    ]
)
DETAILS_CACHE = T.StructType(
    [
        T.StructField("appid", T.LongType()),
        T.StructField("details", T.StringType()),
        T.StructField("fetched_date", T.DateType()),
    ]
)
PROCESSED = T.StructType([T.StructField("appid", T.LongType())])
