"""The cleaning job: raw game rows to typed, deduplicated ones."""

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ludolens import schemas
from ludolens.functions.dates import release_year
from ludolens.functions.fields import default_array, fill_unknown, trim_array
from ludolens.functions.prices import price_category
from ludolens.operators.currency import parse_price, to_usd, with_currency
from ludolens.operators.dedup import dedup, require_key


def clean_games(
    raw: DataFrame,
    rates: DataFrame,
    order: list[str] | None = None,
    passthrough: bool = False,
    seen: Observation | None = None,
    unique: bool = False,
) -> DataFrame:
    """Clean raw game rows.

    Keyless rows go and one row per id stays, the first by ``order``. That
    happens on the raw columns, so the one shuffle carries no computed column
    and each kept text is parsed once. ``seen`` collects ``rows`` and
    ``null_keys`` of the input during the same pass.
    ``unique`` says that ids do not repeat, and nothing is shuffled.
    """
    raw = raw.select(*schemas.RAW_GAMES.fieldNames())
    if seen is not None:
        raw = raw.observe(
            seen,
            F.count("*").alias("rows"),
            F.count_if(F.col("appid").isNull()).alias("null_keys"),
        )
    keyed = require_key(raw, "appid")
    games = keyed if unique else dedup(keyed, "appid", order)
    priced = to_usd(with_currency(parse_price(games), passthrough), rates)
    return fill_unknown(priced, ["name"]).select(
        "appid",
        "name",
        "release_date",
        "price",
        *[
            trim_array(default_array(F.col(c))).alias(c)
            for c in ("genres", "developers", "publishers")
        ],
        "price_usd",
        price_category(F.col("price_usd")).alias("price_category"),
        release_year(F.col("release_date")).alias("release_year"),
    )
