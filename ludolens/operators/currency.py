"""Price parsing and conversion to US dollars."""

from decimal import Decimal

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludolens.functions.prices import dollars, price_amount, price_symbol
from ludolens.sources.lookups import currency_symbols

# More currencies than exist; a longer rate table is not taken as small.
MAX_CURRENCIES = 10_000


def parse_price(df: DataFrame, price: str = "price", first_comma_only: bool = False) -> DataFrame:
    """Add ``symbol`` and ``amount`` read from a price text."""
    return df.withColumns(
        {
            "symbol": price_symbol(F.col(price)),
            "amount": price_amount(F.col(price), first_comma_only),
        }
    )


def with_currency(df: DataFrame, passthrough: bool = False) -> DataFrame:
    """Add ``currency_code`` for ``symbol``.

    An unknown symbol gives NULL, or with ``passthrough`` is its own code. The
    lookup has a fixed handful of rows and is broadcast.
    """
    symbols = F.broadcast(currency_symbols(df.sparkSession))
    coded = df.join(symbols, "symbol", "left")
    if passthrough:
        coded = coded.withColumn("currency_code", F.coalesce("currency_code", "symbol"))
    return coded


def checked_rates(rates: DataFrame) -> DataFrame:
    """Rates with one row per code, marked for broadcast if they are few.

    Two rates for one code would double rows, so they are an error.
    """
    rates = rates.select("currency_code", "usd_per_unit").where(F.col("currency_code").isNotNull())
    codes = [row[0] for row in rates.limit(MAX_CURRENCIES + 1).collect()]
    if len(codes) <= MAX_CURRENCIES:
        unique, checked = len(set(codes)) == len(codes), F.broadcast(rates)
    else:
        repeated = rates.groupBy("currency_code").count().where(F.col("count") > 1)
        unique, checked = repeated.isEmpty(), rates
    if not unique:
        raise ValueError("rates must have one row per currency code")
    return checked


def to_usd(
    df: DataFrame,
    rates: DataFrame,
    amount: str = "amount",
    code: str = "currency_code",
    name: str = "price_usd",
) -> DataFrame:
    """Add the amount in dollars; no rate, no code or no amount gives NULL.

    ``rates`` is ``(currency_code, usd_per_unit)``. The broadcast join needs no
    shuffle, however many prices share one currency.
    """
    per_code = checked_rates(rates).withColumnRenamed("currency_code", "_code")
    return (
        df.join(per_code, F.col(code) == F.col("_code"), "left")
        .withColumn(name, dollars(F.col(amount), F.col("usd_per_unit")))
        .drop("_code", "usd_per_unit")
    )


def to_usd_udf(rates: DataFrame):
    """A vectorised function ``(amount, code) -> dollars`` equal to :func:`to_usd`.

    For code that wants a function instead of a join. The rates, refused beyond
    ``MAX_CURRENCIES`` rows, travel inside the function.
    """
    rows = checked_rates(rates).limit(MAX_CURRENCIES + 1).collect()
    if len(rows) > MAX_CURRENCIES:
        raise ValueError("too many rates for a function; join them with to_usd")
    codes = [row["currency_code"] for row in rows]
    per_unit = [row["usd_per_unit"] for row in rows]

    @F.arrow_udf("double")
    def convert(amount: pa.Array, code: pa.Array) -> pa.Array:
        found = pc.index_in(code, value_set=pa.array(codes, code.type))
        rate = pa.array(per_unit, pa.float64()).take(found)
        product = pc.multiply(amount, rate)
        # Within these bounds decimals hold both factors and a double all cents.
        fits = pc.and_(
            pc.less(product, 9e13), pc.and_(pc.less(amount, 1e12), pc.less(rate, 1e6))
        )
        none = pa.scalar(None, pa.float64())
        exact = pc.multiply(
            pc.if_else(fits, amount, none).cast(pa.decimal128(18, 6)),
            pc.if_else(fits, rate, none).cast(pa.decimal128(18, 12)),
        )
        rounded = pc.round(exact, ndigits=2, round_mode="half_towards_infinity")
        cents = pc.multiply(rounded.cast(pa.decimal128(18, 2)), Decimal(100)).cast(pa.int64())
        beyond = pc.round(product, ndigits=2, round_mode="half_towards_infinity")
        return pc.coalesce(pc.divide(cents.cast(pa.float64()), 100.0), beyond)

    return convert
