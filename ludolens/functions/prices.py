"""Price text to symbol, amount, dollars and category."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from ludolens import fixed_values as fixed


def dot_decimals(price: Column, first_only: bool = False) -> Column:
    """Turn decimal commas into dots: every one, or the first one only."""
    if first_only:
        return F.regexp_replace(price, r"^([^,]*),", "$1.")
    return F.replace(price, F.lit(","), F.lit("."))


def price_symbol(price: Column) -> Column:
    """The currency symbol in front of the amount; empty if there is none."""
    return F.regexp_extract(price, fixed.SYMBOL_PATTERN, 1)


def price_amount(price: Column, first_only: bool = False) -> Column:
    """The first number in the price text, NULL if it does not read as one."""
    digits = F.regexp_extract(dot_decimals(price, first_only), fixed.AMOUNT_PATTERN, 0)
    return digits.try_cast("double")


def valid_price(price: Column) -> Column:
    """The price as a number if it is digits with at most two decimals."""
    return F.when(price.rlike(fixed.PLAIN_PRICE_PATTERN), price.try_cast("double"))


def dollars(amount: Column, usd_per_unit: Column) -> Column:
    """``amount * usd_per_unit`` to the cent.

    Decimal arithmetic makes half cents round up exactly; a value too large for
    the decimals is multiplied as doubles instead.
    """
    exact = amount.try_cast("decimal(18,6)") * usd_per_unit.try_cast("decimal(18,12)")
    return F.coalesce(
        F.round(exact, 2).cast("double"),
        F.round(amount * usd_per_unit, 2),
    )


def price_category(price_usd: Column) -> Column:
    """``Free`` for a price of zero; anything else, NULL too, is ``Paid``."""
    return F.when(price_usd == 0, fixed.FREE).otherwise(fixed.PAID)
