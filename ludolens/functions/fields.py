"""Defaults and tidying of name and list columns."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludolens import fixed_values as fixed


def fill_unknown(df: DataFrame, columns: list[str]) -> DataFrame:
    """Replace NULL text in ``columns``."""
    return df.fillna({name: fixed.UNKNOWN for name in columns})


def default_array(items: Column) -> Column:
    """A NULL list becomes a list of one unknown; an empty list stays."""
    return F.coalesce(items, F.array(F.lit(fixed.UNKNOWN)))


def trim_array(items: Column) -> Column:
    """Trim every element; NULL elements stay NULL."""
    return F.transform(items, lambda item: F.trim(item))
