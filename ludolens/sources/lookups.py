"""Small lookup tables."""

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ludolens import fixed_values as fixed
from ludolens import schemas


def _literal_table(spark: SparkSession, pairs: dict, schema: T.StructType) -> DataFrame:
    """A table held in the plan itself."""
    columns = [list(pairs.keys()), list(pairs.values())]
    return spark.createDataFrame(pa.table(columns, names=schema.names), schema)


def currency_symbols(spark: SparkSession) -> DataFrame:
    """Price symbol to ISO code, a table of fixed size."""
    return _literal_table(spark, fixed.CURRENCY_CODES, schemas.SYMBOLS)


def rate_table(spark: SparkSession, usd_per_unit: dict[str, float]) -> DataFrame:
    """Exchange rates as a table."""
    return _literal_table(spark, usd_per_unit, schemas.RATES)
