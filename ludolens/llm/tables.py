"""The tables that the queries of this folder read, and whole rows as one column."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Rows that Spark hands to Python at a time here; whole texts make its default too large.
_BATCH_ROWS = "1000"
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Let the session hand texts to Python in small batches, unless it was told a size."""
    if spark.conf.get(_BATCH_SETTING) == "10000":
        spark.conf.set(_BATCH_SETTING, _BATCH_ROWS)


def whole_row(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct named ``row``, safe from names added later."""
    return F.struct(*[F.col(f"`{name}`") for name in df.columns]).alias("row")
