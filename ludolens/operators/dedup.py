"""One row per key: dedup, keep-last, merge and upsert.

Each is an aggregate, so every task reduces its own rows to one per key before
the shuffle; a key that holds a third of all rows costs one row per task.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludolens.scratch import broadcast_small, write_scratch


def _ordered_row(df: DataFrame, key: str, order: list[str] | None) -> Column:
    """All columns but the key, those of ``order`` first; NULLs come first.

    The remaining columns break ties, so the picked row is the same in every
    run, and one struct serves as both order and payload.
    """
    lead = [c for c in order or [] if c != key]
    return F.struct(*lead, *[c for c in df.columns if c != key and c not in lead])


def dedup(df: DataFrame, key: str, order: list[str] | None = None) -> DataFrame:
    """Keep the first row of each key by ``order``, then by all columns.

    NULLs come last, so a fuller copy wins over an emptier one.
    """
    lead = [c for c in order or [] if c != key]
    rest = [c for c in df.columns if c != key and c not in lead]
    flagged = [x for c in [*lead, *rest] for x in (F.col(c).isNull().alias(f"_no_{c}"), F.col(c))]
    first = F.min(F.struct(*flagged)).alias("_row")
    kept = [key if c == key else F.col(f"_row.{c}") for c in df.columns]
    return df.groupBy(key).agg(first).select(*kept)


def keep_last(df: DataFrame, key: str, order: list[str] | None = None) -> DataFrame:
    """Keep the last row of each key by ``order``, then by all columns."""
    last = F.max(_ordered_row(df, key, order)).alias("_row")
    return df.groupBy(key).agg(last).select(key, "_row.*").select(*df.columns)


def merge_tables(
    old: DataFrame, new: DataFrame, key: str, order: list[str] | None = None
) -> DataFrame:
    """Stack two tables and keep one row per key; a row of ``new`` wins.

    Neither side needs unique keys. Rows of one side with the same key are
    decided by ``order``.
    """
    stacked = old.withColumn("_batch", F.lit(0)).unionByName(new.withColumn("_batch", F.lit(1)))
    return keep_last(stacked, key, ["_batch", *(order or [])]).drop("_batch")


def replace_rows(old: DataFrame, newest: DataFrame, key: str) -> DataFrame:
    """``old`` with the rows of ``newest`` added in place of those they replace.

    Keys are unique on either side. The large table is only filtered, not
    aggregated; if the new keys are few it is not shuffled either.
    """
    replaced = broadcast_small(newest.select(F.col(key).alias("_replaced")))
    kept = old.join(replaced, F.col(key).eqNullSafe(F.col("_replaced")), "left_anti")
    return kept.unionByName(newest)


def upsert(
    old: DataFrame, new: DataFrame, key: str, order: list[str] | None = None
) -> DataFrame:
    """Like :func:`merge_tables` for an ``old`` table whose keys are unique.

    The newest rows are written once, as measuring, filtering and adding them
    all read them.
    """
    return replace_rows(old, write_scratch(keep_last(new, key, order)), key)


def null_key_count(df: DataFrame, key: str) -> DataFrame:
    """How many rows have no key, as one row ``null_keys``."""
    return df.agg(F.count_if(F.col(key).isNull()).alias("null_keys"))


def require_key(df: DataFrame, key: str) -> DataFrame:
    """Drop rows that have no key."""
    return df.where(F.col(key).isNotNull())
