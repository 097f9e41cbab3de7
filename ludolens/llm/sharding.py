"""Sharding by rendezvous hashing over weighted shards.

Every shard draws a number from each record's key; the record goes to the shard
with the lowest ``-ln(u) / weight``. A shard therefore receives records in
proportion to its weight, and a shard added later only takes records: the
draws of the others do not change.

Defined cases. NULL and repeated keys are keys like any other: all rows of one
key share a shard, so a key's rows never part. NULL texts have no bytes and
count 1. An empty table gives an empty result. Only the named columns are
read; other columns, whatever their names, never reach the result of ``place``.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludolens.operators.ordering import number_rows

# Hex digits of the digest that make a draw: 52 bits, exact in a double.
_DRAW_DIGITS = 13
_DRAW_RANGE = float(16**_DRAW_DIGITS)


def unit_draw(text: Column) -> Column:
    """A number in (0, 1) that depends on ``text`` alone."""
    digits = F.conv(F.substring(F.md5(text), 1, _DRAW_DIGITS), 16, 10).cast("double")
    return (digits + F.lit(0.5)) / F.lit(_DRAW_RANGE)


def _draw_of(key: Column, shard: Column | int, weight: Column | float) -> Column:
    shard = F.lit(shard) if isinstance(shard, int) else shard
    weight = F.lit(float(weight)) if isinstance(weight, int | float) else weight
    named = F.concat(F.coalesce(key.cast("string"), F.lit("null")), F.lit(":"), shard.cast("string"))
    return -F.log(unit_draw(named.cast("binary"))) / weight


def rendezvous_shard(key: Column, weights: Sequence[float]) -> Column:
    """The shard of ``key`` among ``len(weights)`` shards; equal draws go to the lower number."""
    if not weights or min(weights) <= 0:
        raise ValueError("every shard needs a weight above 0")
    drawn = F.transform(
        F.array(*[F.lit(float(w)) for w in weights]),
        lambda weight, shard: F.struct(_draw_of(key, shard, weight).alias("draw"), shard.alias("shard")),
    )
    return F.array_min(drawn)["shard"].cast("int")


def place(
    docs: DataFrame,
    weights: Sequence[float],
    added_weight: float = 1.0,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Shard and place within the shard of every row.

    Returns key, size (UTF-8 bytes and 1), text_crc32, shard, slot (from 0
    without gaps, by key, then size and checksum) and grown_shard, the shard
    once one more shard of ``added_weight`` exists. Only these narrow columns
    are sorted; texts stay where they are.
    """
    known = docs.select(
        F.col(key).alias(key),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 1).alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
        rendezvous_shard(F.col(key), weights).alias("shard"),
        rendezvous_shard(F.col(key), [*weights, added_weight]).alias("grown_shard"),
    )
    slotted = number_rows(known, [F.col(key).asc_nulls_first(), "size", "text_crc32"], "_slot", within=["shard"])
    return slotted.withColumn("slot", F.col("_slot") - 1).drop("_slot")


def write_shards(docs: DataFrame, path: str, weights: Sequence[float], key: str = "doc_id") -> None:
    """Write the rows of ``docs`` in one folder per shard, ``shard_number=N``."""
    sharded = docs.withColumn("shard_number", rendezvous_shard(F.col(key), weights))
    sharded.hint("rebalance", "shard_number").write.partitionBy("shard_number").mode("overwrite").parquet(path)
