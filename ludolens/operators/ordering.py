"""Row numbers, ranks and running totals over one global order.

An unpartitioned window would move every row to one task. Here the rows are
sorted across tasks by ranges of the order, written once, and each sorted part
is shifted by the totals of the parts before it. Those totals are one row per
sort partition, which bounds the only unpartitioned window and the broadcast.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ludolens.scratch import broadcast_small, write_scratch

# Up to this many first rows, every task keeps its own and one task merges
# them. Beyond it, rows are numbered across tasks.
FIRST_ROWS = 1_000

# monotonically_increasing_id() is documented as the partition number in the
# upper 31 bits and the position within the partition in the lower 33.
_POSITION_BITS = 33


def row_hash(df: DataFrame) -> Column:
    """What ends every order, so that ties break alike on every path."""
    return F.xxhash64(*df.columns)


def _sorted_table(df: DataFrame, order: list[str | Column]) -> DataFrame:
    """``df`` sorted and written, with ``_at`` giving part and position.

    A hash of the whole row ends the order, so that rows equal in ``order``
    repeat in the same sequence, and a number per row after it, so that rows
    equal in all columns still spread over parts.
    """
    numbered = df.withColumn("_row", F.monotonically_increasing_id())
    placed = numbered.sort(*order, row_hash(df), "_row").drop("_row")
    return write_scratch(placed.withColumn("_at", F.monotonically_increasing_id()))


def _part() -> Column:
    return F.shiftright("_at", _POSITION_BITS)


def _position() -> Column:
    return F.col("_at").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))


def _add_part_starts(table: DataFrame, size: Column) -> DataFrame:
    """Add ``_start``: the total of ``size`` over all earlier parts."""
    earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        table.groupBy(_part().alias("_part"))
        .agg(size.alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start"))
    )
    return table.withColumn("_part", _part()).join(F.broadcast(starts), "_part")


def number_rows(
    df: DataFrame,
    order: list[str | Column],
    name: str = "row_index",
    within: list[str] | None = None,
) -> DataFrame:
    """Number rows 1..n by ``order``, over all rows or within groups.

    Groups may be of any size: a group is spread over as many parts as its
    rows need. Ties end in a hash of the row.
    """
    within = within or []
    table = _sorted_table(df, [*within, *order])
    numbered = _add_part_starts(table, F.count("*")).withColumn(
        name, F.col("_start") + _position() + 1
    )
    if within:
        firsts = numbered.groupBy(
            *[F.col(g).alias(f"_group{i}") for i, g in enumerate(within)]
        ).agg(F.min(name).alias("_first"))
        same_group = [F.col(g).eqNullSafe(F.col(f"_group{i}")) for i, g in enumerate(within)]
        numbered = numbered.join(broadcast_small(firsts), same_group).withColumn(
            name, F.col(name) - F.col("_first") + 1
        )
    return numbered.select(*df.columns, name)


def running_total(
    df: DataFrame, order: list[str | Column], value: str, name: str = "before"
) -> DataFrame:
    """Add the total of ``value`` over all rows earlier in ``order``."""
    table = _sorted_table(df, order)
    earlier = (
        W.partitionBy("_part").orderBy("_at").rowsBetween(W.unboundedPreceding, -1)
    )
    inside = F.coalesce(F.sum(value).over(earlier), F.lit(0))
    return (
        _add_part_starts(table, F.sum(value))
        .withColumn(name, F.col("_start") + inside)
        .select(*df.columns, name)
    )


def assign_batches(
    df: DataFrame, order: list[str | Column], size: int, name: str = "batch_no"
) -> DataFrame:
    """Cut rows into batches of ``size`` by ``order``, numbered from 0."""
    numbered = number_rows(df, order, "_index")
    batch = F.floor((F.col("_index") - 1) / F.lit(size)).cast("bigint")
    return numbered.select(*df.columns, batch.alias(name))


def first_rows(df: DataFrame, order: list[str | Column], n: int) -> DataFrame:
    """The first ``n`` rows by ``order``, ties by a hash of the row."""
    if n <= FIRST_ROWS:
        return df.orderBy(*order, row_hash(df)).limit(n)
    return number_rows(df, order, "_index").where(F.col("_index") <= n).drop("_index")


def top_k(
    df: DataFrame,
    k: int,
    order: list[str | Column],
    within: list[str] | None = None,
    name: str = "rank",
) -> DataFrame:
    """The first ``k`` rows by ``order`` with their rank, overall or per group.

    For small ``k`` every task keeps only its own first ``k`` rows (per group)
    before the shuffle, so the ranking sees few rows however large a group is.
    """
    if k > FIRST_ROWS:
        return number_rows(df, order, name, within).where(F.col(name) <= k)
    place, full = F.row_number(), [*order, row_hash(df)]
    if within:
        ranked = df.withColumn(name, place.over(W.partitionBy(*within).orderBy(*full)))
        kept = ranked.where(F.col(name) <= k)
    else:
        kept = first_rows(df, order, k).withColumn(name, place.over(W.orderBy(*full)))
    return kept.withColumn(name, F.col(name).cast("bigint"))
