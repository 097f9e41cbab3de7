"""Mixing sources to target weights by repetition rates.

Words are summed per source. Each source's share of all words follows its
weight, but stops at ``max_repeat`` times its own words, and what is cut off
goes to the other sources by weight. A source's rate is its target divided by its
words. A document is emitted ``floor(rate)`` times, and once more if a
number drawn from the seed and the row itself falls under the fraction.

Defined cases. A NULL text has no words. NULL is a source of its own and comes
last. Sources without words have rate 0. Repeated rows draw the same number, so
they are taken alike. An empty table gives an empty result. The input's columns
travel in one struct, so none can clash with the columns made here.
"""

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludolens.llm.sharding import unit_draw
from ludolens.llm.tables import whole_row
from ludolens.operators.ordering import number_rows
from ludolens.scratch import broadcast_small, write_scratch

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
SEED = "mix"

_WHOLE = "decimal(38,0)"


def word_count(text: Column) -> Column:
    """Runs of characters other than ASCII white space; NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeat: int = MAX_REPEAT
) -> DataFrame:
    """Target words of each source, from rows of ``source`` and ``size``.

    Whole-number sums decide which sources stop at their limit. Each round
    is one aggregate over one row per source: the level rises as sources reach their
    limit, and the last level that adds no source stands.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    table = write_scratch(
        number_rows(totals, [F.col("source").asc_nulls_last()], "_n").select(
            "source",
            "source_size",
            F.element_at(cycle, ((F.col("_n") - 1) % len(weights) + 1).cast("int")).alias("weight"),
        )
    )
    limit = F.col("source_size").cast(_WHOLE) * max_repeat
    words, weight = table.agg(F.sum(F.col("source_size").cast(_WHOLE)), F.sum("weight")).first()
    left, open_weight, stopped = words or Decimal(0), weight or 1, 0
    while True:
        over = F.col("weight") * F.lit(left).cast(_WHOLE) > limit * F.lit(open_weight)
        count, cut, cut_weight = table.where(over).agg(F.count("*"), F.sum(limit), F.sum("weight")).first()
        if count == stopped:
            break
        stopped, left, open_weight = count, words - cut, weight - cut_weight
    level = F.lit(float(left)) * F.col("weight") / F.lit(float(open_weight))
    return table.withColumn("target", F.when(over, limit.cast("double")).otherwise(level)).drop("weight")


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    max_repeat: int = MAX_REPEAT,
    seed: str = SEED,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """Every row as ``row``, with size, source_size, target, rate and copies."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in (key, source)]
    content = F.coalesce(F.md5(F.col(text).cast("binary")), F.lit("null"))
    rows = docs.select(
        whole_row(docs),
        F.col(source).alias("_source"),
        word_count(F.col(text)).alias("size"),
        unit_draw(F.concat_ws("|", F.lit(seed), *parts, content).cast("binary")).alias("_draw"),
    )
    sizes = write_scratch(
        docs.groupBy(F.col(source).alias("source")).agg(F.sum(word_count(F.col(text))).alias("size"))
    )
    targets = source_targets(sizes, weights, max_repeat)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return (
        rows.join(broadcast_small(targets), F.col("_source").eqNullSafe(F.col("source")))
        .withColumn("rate", rate)
        .withColumn("copies", F.floor("rate") + (F.col("_draw") < F.col("rate") % 1).cast("bigint"))
        .select("row", "size", "source_size", "target", "rate", "copies")
    )


def emit_copies(mixed: DataFrame) -> DataFrame:
    """Every document as often as ``mix`` decided, with its own columns."""
    taken = F.explode(F.array_repeat(F.lit(True), F.col("copies").cast("int")))
    return mixed.select("row", taken.alias("taken")).select("row.*")
