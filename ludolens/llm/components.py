"""Connected components of a graph given by its links.

Alternates two steps until nothing changes. The large step points every larger
neighbour of a node to the smallest node around it; the small step does so for the
smaller neighbours and the node itself. Both take a minimum per node, which tasks
reduce before the shuffle, and a join that adaptive execution can split
for a node with very many links. Every round is written to the shared folder.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludolens.scratch import write_scratch


def smallest_in_reach(left: np.ndarray, right: np.ndarray, size: int) -> np.ndarray:
    """For each of ``size`` nodes the smallest node that links ``left[i]`` - ``right[i]`` lead to."""
    label = np.arange(size)
    while True:
        low = np.minimum(label[left], label[right])
        following = label.copy()
        np.minimum.at(following, left, low)
        np.minimum.at(following, right, low)
        following = following[following]
        if (following == label).all():
            return label
        label = following


def forest(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fewest links that connect what the given links connect, each to the smallest node."""
    nodes, at = np.unique(np.concatenate([left, right]), return_inverse=True)
    root = smallest_in_reach(at[: len(left)], at[len(left) :], len(nodes))
    linked = root != np.arange(len(nodes))
    return nodes[linked], nodes[root[linked]]


def _thinned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        child, parent = forest(*(c.to_numpy() for c in batch.columns))
        yield pa.RecordBatch.from_arrays([pa.array(child), pa.array(parent)], ["child", "parent"])


def _state(links: DataFrame) -> tuple:
    mixed = F.pmod(F.xxhash64("child", "parent"), F.lit(1 << 31))
    return tuple(links.agg(F.count("*"), F.sum(mixed)).first())


def components(links: DataFrame, left: str = "left", right: str = "right") -> DataFrame:
    """``node`` and ``component``, the smallest node in reach, for nodes (bigint) with links to others."""
    pairs = links.select(F.col(left).cast("bigint"), F.col(right).cast("bigint")).where(
        F.col(left) != F.col(right)
    )
    stars = write_scratch(pairs.mapInArrow(_thinned, "child bigint, parent bigint").distinct())
    state = _state(stars)
    while True:
        both = stars.union(stars.select("parent", "child").toDF("child", "parent"))
        near = both.groupBy("child").agg(F.min("parent").alias("least"))
        near = near.select(F.col("child").alias("node"), F.least("child", "least").alias("least"))
        large = (
            both.where("parent > child")
            .join(near, F.col("child") == F.col("node"))
            .select(F.col("parent").alias("child"), F.col("least").alias("parent"))
            .distinct()
        )
        least = large.groupBy("child").agg(F.min("parent").alias("least"))
        small = (
            large.join(least.withColumnRenamed("child", "node"), F.col("child") == F.col("node"))
            .where("parent <> least")
            .select(F.col("parent").alias("child"), F.col("least").alias("parent"))
        )
        stars = write_scratch(small.union(least.toDF("child", "parent")).distinct())
        before, state = state, _state(stars)
        if before == state:
            return stars.toDF("node", "component")
