"""Near-duplicate vectors by products of quantised tiles.

Vectors of one label are compared tile by tile. Each unit vector is rounded to
8-bit steps of its own scale, and the length of what rounding left off is kept. A product of
two rounded vectors, which is exact, then lies within ``e_a + e_b + e_a * e_b`` of the true
cosine, so every pair whose bound stays under the threshold is out for certain; only the other
pairs are computed again in double precision from the vectors as given.

Equal vectors of a label are taken as one with a count. A pair of tiles returns
sums of links per vector and the fewest links that connect its vectors, not its pairs,
so a large group of near copies does not grow the result. Every pair of tiles of a label is its own
group: work is split evenly, but it grows with the square of a label's distinct vectors.

Defined cases. Vectors that are NULL, zero or hold NULL or non-finite components link with
nothing, as do rows with a NULL label or a NULL key; vectors of different length never
link. Repeated rows link with each other. Rows that share a key but not
their vector are told apart, and the key stands for both in components. A row without links is its own
component and kept. An empty table gives an empty result. Only the named columns are read.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludolens.llm.components import components, forest
from ludolens.scratch import write_scratch

THRESHOLD = 0.98
TILE = 512

# Covers the rounding of the double arithmetic that makes the bounds.
_SLACK = 1e-9
_PAIRS_AT_ONCE = 1 << 15
_EXACT_IN_FLOAT = 1 << 24


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whole numbers of at most 127, the scale of each vector, and the length of its error."""
    scale = np.abs(unit).max(1) / 127.0
    steps = np.rint(unit / scale[:, None]).astype(np.int8)
    error = np.linalg.norm(unit - steps * scale[:, None], axis=1)
    return steps, scale, error


def linked_pairs(a: np.ndarray, b: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``a`` and of ``b`` whose cosine, in double precision, reaches ``threshold``."""
    a, b = a.astype(np.float64), b.astype(np.float64)
    # Dividing by the largest component first keeps squares of any finite vector in range.
    a, b = a / np.abs(a).max(1, keepdims=True), b / np.abs(b).max(1, keepdims=True)
    length_a, length_b = np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1)
    steps_a, scale_a, error_a = quantise(a / length_a[:, None])
    steps_b, scale_b, error_b = quantise(b / length_b[:, None])
    exact = np.float32 if a.shape[1] * 127 * 127 < _EXACT_IN_FLOAT else np.float64
    product = (steps_a.astype(exact) @ steps_b.astype(exact).T).astype(np.float64)
    product *= scale_a[:, None] * scale_b
    product += error_a[:, None] + error_b + error_a[:, None] * error_b + _SLACK
    i, j = np.nonzero(product >= threshold)
    reached = np.zeros(len(i), bool)
    for at in range(0, len(i), _PAIRS_AT_ONCE):
        part = slice(at, at + _PAIRS_AT_ONCE)
        dots = np.einsum("ij,ij->i", a[i[part]], b[j[part]])
        reached[part] = dots / (length_a[i[part]] * length_b[j[part]]) >= threshold
    return i[reached], j[reached]


def link(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    tile: int = TILE,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """key, n_links, component_id and kept for every row of ``vectors``."""
    rows = vectors.select(
        F.col(key).cast("bigint").alias("key"), F.col(label).alias("label"), F.col(vector).alias("vector")
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = (
        F.col("key").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite, F.lit(False))
        & F.coalesce(F.exists("vector", lambda x: x != 0), F.lit(False))
    )
    # Not-a-number stands for no vector here, so that rows of it are never grouped as equal.
    classes = write_scratch(
        rows.where(usable)
        .groupBy("label", "vector")
        .agg(F.min("key").alias("node"), F.count("*").alias("copies"))
        .withColumn("mark", F.xxhash64("label", "vector"))
    )
    width = F.size("vector").alias("width")
    tiles = classes.groupBy("label", width).agg(F.ceil(F.count("*") / F.lit(tile)).alias("tiles"))
    tiled = (
        classes.withColumn("width", F.size("vector"))
        .join(tiles, ["label", "width"])
        .withColumn("tile", F.pmod("mark", F.col("tiles")))
    )
    met = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("tiles") - 1)).alias("other")
    pairs = tiled.select("*", met).select(
        "label",
        "width",
        F.least("tile", "other").alias("low"),
        F.greatest("tile", "other").alias("high"),
        "tile",
        "node",
        "mark",
        "copies",
        "vector",
    )

    def compare(group: pa.Table) -> pa.Table:
        order = np.argsort(group["tile"].to_numpy(), kind="stable")
        node, mark, copies = (group[c].to_numpy()[order] for c in ("node", "mark", "copies"))
        values = group["vector"].combine_chunks()
        matrix = values.flatten().to_numpy(zero_copy_only=False).reshape(len(order), -1)[order]
        if group["low"][0].as_py() == group["high"][0].as_py():
            i, j = linked_pairs(matrix, matrix, threshold)
            one_way = i != j
            i, j = i[one_way], j[one_way]
            sums = np.bincount(i, copies[j], len(order))
        else:
            cut = int((group["tile"].to_numpy() == group["low"][0].as_py()).sum())
            if cut in (0, len(order)):
                i = j = np.zeros(0, np.int64)
            else:
                i, j = linked_pairs(matrix[:cut], matrix[cut:], threshold)
                j = j + cut
            sums = np.bincount(i, copies[j], len(order)) + np.bincount(j, copies[i], len(order))
        child, parent = forest(i, j)
        found = np.flatnonzero(sums)
        none = pa.nulls(len(found), pa.int64())
        return pa.table(
            {
                "node": np.concatenate([node[found], node[child]]),
                "mark": np.concatenate([mark[found], mark[child]]),
                "links": np.concatenate([sums[found].astype(np.int64), np.zeros(len(child), np.int64)]),
                "parent": pa.chunked_array([none, pa.array(node[parent], pa.int64())]),
            }
        )

    found = write_scratch(
        pairs.groupBy("label", "width", "low", "high").applyInArrow(
            compare, "node bigint, mark bigint, links bigint, parent bigint"
        )
    )
    links = found.groupBy("node", "mark").agg(F.sum("links").alias("links"))
    reach = components(found.where("parent is not null"), "node", "parent")
    results = (
        classes.join(links, ["node", "mark"], "left")
        .join(reach, "node", "left")
        .select(
            F.col("label").alias("_label"),
            F.col("vector").alias("_vector"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("component"),
        )
    )
    same = (F.col("label") == F.col("_label")) & (F.col("vector") == F.col("_vector")) & usable
    component = F.coalesce("component", "key")
    return rows.join(results, same, "left").select(
        F.col("key").alias(key),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("key") == component, F.lit(True)).alias("kept"),
    )
