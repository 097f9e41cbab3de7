"""Near-duplicate documents by dart hashing of weighted shingles.

Every element of a document is a column of height 1 that darts hit at random times, the
same times in every document that holds the element. A document takes the darts that hit it before a
time set by its total weight, so the work is one step per element and a fixed number of
darts, however large the signature is. Each dart belongs to one coordinate, whose
value is its earliest dart: two documents agree in a coordinate with the probability of their weighted
Jaccard similarity. A document with a coordinate left empty waits twice as long.

Documents whose signatures agree in all rows of a band are compared exactly. Equal texts
are one document before that, and bands with the same members are one bucket. A large bucket is cut into
blocks that meet pair by pair in groups of bounded size; a group counts common elements by a
matrix product and returns the fewest links that connect its documents, so no list of pairs is ever made.

With ``ROWS`` 6 and ``BANDS`` 40 a pair at similarity 0.8 shares no band, and is lost,
with a chance of 5 in a million; more similar pairs are safer. No bucket is capped.

Defined cases. Texts are compared in lower case, by words between ASCII white space. Equal texts
are duplicates whatever their length, so all empty texts are one class. A text without words is like
no other text. A NULL text is in no class but its own, and so is a row with a NULL key, which has a NULL
class. Rows that share a key are one document. An empty table gives an empty result. Only key and text are read.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludolens.llm.components import components, forest
from ludolens.llm.shingles import mixed, shingle_elements
from ludolens.llm.tables import bound_batches
from ludolens.scratch import broadcast_small, write_scratch

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 40
ROWS = 6

# Documents in a block, and characters in a block, of a large bucket.
_BLOCK_TEXTS = 512
_BLOCK_CHARS = 8 << 20
_CHARS_AT_ONCE = 1 << 21
_COLUMNS_AT_ONCE = 2048

_U = np.uint64
_EMPTY = _U((1 << 64) - 1)
_TIME, _COORDINATE, _NAME = (_U(x) for x in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3))


def _earliest(hashes: np.ndarray, text: np.ndarray, until: np.ndarray, size: int) -> np.ndarray:
    """Earliest dart of each coordinate of each text, among darts before ``until[text]``."""
    found = np.full(len(until) * size, _EMPTY, np.uint64)
    time = np.zeros(len(hashes))
    nth = 0
    while len(hashes):
        nth += 1
        seed = hashes + _U(nth * 0x9E3779B97F4A7C15 % (1 << 64))
        chance = ((mixed(seed ^ _TIME) >> _U(11)).astype(np.float64) + 0.5) * 2.0**-53
        time = time - np.log(chance)
        hit = time < until[text]
        hashes, text, time, seed = hashes[hit], text[hit], time[hit], seed[hit]
        coordinate = (mixed(seed ^ _COORDINATE) % _U(size)).astype(np.int64)
        # Times are positive, so their bits order like they do; the name makes the value.
        dart = time.astype(np.float32).view(np.uint32).astype(np.uint64) << _U(32)
        dart |= mixed(seed ^ _NAME) >> _U(32)
        np.minimum.at(found, text * size + coordinate, dart)
    return found.reshape(-1, size)


def signatures(texts: list[str], size: int = BANDS * ROWS, shingle: int = SHINGLE) -> np.ndarray:
    """One row of ``size`` values per text; a text without words has an undefined row."""
    elements = shingle_elements(texts, shingle)
    weight = np.diff(elements.start)
    out = np.full((len(texts), size), _EMPTY, np.uint64)
    todo = np.flatnonzero(weight)
    darts = size * np.log(size) + 2 * size
    while len(todo):
        which = np.full(len(texts), -1)
        which[todo] = np.arange(len(todo))
        owner = which[elements.text()]
        mine = owner >= 0
        out[todo] = _earliest(elements.hashes[mine], owner[mine], darts / weight[todo], size)
        todo = todo[(out[todo] == _EMPTY).any(1)]
        darts *= 2
    return out


def band_hashes(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    number = np.arange(1, bands + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15)
    value = np.broadcast_to(number, (len(signature), bands)).copy()
    parts = signature.reshape(-1, bands, rows)
    for i in range(rows):
        value = mixed(value ^ parts[:, :, i])
    return value.view(np.int64)


def similar_pairs(
    texts: list[str], first: np.ndarray, second: np.ndarray, similarity: float, shingle: int = SHINGLE
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a text of ``first`` and one of ``second`` that are similar enough, exactly."""
    elements = shingle_elements(texts, shingle)
    weight = np.diff(elements.start)
    _, column, counts = np.unique(elements.hashes, return_inverse=True, return_counts=True)
    common = counts > 1
    renumbered = np.cumsum(common) - 1
    text, column = elements.text()[common[column]], renumbered[column[common[column]]]
    order = np.argsort(column, kind="stable")
    text, column = text[order], column[order]
    shared = np.zeros((len(first), len(second)), np.float32)
    total = int(common.sum())
    for low in range(0, total, _COLUMNS_AT_ONCE):
        width = min(_COLUMNS_AT_ONCE, total - low)
        begin, end = np.searchsorted(column, [low, low + width])
        held = np.zeros((len(texts), width), np.float32)
        held[text[begin:end], column[begin:end] - low] = 1
        shared += held[first] @ held[second].T
    union = weight[first][:, None] + weight[second] - shared
    # Whole numbers up to 2^24 are exact here; ``tenths`` avoids rounding at the threshold.
    i, j = np.nonzero((shared >= np.float64(similarity) * union - 1e-9) & (shared > 0))
    return first[i], second[j]


def _batches(texts: list[str]) -> Iterator[tuple[int, int]]:
    start = total = 0
    for i, text in enumerate(texts):
        if total and total + len(text) > _CHARS_AT_ONCE:
            yield start, i
            start, total = i, 0
        total += len(text)
    if texts:
        yield start, len(texts)


def near_duplicates(
    docs: DataFrame,
    similarity: float = SIMILARITY,
    shingle: int = SHINGLE,
    bands: int = BANDS,
    rows: int = ROWS,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``key`` and ``class_id``, the smallest key of the row's class, once per row of ``docs``."""
    bound_batches(docs.sparkSession)
    named = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text")).where(
        "key is not null and text is not null"
    )

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for start, end in _batches(texts):
                part = texts[start:end]
                signed = signatures(part, bands * rows, shingle)
                hashes = band_hashes(signed, bands, rows).tolist()
                worded = (signed != _EMPTY).all(1)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, end - start),
                        batch.column(1).slice(start, end - start),
                        pa.array([len(t) for t in part], pa.int64()),
                        pa.array([h if w else [] for h, w in zip(hashes, worded)], pa.list_(pa.int64())),
                    ],
                    ["key", "digest", "chars", "bands"],
                )

    sketched = write_scratch(
        named.select("key", F.md5("text").alias("digest"), "text").mapInArrow(
            sketch, "key bigint, digest string, chars bigint, bands array<bigint>"
        )
    )
    # Equal texts become one: the smallest key stands for them.
    equal = write_scratch(sketched.groupBy("digest").agg(F.min("key").alias("node")))
    firsts = sketched.join(equal, (sketched["digest"] == equal["digest"]) & (F.col("key") == F.col("node")))
    banded = firsts.select("node", "chars", F.explode("bands").alias("bucket"))
    members_hash = F.xxhash64("node")
    buckets = (
        banded.groupBy("bucket")
        .agg(
            F.count("*").alias("n"),
            F.sum("chars").alias("chars"),
            F.bit_xor(members_hash).alias("members"),
            F.bit_xor(F.xxhash64("node", F.lit(1))).alias("also"),
        )
        .where("n > 1")
        .groupBy("n", "chars", "members", "also")
        .agg(F.min("bucket").alias("bucket"))
        .select(
            "bucket",
            F.greatest(
                F.ceil(F.col("n") / F.lit(_BLOCK_TEXTS)), F.ceil(F.col("chars") / F.lit(_BLOCK_CHARS))
            ).alias("blocks"),
        )
    )
    met = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("other")
    members = write_scratch(
        banded.join(broadcast_small(write_scratch(buckets)), "bucket")
        .withColumn("block", F.pmod(F.xxhash64("node", "bucket"), "blocks"))
        .select("node", "bucket", "block", met)
        .select(
            "node",
            "bucket",
            "block",
            F.least("block", "other").alias("low"),
            F.greatest("block", "other").alias("high"),
        )
    )
    texts = named.join(broadcast_small(members), F.col("key") == F.col("node")).select(
        "bucket", "low", "high", "block", "node", "text"
    )

    def compare(group: pa.Table) -> pa.Table:
        node, block = group["node"].to_numpy(), group["block"].to_numpy()
        low, high = group["low"][0].as_py(), group["high"][0].as_py()
        first, second = np.flatnonzero(block == low), np.flatnonzero(block == high)
        i, j = similar_pairs(group["text"].to_pylist(), first, second, similarity, shingle)
        child, parent = forest(node[i], node[j])
        return pa.table({"child": child, "parent": parent})

    links = texts.groupBy("bucket", "low", "high").applyInArrow(compare, "child bigint, parent bigint")
    # Written, as thinning them in the same task takes a second Python worker. Spark uses idle workers in turn, so each
    # of twice as many would come to hold what later stages remember.
    reach = components(write_scratch(links), "child", "parent")
    classes = equal.join(reach, "node", "left").select(
        "digest", F.coalesce("component", "node").alias("class_id")
    )
    every = docs.select(
        F.col(key).cast("bigint").alias("key"), F.when(F.col(key).isNotNull(), F.md5(text)).alias("digest")
    )
    return every.join(classes, "digest", "left").select(
        F.col("key").alias(key), F.coalesce("class_id", "key").alias("class_id")
    )
