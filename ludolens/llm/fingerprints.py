"""Document fingerprints from prefix polynomial hashes.

A text's prefix array holds the polynomial hash of each of its prefixes, modulo two primes of 31
bits. From it the hash of any span follows by one subtraction, so spans of two
texts are compared without looking at their characters, and the longest common
extension of two positions is found by binary search.

A fingerprint keeps the prefix hashes at the multiples of a stride, which is the smallest
power of two that gives at most ``GRID`` of them, and the hash of the whole text. Two
fingerprints are compared span by span over the coarser stride: their likeness is
the share of the longer text's code points that lie in equal spans at equal places.

Neighbours in the order of keys meet by one shuffle of the texts: ranges of the order
are bounded by a sample, and the first row of each range is sent to the range before it too.

Defined cases. A NULL text is empty; two empty texts have likeness 1, an empty and
another text 0. NULL keys come first. Rows with equal keys are ordered by a hash of
their text, then by their text, so repeated rows follow each other. The only row of a
table is its own neighbour. An empty table gives an empty result. Only key and
text are read, so other columns cannot clash.
"""

from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludolens.llm.tables import bound_batches

GRID = 32

# Primes below 2^31 and a base for each.
PRIMES = (2147483647, 2147483629)
BASES = (911382323, 972663749)

_SAMPLE_PER_RANGE = 16

# Rows that a task compares before it hands the results on.
_ROWS_AT_ONCE = 200


class Prefixes(NamedTuple):
    """Prefix hashes of one text: ``hashes[m][i]`` covers its first ``i`` code points."""

    length: int
    hashes: np.ndarray


class _Powers:
    """Powers of the bases, grown as longer texts come."""

    def __init__(self) -> None:
        self.table = np.ones((len(PRIMES), 1), np.int64)

    def upto(self, n: int) -> np.ndarray:
        while self.table.shape[1] < n:
            size = self.table.shape[1]
            step = np.array([[pow(b, size, p)] for b, p in zip(BASES, PRIMES)])
            self.table = np.hstack([self.table, self.table * step % np.array(PRIMES)[:, None]])
        return self.table[:, :n]


_powers = _Powers()


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)


def prefixes(points: np.ndarray) -> Prefixes:
    hashes = np.zeros((len(PRIMES), len(points) + 1), np.int64)
    for m, prime in enumerate(PRIMES):
        terms = (points + 1) * _powers.upto(len(points))[m] % prime
        np.cumsum(terms, out=hashes[m, 1:])
    hashes %= np.array(PRIMES)[:, None]
    return Prefixes(len(points), hashes)


def edited_prefixes(text: Prefixes, keep: int, added: np.ndarray) -> Prefixes:
    """Prefix hashes of the first ``keep`` code points followed by ``added``."""
    hashes = np.empty((len(PRIMES), keep + len(added) + 1), np.int64)
    hashes[:, : keep + 1] = text.hashes[:, : keep + 1]
    for m, prime in enumerate(PRIMES):
        terms = (added + 1) * _powers.upto(keep + len(added))[m, keep:] % prime
        hashes[m, keep + 1 :] = (np.cumsum(terms) + hashes[m, keep]) % prime
    return Prefixes(keep + len(added), hashes)


def spans_equal(a: Prefixes, i: int, b: Prefixes, j: int, length: int) -> bool:
    """Whether ``length`` code points at ``i`` of one and at ``j`` of another text are equal."""
    powers = _powers.upto(max(i, j) + 1)
    for m, prime in enumerate(PRIMES):
        left = int(a.hashes[m, i + length] - a.hashes[m, i]) * int(powers[m, j]) % prime
        right = int(b.hashes[m, j + length] - b.hashes[m, j]) * int(powers[m, i]) % prime
        if left != right:
            return False
    return True


def common_extension(a: Prefixes, i: int, b: Prefixes, j: int) -> int:
    """How many code points from ``i`` and from ``j`` on are equal."""
    low, high = 0, min(a.length - i, b.length - j)
    while low < high:
        middle = (low + high + 1) // 2
        if spans_equal(a, i, b, j, middle):
            low = middle
        else:
            high = middle - 1
    return low


def _stride(length: int) -> int:
    stride = 1
    while length // stride > GRID:
        stride *= 2
    return stride


class Fingerprint(NamedTuple):
    length: int
    stride: int
    grid: np.ndarray  # prefix hashes at 0, stride, 2 * stride, ...
    whole: np.ndarray

    def text(self) -> str:
        """Length and the hashes in hex; the stride follows from the length."""
        hashes = np.hstack([self.grid[:, 1:], self.whole[:, None]])
        return f"{self.length:x}:" + (hashes[0] << 31 | hashes[1]).astype(">u8").tobytes().hex()


def fingerprint(text: Prefixes) -> Fingerprint:
    stride = _stride(text.length)
    return Fingerprint(text.length, stride, text.hashes[:, ::stride], text.hashes[:, -1])


def parse_fingerprint(written: str) -> Fingerprint:
    length, hashes = written.split(":")
    packed = np.frombuffer(bytes.fromhex(hashes), ">u8").astype(np.int64)
    both = np.stack([packed >> 31, packed & (1 << 31) - 1])
    start = np.zeros((2, 1), np.int64)
    size = int(length, 16)
    return Fingerprint(size, _stride(size), np.hstack([start, both[:, :-1]]), both[:, -1])


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    """Share of the longer text in spans equal to those at the same place of the other."""
    if a.length == b.length and (a.whole == b.whole).all():
        return 1.0
    if not a.length or not b.length:
        return 0.0
    stride = max(a.stride, b.stride)
    left, right = a.grid[:, :: stride // a.stride], b.grid[:, :: stride // b.stride]
    cells = min(left.shape[1], right.shape[1])
    primes = np.array(PRIMES)
    spans = (np.diff(left[:, :cells]) - np.diff(right[:, :cells])) % primes[:, None]
    equal = int((spans == 0).all(0).sum()) * stride
    if a.length == b.length:
        last = (a.whole - left[:, cells - 1] - b.whole + right[:, cells - 1]) % primes
        equal += (a.length - (cells - 1) * stride) * bool((last == 0).all())
    return min(1.0, equal / max(a.length, b.length))


def _by_ranges(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, text, part and ``after``: rows by range of the order, each range ended by the next row."""
    spark = docs.sparkSession
    bound_batches(spark)
    rows = docs.select(
        F.col(key).alias("key"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).withColumn("tie", F.xxhash64("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    share = min(1.0, parts * _SAMPLE_PER_RANGE / max(1, docs.count()))
    picked = F.pmod(F.xxhash64("key", "tie"), F.lit(1 << 20)) < F.lit(share * (1 << 20))
    sample = sorted(_order(r["key"], r["tie"]) for r in rows.where(picked).select("key", "tie").collect())
    bounds = sorted({sample[len(sample) * i // parts] for i in range(1, parts)}) if sample else []

    @F.arrow_udf("int")
    def part_of(keys: pa.Array, ties: pa.Array) -> pa.Array:
        rows = zip(keys.to_pylist(), ties.to_pylist())
        return pa.array([bisect_right(bounds, _order(k, t)) for k, t in rows], pa.int32())

    placed = rows.withColumn("part", part_of("key", "tie"))
    firsts = placed.groupBy("part").agg(F.min(F.struct(F.col("key").isNotNull(), "key", "tie")).alias("first"))
    first = {r["part"]: r["first"] for r in firsts.collect()}
    filled = sorted(first)
    before = [(first[p], filled[i - 1]) for i, p in enumerate(filled)]
    if not before:
        return placed.select("key", "text", "tie", "part", F.lit(False).alias("after"))
    heads = spark.createDataFrame(
        [(p, (f["key"] is None), f["key"], f["tie"], b) for (f, b), p in zip(before, filled)],
        f"head int, nothing boolean, head_key {docs.schema[key].dataType.simpleString()}, head_tie bigint, before int",
    )
    # One row for each range; the driver made it, so its size is known.
    ends = placed.join(
        F.broadcast(heads),
        (F.col("part") == F.col("head")) & F.col("key").eqNullSafe(F.col("head_key")) & (F.col("tie") == F.col("head_tie")),
    ).select("key", "text", "tie", F.col("before").alias("part"), F.lit(True).alias("after"))
    own = placed.select("key", "text", "tie", "part", F.lit(False).alias("after"))
    return own.union(ends).repartition(parts, "part").sortWithinPartitions(
        "part", "after", F.col("key").asc_nulls_first(), "tie", "text"
    )


def _order(key, tie: int) -> tuple:
    missing = key is None or key != key
    return (not missing, 0 if missing else key, tie)


def _edit(text: str, following: str) -> tuple[int, str]:
    cut = len(text) // 4
    return len(text) - cut, following[:cut]


def with_neighbours(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint each text, the text edited with its neighbour, and how like they are.

    Returns key, n_chars, fingerprint, edited_text, edited_fingerprint, near_edited, near_next,
    and the exact common prefixes prefix_edited and prefix_next.
    """
    kind = docs.schema[key].dataType.simpleString()
    fields = {
        "n_chars": pa.int64(),
        "fingerprint": pa.string(),
        "edited_text": pa.string(),
        "edited_fingerprint": pa.string(),
        "near_edited": pa.float64(),
        "near_next": pa.float64(),
        "prefix_edited": pa.int64(),
        "prefix_next": pa.int64(),
    }

    def compare(text: str, own: Prefixes, following: str, after: Prefixes) -> tuple:
        keep, added = _edit(text, following)
        changed = edited_prefixes(own, keep, code_points(added))
        mine, edited, theirs = fingerprint(own), fingerprint(changed), fingerprint(after)
        return (
            own.length,
            mine.text(),
            text[:keep] + added,
            edited.text(),
            likeness(mine, edited),
            likeness(mine, theirs),
            common_extension(own, 0, changed, 0),
            common_extension(own, 0, after, 0),
        )

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None  # the row whose neighbour comes next
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS_AT_ONCE):
                part = batch.slice(at, _ROWS_AT_ONCE)
                keys, found = [], []
                columns = [part.column(c).to_pylist() for c in ("key", "text", "after")]
                for key_value, own_text, after in zip(*columns):
                    if waiting is None and after:
                        continue
                    own = prefixes(code_points(own_text))
                    if waiting is not None:
                        keys.append(waiting[0])
                        found.append(compare(waiting[1], waiting[2], own_text, own))
                    waiting = None if after else (key_value, own_text, own)
                if found:
                    made = [pa.array(column, kind) for column, kind in zip(zip(*found), fields.values())]
                    named = [pa.array(keys, batch.column("key").type), *made]
                    yield pa.RecordBatch.from_arrays(named, ["key", *fields])

    schema = "n_chars bigint, fingerprint string, edited_text string, edited_fingerprint string, near_edited double, near_next double, prefix_edited bigint, prefix_next bigint"
    ranged = _by_ranges(docs, key, text)
    return ranged.mapInArrow(each, f"key {kind}, {schema}").withColumnRenamed("key", key)


def sha256_hex(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


