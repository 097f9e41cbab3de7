"""Removal of repeated byte strings across documents by suffix order.

Suffixes can only have a common prefix of ``length`` bytes if that prefix has the same rarest window: of
all windows of ``WINDOW`` bytes inside it, the one with the lowest hash. So neighbouring
places with one rarest window form a run, and a run whose window occurs nowhere else is out at
once: this only counts hashes, never text. The other runs are sent to buckets by their window,
with the bytes their suffixes need. Each bucket of bounded size sorts its suffixes
by the difference cover algorithm and compares the prefixes of neighbours, byte by byte.
All places that could match meet in one bucket, so the result is that of one suffix array over all texts.

A window in more than ``HOT_RUNS`` runs would make too large a bucket. Its places are
spread by two 64-bit hashes of their whole prefix instead: each task first settles what repeats
among its own rows and passes on one entry per different prefix, so a passage in a third of all documents is
one entry per task.

Equal texts are one document: their bytes all repeat, and only the first takes part in the sort.

Defined cases. A NULL text is empty and has nothing removed. Texts shorter than ``length``
have nothing to remove. NULL and repeated keys are rows like any other. An empty table gives an empty
result. Only key and text are read, so other columns cannot clash. What is kept is bytes, as a
cut may fall inside a character. A long text is hashed in stretches that overlap by ``length - 1`` bytes, so each
place belongs to one stretch; a run cut in two there only means one more piece to sort.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludolens.llm.shingles import mixed
from ludolens.llm.suffixes import repeated_starts
from ludolens.llm.tables import bound_batches
from ludolens.scratch import broadcast_small, write_scratch

LENGTH = 400
WINDOW = 64
# A bucket gets about BUCKET_RUNS runs, and runs of one window up to HOT_RUNS besides; a run
# has under 2 * LENGTH bytes.
BUCKET_RUNS = 1_000
HOT_RUNS = 6_000

_U = np.uint64
_BYTES_AT_ONCE = 1 << 21
_PLACE_BITS = 24
# Runs settled together in one task, and entries it remembers and a group is expected to have.
_HOT_ROWS = 2_000
_HOT_ENTRIES = 500_000


def window_hashes(data: np.ndarray, width: int, seed: int) -> np.ndarray:
    """A hash of the ``width`` bytes from every place on, made from those of halves."""
    table = mixed(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15) + _U(seed))
    sized, size = table[data], 1
    out, done = None, 0
    while True:
        if width & size:
            if out is None:
                out = sized
            else:
                rest = sized[done:]
                out = mixed(out[: len(rest)] * _U(0x9FB21C651E98DF25) + rest)
            done += size
        if done == width:
            return out[: max(0, len(data) - width + 1)]
        if len(sized) <= size:
            return np.zeros(0, np.uint64)
        sized = sized[:-size] * _U(0xD6E8FEB86659FD93) + sized[size:]
        sized ^= sized >> _U(29)
        size *= 2


def _sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    count = len(values) - width + 1
    padded = np.concatenate([values, np.full(-len(values) % width, _U((1 << 64) - 1))]).reshape(-1, width)
    forward = np.minimum.accumulate(padded, axis=1).ravel()
    backward = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:count], forward[width - 1 : width - 1 + count])


def runs_of(texts: list[bytes], length: int, window: int) -> tuple[np.ndarray, ...]:
    """Text, first place, number of places and window hash of each run.

    The texts have ``1 << _PLACE_BITS`` bytes at most together.
    """
    sizes = np.array([len(t) for t in texts])
    start = np.concatenate([[0], np.cumsum(sizes)])
    data = np.frombuffer(b"".join(texts), np.uint8)
    if len(data) > 1 << _PLACE_BITS:
        raise ValueError("more bytes than places")
    if len(data) < length:
        return (np.zeros(0, np.int64),) * 4
    hashes = window_hashes(data, window, 1)
    low = _U((1 << _PLACE_BITS) - 1)
    ordered = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    rarest = (_sliding_minimum(ordered, length - window + 1) & low).astype(np.int64)
    text = np.repeat(np.arange(len(texts)), np.maximum(0, sizes - length + 1))
    first = np.concatenate([[0], np.cumsum(np.maximum(0, sizes - length + 1))])
    place = np.arange(len(text)) - first[text]
    at = rarest[start[text] + place]
    fresh = np.ones(len(at), bool)
    fresh[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1])
    begins = np.flatnonzero(fresh)
    counts = np.diff(np.append(begins, len(at)))
    return text[begins], place[begins], counts, mixed(hashes[at[begins]]).view(np.int64)


def _stretches(texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Text, first place and bytes of stretches, in lists of bounded size."""
    most = min(max(_BYTES_AT_ONCE, 2 * length), 1 << _PLACE_BITS)
    if most < length:
        raise ValueError(f"length must be {most} at most")
    part, total = [], 0
    for i, text in enumerate(texts):
        for start in range(0, max(1, len(text) - length + 1), most - length + 1):
            stretch = text[start : start + most]
            if part and total + len(stretch) > most:
                yield part
                part, total = [], 0
            part.append((i, start, stretch))
            total += len(stretch)
    if part:
        yield part


def all_runs(texts: list[bytes], length: int, window: int) -> Iterator[tuple[np.ndarray, ...]]:
    """What ``runs_of`` gives, part by part, for texts of any length."""
    for part in _stretches(texts, length):
        numbers, starts = (np.array(c, np.int64) for c in list(zip(*part))[:2])
        stretch, first, own, window_hash = runs_of([p[2] for p in part], length, window)
        yield numbers[stretch], starts[stretch] + first, own, window_hash


def covered(starts: np.ndarray, length: int) -> np.ndarray:
    """Maximal covered ranges of the strings at ``starts`` (ascending), as rows of begin and end."""
    if not len(starts):
        return np.zeros((0, 2), np.int64)
    gap = np.flatnonzero(np.diff(starts) > length)
    begin = starts[np.concatenate([[0], gap + 1])]
    return np.stack([begin, starts[np.append(gap, len(starts) - 1)] + length], 1)


def _ranges(digests: list[bytes], firsts: list[int], found: list[np.ndarray], length: int) -> list[tuple]:
    return [
        (digest, int(first + begin), int(first + end))
        for digest, first, starts in zip(digests, firsts, found)
        for begin, end in covered(starts, length)
    ]


def _table(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[], [], []]
    kinds = {"digest": pa.binary(), "begin": pa.int64(), "end": pa.int64()}
    return pa.table({n: pa.array(list(c), k) for (n, k), c in zip(kinds.items(), columns)})


def _settled(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries with a place whose prefix occurs again, and one entry per prefix for others to meet.

    An entry is two hashes of a prefix, the digest in two halves, and the place or -1.
    """
    entries = entries[np.lexsort(entries[:, :2].T)]
    fresh = np.ones(len(entries), bool)
    fresh[1:] = (entries[1:, :2] != entries[:-1, :2]).any(1)
    begins = np.flatnonzero(fresh)
    counts = np.diff(np.append(begins, len(entries)))
    placed = entries[:, 4].view(np.int64) >= 0
    found = entries[np.repeat(counts > 1, counts) & placed]
    left = entries[begins]
    left[counts > 1, 4] = np.array(-1, np.int64).view(np.uint64)
    return found, left


def _entry_ranges(found: np.ndarray, length: int) -> list[tuple]:
    """Covered ranges of entries with places."""
    order = np.lexsort((found[:, 4].view(np.int64), found[:, 3], found[:, 2]))
    found = found[order]
    other = np.flatnonzero((found[1:, 2:4] != found[:-1, 2:4]).any(1)) + 1
    return [
        (part[0, 2:4].tobytes(), int(begin), int(end))
        for part in np.split(found, other)
        if len(part)
        for begin, end in covered(part[:, 4].view(np.int64), length)
    ]


def _hot_ranges(runs: DataFrame, length: int, parts: int) -> DataFrame:
    """Covered ranges of runs whose windows are in very many runs."""

    def entries_of(batch: pa.RecordBatch) -> np.ndarray:
        digests, firsts, owns, pieces = (c.to_pylist() for c in batch.columns)
        hashed = {
            piece: np.stack([window_hashes(np.frombuffer(piece, np.uint8), length, s) for s in (2, 3)], 1)
            for piece in set(pieces)
        }
        owns = np.array(owns)
        row = np.repeat(np.arange(len(owns)), owns)
        place = np.arange(len(row)) - np.repeat(np.cumsum(owns) - owns, owns)
        ids = np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)[row]
        at = (np.array(firsts)[row] + place).astype(np.int64).view(np.uint64)
        hashes = np.concatenate([hashed[p][:n] for p, n in zip(pieces, owns)])
        return np.concatenate([hashes, ids, at[:, None]], 1)

    def out(ranges: list[tuple], numbers: list[int], blobs: list[bytes]) -> pa.RecordBatch:
        n, m = len(ranges), len(blobs)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([None] * n + numbers, pa.int64()),
                pa.array([None] * n + blobs, pa.binary()),
                pa.array([r[0] for r in ranges] + [None] * m, pa.binary()),
                pa.array([r[1] for r in ranges] + [None] * m, pa.int64()),
                pa.array([r[2] for r in ranges] + [None] * m, pa.int64()),
            ],
            ["part", "entries", "digest", "begin", "end"],
        )

    def passed_on(left: np.ndarray) -> pa.RecordBatch:
        part = (left[:, 0] % _U(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        cuts = np.flatnonzero(np.diff(part[order])) + 1
        blobs = [e.tobytes() for e in np.split(left[order], cuts)]
        return out([], part[order][np.concatenate([[0], cuts])].tolist(), blobs)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # What repeats within the task is settled here, before anything is passed on.
        kept = np.zeros((0, 5), np.uint64)
        for batch in (b.slice(at, _HOT_ROWS) for b in batches for at in range(0, b.num_rows, _HOT_ROWS)):
            found, kept = _settled(np.concatenate([kept, entries_of(batch)]))
            yield out(_entry_ranges(found, length), [], [])
            if len(kept) > _HOT_ENTRIES:
                yield passed_on(kept)
                kept = kept[:0]
        if len(kept):
            yield passed_on(kept)

    def settle(group: pa.Table) -> pa.Table:
        entries = np.frombuffer(b"".join(group["entries"].to_pylist()), "<u8").reshape(-1, 5)
        return _table(_entry_ranges(_settled(entries)[0], length))

    spread_out = write_scratch(
        runs.select("digest", "first", "own", "piece").mapInArrow(
            spread, "part bigint, entries binary, digest binary, begin bigint, end bigint"
        )
    )
    later = spread_out.where("part is not null").groupBy("part").applyInArrow(
        settle, "digest binary, begin bigint, end bigint"
    )
    return spread_out.where("part is null").select("digest", "begin", "end").union(later)


def repeated_ranges(
    docs: DataFrame, length: int = LENGTH, window: int = WINDOW, hot_runs: int = HOT_RUNS
) -> DataFrame:
    """Covered ranges, by digest, of the texts of ``docs`` (digest binary, text string)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = batch.column(0)
            texts = [t.encode("utf-8", "surrogatepass") for t in batch.column(1).to_pylist()]
            for text, first, own, window_hash in all_runs(texts, length, window):
                yield pa.RecordBatch.from_arrays(
                    [
                        digests.take(pa.array(text, pa.int64())),
                        pa.array(first, pa.int64()),
                        pa.array(own, pa.int64()),
                        pa.array(window_hash, pa.int64()),
                    ],
                    ["digest", "first", "own", "window"],
                )

    long_enough = docs.where(F.octet_length("text") >= length)
    runs = write_scratch(
        long_enough.select("digest", "text").mapInArrow(
            find, "digest binary, first bigint, own bigint, window bigint"
        )
    )
    shared = write_scratch(runs.groupBy("window").count().where("count > 1"))
    cold = shared.where(F.col("count") <= hot_runs).agg(F.sum("count")).first()[0] or 0
    hot = shared.where(F.col("count") > hot_runs).agg(F.sum("count")).first()[0] or 0
    buckets = max(1, -(-cold // min(hot_runs, BUCKET_RUNS)))
    bucket = F.when(F.col("count") <= hot_runs, F.pmod(F.xxhash64("window"), F.lit(buckets)))
    wanted = write_scratch(
        runs.join(broadcast_small(shared), "window")
        .groupBy("digest")
        .agg(F.collect_list(F.struct("first", "own", bucket.alias("bucket"))).alias("runs"))
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for digest, text, runs in zip(*(c.to_pylist() for c in batch.columns)):
                data = text.encode("utf-8", "surrogatepass")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r["bucket"] for r in runs], pa.int64()),
                        pa.array([digest] * len(runs), pa.binary()),
                        pa.array([r["first"] for r in runs], pa.int64()),
                        pa.array([r["own"] for r in runs], pa.int64()),
                        pa.array([data[r["first"] : r["first"] + r["own"] + length - 1] for r in runs], pa.binary()),
                    ],
                    ["bucket", "digest", "first", "own", "piece"],
                )

    # Lists of runs grow with the texts, so both sides are shuffled at every size.
    pieces = (
        long_enough.join(wanted.withColumnRenamed("digest", "wanted"), F.col("digest") == F.col("wanted"))
        .select("digest", "text", "runs")
        .mapInArrow(cut, "bucket bigint, digest binary, first bigint, own bigint, piece binary")
    )
    if hot:
        # Both ways read them.
        pieces = write_scratch(pieces)

    def sort(group: pa.Table) -> pa.Table:
        digests, firsts, pieces = (group[c].to_pylist() for c in ("digest", "first", "piece"))
        found = repeated_starts(pieces, group["own"].to_numpy(), length)
        return _table(_ranges(digests, firsts, found, length))

    ranges = (
        pieces.where("bucket is not null")
        .groupBy("bucket")
        .applyInArrow(sort, "digest binary, begin bigint, end bigint")
    )
    if not hot:
        return ranges
    # A run has half as many places as a string has windows.
    parts = max(1, -(-hot * (length - window + 1) // 2 // _HOT_ENTRIES))
    return ranges.union(_hot_ranges(pieces.where("bucket is null"), length, parts))


def remove_repeats(
    docs: DataFrame,
    length: int = LENGTH,
    window: int = WINDOW,
    hot_runs: int = HOT_RUNS,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """key, n_bytes, n_removed, n_spans, removed (begin and end of each span) and kept (bytes) per row."""
    if length < max(8, window):
        raise ValueError("length must be 8 at least, and no shorter than the window")
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn(
        "digest", F.unhex(F.md5(F.col("text").cast("binary")))
    )
    equal = write_scratch(
        rows.groupBy("digest").agg(F.min("key").alias("least"), F.count("*").alias("copies"))
    )
    # Rows that share key and text may pass together; their text is repeated anyway.
    named = equal.select(F.col("digest").alias("_digest"), "least")
    chosen = rows.join(
        broadcast_small(named), (F.col("digest") == F.col("_digest")) & F.col("key").eqNullSafe(F.col("least")), "left_semi"
    )
    ranges = write_scratch(repeated_ranges(chosen, length, window, hot_runs))
    by_text = equal.join(
        ranges.groupBy("digest").agg(F.array_distinct(F.collect_list(F.struct("begin", "end"))).alias("ranges")),
        "digest",
        "left",
    ).where("copies > 1 or ranges is not null")
    found = write_scratch(by_text.select(F.col("digest").alias("_digest"), "copies", "ranges"))
    kind = docs.schema[key].dataType.simpleString()
    spans = pa.list_(pa.struct({"begin": pa.int64(), "end": pa.int64()}))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in range(0, batch.num_rows, 200):
                rows = batch.slice(part, 200)
                out = []
                for content, copies, ranges in zip(*(c.to_pylist() for c in rows.columns[1:])):
                    data = content.encode("utf-8", "surrogatepass")
                    whole = copies is not None and copies > 1 and len(data) >= length
                    merged: list[list[int]] = []
                    for begin, end in [(0, len(data))] if whole else sorted((r["begin"], r["end"]) for r in ranges or []):
                        if merged and begin <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], end)
                        else:
                            merged.append([begin, end])
                    edges = [0, *(e for span in merged for e in span), len(data)]
                    kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
                    spans_made = [{"begin": a, "end": b} for a, b in merged]
                    out.append((len(data), len(data) - len(kept), len(merged), spans_made, kept))
                kinds = [pa.int64(), pa.int64(), pa.int64(), spans, pa.binary()]
                made = [pa.array(list(c), k) for c, k in zip(zip(*out), kinds)]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), *made], ["key", "n_bytes", "n_removed", "n_spans", "removed", "kept"]
                )

    joined = rows.join(found, F.col("digest") == F.col("_digest"), "left")
    return (
        joined.select("key", "text", "copies", "ranges")
        .mapInArrow(
            remove,
            f"key {kind}, n_bytes bigint, n_removed bigint, n_spans bigint,"
            " removed array<struct<begin:bigint,end:bigint>>, kept binary",
        )
        .withColumnRenamed("key", key)
    )
