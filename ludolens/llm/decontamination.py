"""Benchmark passages found verbatim in documents, by suffix arrays over the documents' words.

Words are runs of digits, letters a to z (A to Z lower-cased) and all characters beyond ASCII. A window is
``window`` words of an item in a row; an item of fewer words is one window. Each task puts
the documents it reads into shards, sorts the suffixes of a shard's words, and binary-searches every suffix of the items
in that order, one word deeper at a time. The last depth at which suffixes are left is the
longest verbatim match, and the suffixes left at the depth of a window are all places where it occurs.

A suffix can only start a window if each two words that follow each other there do so in an item too,
so the order holds only runs of such words, long enough for the shortest window. No other suffix could be found.

Items beyond ``BLOCK_BYTES`` of text are dealt by hash into blocks of about half of that. Each block is broadcast
on its own and meets all documents, so what is broadcast does not grow with the number of items.

Defined cases. A NULL or empty text has no words and no hits. An item without words occurs nowhere; one
without item_id hits words but is not listed; repeated items are one. NULL and repeated keys are rows
like any other. Empty tables on either side give no hits. Of documents only key and text are
read, of items only item_id and text, so other columns cannot clash.
"""

from collections.abc import Iterator
from functools import cached_property
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludolens.llm.tables import bound_batches, whole_row
from ludolens.scratch import broadcast_small, write_scratch

WINDOW = 10
BLOCK_BYTES = 16 << 20

# Every byte of a word as itself in lower case, all others as spaces.
_FOLDED = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_SLICE_BYTES = 4 << 20
_SHARD_WORDS = 4_000_000
_PLACES_AT_ONCE = 1 << 21


def words_of(text: str) -> Iterator[list[bytes]]:
    """The words of ``text``, in lists of bounded size."""
    data = text.encode("utf-8", "surrogatepass").translate(_FOLDED)
    at = 0
    while at < len(data):
        until = data.find(b" ", at + _SLICE_BYTES)
        until = len(data) if until < 0 else until
        yield data[at:until].split()
        at = until


class Items:
    """Items as numbers of their words, with one suffix per word."""

    def __init__(self, rows: list[tuple[str | None, str]], window: int) -> None:
        self.names = [name for name, _ in rows]
        numbers: dict[bytes, int] = {}
        words = [
            [numbers.setdefault(w, len(numbers) + 1) for part in words_of(text) for w in part] for _, text in rows
        ]
        sizes = np.array([len(w) for w in words], np.int64)
        self.vocabulary = list(numbers)
        # One 0 behind each item, which is no word.
        self.words = np.array([n for item in words for n in (*item, 0)], np.int64)
        first = np.cumsum(sizes + 1) - sizes - 1
        self.item = np.repeat(np.arange(len(rows)), sizes)
        within = np.arange(len(self.item)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.suffix = first[self.item] + within
        self.left = sizes[self.item] - within
        self.width = np.minimum(window, sizes)[self.item]
        self.shortest = int(self.width.min(initial=window))

    @cached_property
    def number(self) -> dict[bytes, int]:
        """The number of each word, from 1 on."""
        return {word: i + 1 for i, word in enumerate(self.vocabulary)}

    @cached_property
    def following(self) -> np.ndarray:
        """Words and their successors in items, in one number each, ascending."""
        inner = self.suffix[self.left > 1]
        return np.unique(self.words[inner] * (len(self.vocabulary) + 1) + self.words[inner + 1])

    def numbers(self, text: str) -> np.ndarray:
        """The number of each word of ``text``, 0 for words of no item."""
        find = self.number.get
        parts = [np.fromiter(map(find, part, repeat(0)), np.int32, len(part)) for part in words_of(text)]
        return np.concatenate(parts) if parts else np.zeros(0, np.int32)

    def follows(self, numbers: np.ndarray) -> np.ndarray:
        """Whether each word and the next one follow each other in an item."""
        found = np.zeros(len(numbers), bool)
        for at in range(0, len(numbers) - 1 if len(self.following) else 0, _PLACES_AT_ONCE):
            part = numbers[at : at + _PLACES_AT_ONCE + 1]
            both = np.flatnonzero((part[:-1] > 0) & (part[1:] > 0))
            pair = part[both].astype(np.int64) * (len(self.vocabulary) + 1) + part[both + 1]
            place = np.minimum(np.searchsorted(self.following, pair), len(self.following) - 1)
            found[at + both] = self.following[place] == pair
        return found

    def runs(self, numbers: np.ndarray) -> np.ndarray:
        """Begin and end of the runs of words in which a window may lie, as rows."""
        follows = np.concatenate([[False], self.follows(numbers), [False]])
        edge = np.flatnonzero(follows[1:] != follows[:-1])
        begin, end = edge[::2], edge[1::2] + 1
        if self.shortest == 1:
            known = np.flatnonzero(numbers > 0)
            alone = known[~(follows[1:-1][known] | follows[:-2][known])]
            begin, end = np.concatenate([begin, alone]), np.concatenate([end, alone + 1])
        long = end - begin >= self.shortest
        return np.stack([begin[long], end[long]], 1)


def suffix_array(words: np.ndarray, longest: int) -> np.ndarray:
    """Places of ``words`` other than 0 in the order of what follows up to the next 0, at most ``longest`` words.

    Ranks of the first words become ranks of twice as many, until all words up to a 0 are in them.
    """
    rank, step = np.unique(words, return_inverse=True)[1].astype(np.int64), 1
    # 0 stays 0: what follows it takes no part.
    end = words == 0
    while step < longest:
        later = np.zeros(len(rank), np.int64)
        later[:-step] = rank[step:]
        key = rank * (int(rank.max(initial=0)) + 1) + later
        key[end] = 0
        rank = np.unique(key, return_inverse=True)[1].astype(np.int64)
        step *= 2
    order = np.argsort(rank, kind="stable")
    return order[~end[order]]


class Found(NamedTuple):
    """For each suffix of an item, where its matches of ``depth`` words stand in the order."""

    low: np.ndarray
    high: np.ndarray
    depth: np.ndarray
    window_low: np.ndarray
    window_high: np.ndarray


def search(items: Items, words: np.ndarray, order: np.ndarray) -> Found:
    """Binary search of every suffix of the items in the suffix ``order`` of ``words`` (0 at its end)."""
    count = len(items.suffix)
    low, high = np.zeros(count, np.int64), np.full(count, len(order))
    depth = np.zeros(count, np.int64)
    window_low, window_high = np.zeros(count, np.int64), np.zeros(count, np.int64)
    alive, at = np.arange(count if len(order) else 0), 0
    while len(alive):
        wanted = items.words[items.suffix[alive] + at]
        begin = _first(words, order, at, low[alive], high[alive], wanted)
        end = _first(words, order, at, begin, high[alive], wanted + 1)
        left = end > begin
        alive, begin, end = alive[left], begin[left], end[left]
        at += 1
        low[alive], high[alive], depth[alive] = begin, end, at
        whole = items.width[alive] == at
        window_low[alive[whole]], window_high[alive[whole]] = begin[whole], end[whole]
        alive = alive[items.left[alive] > at]
    return Found(low, high, depth, window_low, window_high)


def _first(
    words: np.ndarray, order: np.ndarray, at: int, low: np.ndarray, high: np.ndarray, wanted: np.ndarray
) -> np.ndarray:
    """First place in ``low`` to ``high`` whose word number ``at`` is not below ``wanted``."""
    low, high = low.copy(), high.copy()
    open_ = np.flatnonzero(low < high)
    while len(open_):
        middle = (low[open_] + high[open_]) // 2
        below = words[order[middle] + at] < wanted[open_]
        low[open_[below]] = middle[below] + 1
        high[open_[~below]] = middle[~below]
        open_ = open_[low[open_] < high[open_]]
    return low


class Shard:
    """Documents that are sorted and searched together, as numbers of their words."""

    def __init__(self, items: Items, numbers: list[np.ndarray]) -> None:
        self.items = items
        self.sizes = np.array([len(n) for n in numbers], np.int64)
        # A 0 behind each document keeps matches from crossing it.
        end = np.zeros(1, np.int32)
        joined = np.concatenate([part for n in numbers for part in (n, end)])
        first = np.cumsum(self.sizes + 1) - self.sizes - 1
        runs = items.runs(joined)
        lengths = runs[:, 1] - runs[:, 0]
        source = _ranges(runs[:, 0], runs[:, 1] + 1)
        self.words = joined[source].astype(np.int64)
        # So does a 0 behind each run.
        self.words[np.cumsum(lengths + 1) - 1] = 0
        self.document = np.searchsorted(first, source, "right") - 1
        self.place = source - first[self.document]
        self.order = suffix_array(self.words, int(lengths.max(initial=0)))
        self.found = search(items, self.words, self.order)

    def hits(self) -> tuple[dict[int, list[tuple[int, int]]], dict[int, list[int]]]:
        """Begin and end of the hit words, and the items, of each document that has some."""
        change = np.zeros(len(self.words) + 1, np.int64)
        count = len(self.items.names)
        pairs = np.zeros(0, np.int64)
        for suffix, low, high in _blocks(self.found):
            at = self.order[_ranges(low, high)]
            change += np.bincount(at, minlength=len(change))
            change -= np.bincount(at + np.repeat(self.items.width[suffix], high - low), minlength=len(change))
            own = self.document[at] * count + np.repeat(self.items.item[suffix], high - low)
            pairs = np.union1d(pairs, own)
        edges = np.flatnonzero(np.diff(np.concatenate([[False], np.cumsum(change)[:-1] > 0, [False]])))
        spans: dict[int, list[tuple[int, int]]] = {}
        for begin, end in zip(edges[::2], edges[1::2]):
            spans.setdefault(int(self.document[begin]), []).append((int(self.place[begin]), int(self.place[end - 1]) + 1))
        listed: dict[int, list[int]] = {}
        for pair in pairs.tolist():
            listed.setdefault(pair // count, []).append(pair % count)
        return spans, listed

    def longest(self) -> list[tuple[int, int, int, int, int]]:
        """Item, length, document, place there and place in the item, of the longest match of each item."""
        found, items = self.found, self.items
        met = np.flatnonzero(found.depth >= items.width)
        best = met[np.lexsort((met, -found.depth[met], items.item[met]))]
        best = best[np.unique(items.item[best], return_index=True)[1]]
        at = self.order[found.low[best]]
        sizes = np.bincount(items.item)
        columns = [items.item[best], found.depth[best], self.document[at], self.place[at], sizes[items.item[best]] - items.left[best]]
        return list(zip(*(c.tolist() for c in columns)))


def _ranges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Numbers from ``low[i]`` up to ``high[i]``, one range after another."""
    sizes = high - low
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(low - ends + sizes, sizes)


def _blocks(found: Found) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Suffixes and where their windows stand, a bounded number of matches at a time."""
    met = np.flatnonzero(found.window_high > found.window_low)
    low, high = found.window_low[met], found.window_high[met]
    # A suffix with very many matches is cut into several parts.
    parts = -(-(high - low) // _PLACES_AT_ONCE)
    suffix, begin = np.repeat(met, parts), np.repeat(low, parts)
    begin = begin + _PLACES_AT_ONCE * _ranges(np.zeros(len(parts), np.int64), parts)
    end = np.minimum(begin + _PLACES_AT_ONCE, np.repeat(high, parts))
    block = np.cumsum(end - begin) // _PLACES_AT_ONCE
    for part in np.split(np.arange(len(suffix)), np.flatnonzero(np.diff(block)) + 1):
        if len(part):
            yield suffix[part], begin[part], end[part]


def _shards(batches: Iterator[pa.RecordBatch], items: Items) -> Iterator[tuple[pa.RecordBatch, Shard]]:
    """Shards of a bounded number of words, or of one longer document, with the columns before the text."""
    for batch in batches:
        numbers, total, begin = [], 0, 0
        for i, text in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
            numbers.append(items.numbers(text or ""))
            total += len(numbers[-1])
            if total >= _SHARD_WORDS or i + 1 == batch.num_rows:
                names = batch.schema.names[:-1]
                yield batch.select(names).slice(begin, i + 1 - begin), Shard(items, numbers)
                numbers, total, begin = [], 0, i + 1


def item_blocks(items: DataFrame, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, int]:
    """Different items with the number of their block, each of about half ``block_bytes``, and how many blocks."""
    size = F.octet_length("text").cast("bigint") + 64
    named = items.select(F.col("item_id").cast("string").alias("item_id"), "text").where("text is not null").distinct()
    total = named.agg(F.sum(size)).first()[0] or 0
    blocks = 1 if total <= block_bytes else -(-2 * total // block_bytes)
    return named.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))), blocks


_SPANS = pa.list_(pa.struct({"begin": pa.int64(), "end": pa.int64()}))
_HITS = "n_words bigint, spans array<struct<begin:bigint,end:bigint>>, items array<string>"


def _block_hits(rows: DataFrame, items: Items, every_row: bool) -> DataFrame:
    """Hit words and items of one block per row of ``rows`` (key, digest, text), for all rows or those with hits."""
    told = rows.sparkSession.sparkContext.broadcast(items)
    kind = rows.schema["key"].dataType.simpleString()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, shard in _shards(batches, told.value):
            spans, listed = shard.hits()
            kept = range(len(shard.sizes)) if every_row else sorted(spans)
            names = told.value.names
            yield pa.RecordBatch.from_arrays(
                [
                    *keys.take(pa.array(kept, pa.int64())).columns,
                    pa.array(shard.sizes[list(kept)]),
                    pa.array([[{"begin": b, "end": e} for b, e in spans.get(i, [])] for i in kept], _SPANS),
                    pa.array(
                        [sorted({names[n] for n in listed.get(i, [])} - {None}) for i in kept], pa.list_(pa.string())
                    ),
                ],
                ["key", "digest", "n_words", "spans", "items"],
            )

    return rows.mapInArrow(find, f"key {kind}, digest binary, {_HITS}")


def _read_blocks(items: DataFrame, window: int, block_bytes: int) -> Iterator[Items]:
    """The items, block by block; one block at a time is on the driver."""
    placed, blocks = item_blocks(items, block_bytes)
    placed = write_scratch(placed)
    for block in range(blocks):
        rows = placed.where(F.col("block") == block).collect()
        yield Items(sorted(((r["item_id"], r["text"]) for r in rows), key=repr), window)


def _digest(text: str) -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).alias("key"), _digest(text).alias("digest"), F.col(text).alias("text"))


def _hit_words() -> Column:
    """Number of words in the union of the spans."""
    start = F.struct(F.lit(0).cast("bigint").alias("upto"), F.lit(0).cast("bigint").alias("hit"))

    def add(done: Column, span: Column) -> Column:
        fresh = F.greatest(F.lit(0).cast("bigint"), span["end"] - F.greatest(span["begin"], done["upto"]))
        return F.struct(F.greatest(done["upto"], span["end"]).alias("upto"), (done["hit"] + fresh).alias("hit"))

    return F.aggregate(F.array_sort("spans"), start, add)["hit"]


def find_matches(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """key, digest of the text, n_words, n_hit, spans of hit words, and item_ids in string order, per row of ``docs``.

    Spans of several blocks of items may overlap; n_hit counts each word once.
    """
    bound_batches(docs.sparkSession)
    rows = _keyed(docs, key, text)
    passes = [_block_hits(rows, block, i == 0) for i, block in enumerate(_read_blocks(items, window, block_bytes))]
    found = passes[0]
    if len(passes) > 1:
        # Documents with hits of later blocks; equal rows have equal hits.
        others = passes[1].select("key", "digest", "spans", "items")
        for other in passes[2:]:
            others = others.union(other.select("key", "digest", "spans", "items"))
        more = write_scratch(
            others.groupBy(F.col("key").alias("_key"), F.col("digest").alias("_digest")).agg(
                F.array_distinct(F.flatten(F.collect_set("spans"))).alias("_spans"),
                F.array_distinct(F.flatten(F.collect_set("items"))).alias("_items"),
            )
        )
        same = F.col("key").eqNullSafe(F.col("_key")) & (F.col("digest") == F.col("_digest"))
        both = [
            F.when(F.col(f"_{c}").isNull(), F.col(c)).otherwise(F.concat(c, f"_{c}")).alias(c) for c in ("spans", "items")
        ]
        found = found.join(broadcast_small(more), same, "left").select("key", "digest", "n_words", *both)
    return found.select(
        F.col("key").alias(key),
        "digest",
        "n_words",
        _hit_words().alias("n_hit"),
        "spans",
        F.array_sort(F.array_distinct("items")).alias("items"),
    )


def decontaminate(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows of ``docs`` in which no window of an item occurs, with all their columns."""
    hit = (
        find_matches(docs, items, window, key=key, text=text)
        .where("n_hit > 0")
        .select(F.col(key).alias("_key"), F.col("digest").alias("_digest"))
        .distinct()
    )
    rows = docs.select(whole_row(docs), _digest(text).alias("_own"))
    same = F.col(f"row.`{key}`").eqNullSafe(F.col("_key")) & (F.col("_own") == F.col("_digest"))
    return rows.join(broadcast_small(write_scratch(hit)), same, "left_anti").select("row.*")


def longest_matches(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """For each item with a window that occurs: n_words of its longest verbatim match, where that begins in
    the item (item_word), and the key and word (place) of the smallest place where it stands in a document."""
    bound_batches(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def of(block: Items) -> DataFrame:
        told = docs.sparkSession.sparkContext.broadcast(block)

        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for keys, shard in _shards(batches, told.value):
                best = list(zip(*shard.longest())) or [[]] * 5
                names = [told.value.names[n] for n in best[0]]
                places = [pa.array(list(best[i]), pa.int64()) for i in (1, 4, 3)]
                own = keys.column(0).take(pa.array(list(best[2]), pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.string()), *places, own], ["item_id", "n_words", "item_word", "place", "key"]
                )

        return rows.mapInArrow(find, f"item_id string, n_words bigint, item_word bigint, place bigint, key {kind}")

    found = None
    for block in _read_blocks(items, window, block_bytes):
        found = of(block) if found is None else found.union(of(block))
    first = F.min(F.struct((-F.col("n_words")).alias("less"), "item_word", "key", "place")).alias("best")
    return (
        found.where("item_id is not null")
        .groupBy("item_id")
        .agg(first)
        .select(
            "item_id", (-F.col("best.less")).alias("n_words"), "best.item_word", F.col("best.key").alias(key), "best.place"
        )
    )
