"""Spelling variants: words one inserted, deleted or replaced character apart, and the form each goes back to.

Words of one tile are laid out as a matrix of code points, padded on the right to read prefixes and on the left to
read suffixes. Two blocks of rows are compared column by column, all rows with all rows, which gives
the common prefix and suffix of every pair. Two different words are one edit apart if both together reach the
length of the longer word minus one.

One of the two then covers at least half of the longer word. So words only meet in tiles of the same
prefix, or the same suffix, of half that length; a pair that both would show is taken from its prefix.
Small groups share a tile, and a group beyond a tile is cut into blocks that meet pair by pair,
so no task gets more than two blocks however many words share a half. No pair is passed on: each tile gives
one row per word, with the number of its near words and the best of them.

A form has at least twice the number of occurrences, so a chain of forms has at most 63 words; roots are found
by doubling the step along the chain, with as many joins as its length has binary digits.

Defined cases. A NULL or empty text has no words. A NULL key counts as an empty one in the hash that picks
deletions. Repeated rows count each. An empty table gives an empty result. Only key and text are
read, so other columns cannot clash. Long texts are words like short ones.
"""

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ludolens.llm.tables import bound_batches
from ludolens.scratch import broadcast_small, write_scratch

# Which words count, and which runs lose a character.
LEAST_LENGTH = 5
LEAST_COUNT = 3
DELETE_EVERY = 97

# Words of a block; a tile has at most two.
TILE = 256
# Different words that a task counts before it passes them on.
_COUNTED = 400_000

# Latin-1 bytes of words as themselves, A to Z in lower case, all others as spaces.
_FOLDED = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 192 else 32 for b in range(256)
)


def occurrences(text: str, key: str, every: int = DELETE_EVERY) -> Counter:
    """How often each word occurs in ``text``, as Latin-1, after the deletions that ``key`` leads to."""
    # Characters beyond Latin-1 become question marks, which are no part of words.
    runs = Counter(text.encode("latin-1", "replace").translate(_FOLDED).split())
    seed = zlib.crc32(f"{key}:".encode())
    cut = Counter()
    for run in list(runs):
        own = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), seed)
        if own % every == 0:
            at = own % len(run)
            cut[run[:at] + run[at + 1 :]] += runs.pop(run)
    runs.update(cut)
    return runs


def count_words(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
) -> DataFrame:
    """word and n, its occurrences in all texts, for words of that length and number at least."""
    bound_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted: Counter = Counter()
        for batch in batches:
            for own, content in zip(*(c.to_pylist() for c in batch.columns)):
                counted.update(occurrences(content, own))
                if len(counted) > _COUNTED:
                    yield passed_on(counted)
                    counted = Counter()
        yield passed_on(counted)

    def passed_on(counted: Counter) -> pa.RecordBatch:
        long = {w: n for w, n in counted.items() if len(w) >= least_length}
        words = [w.decode("latin-1") for w in long]
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(long.values(), pa.int64())], ["word", "n"])

    rows = docs.where(F.col(text).isNotNull()).select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), F.col(text).alias("text")
    )
    counts = rows.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= least_count)


def code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points padded on the right, the same padded on the left, and the lengths."""
    sizes = np.array([len(w) for w in words], np.int64)
    width = int(sizes.max(initial=1))
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
    row = np.repeat(np.arange(len(words)), sizes)
    column = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    right = np.zeros((len(words), width), np.uint32)
    left = np.zeros((len(words), width), np.uint32)
    right[row, column] = flat
    left[row, column + (width - sizes)[row]] = flat
    return right, left, sizes


def common_lengths(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Length of the common prefix of every row of ``first`` with every row of ``second``, padding aside."""
    length = np.zeros((len(first), len(second)), np.int32)
    alive = np.ones((len(first), len(second)), bool)
    for column in range(min(first.shape[1], second.shape[1])):
        a, b = first[:, column], second[:, column]
        alive &= (a[:, None] == b[None, :]) & (a != 0)[:, None]
        if not alive.any():
            break
        length += alive
    return length


def near_pairs(
    words: list[str], group: np.ndarray, goal: np.ndarray, by_suffix: np.ndarray, block: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Places of all pairs of near words of one tile whose longer word has the length ``goal`` of their group.

    Words pair up within a group, and across its blocks 0 and 1 if a tile is told two. A group that goes by
    suffix leaves out pairs that share half of the longer word as their prefix.
    """
    right, left, sizes = code_points(words)
    a = np.arange(len(words)) if block is None else np.flatnonzero(block == 0)
    b = a if block is None else np.flatnonzero(block == 1)
    prefix = common_lengths(right[a], right[b])
    suffix = common_lengths(left[a, ::-1], left[b, ::-1])
    longer = np.maximum(sizes[a][:, None], sizes[b][None, :])
    shorter = np.minimum(sizes[a][:, None], sizes[b][None, :])
    near = (np.minimum(prefix + suffix, shorter) >= longer - 1) & (prefix < longer)
    near &= (group[a][:, None] == group[b][None, :]) & (longer == goal[a][:, None])
    near &= ~by_suffix[a][:, None] | (prefix < longer // 2)
    if block is None:
        near &= a[:, None] < b[None, :]
    i, j = np.nonzero(near)
    return a[i], b[j]


def _routes(width: Column) -> Column:
    """Where a word meets others: as the longer or equal one, or as the shorter one, by either half."""
    return F.array(
        *[
            F.struct(
                longer.alias("longer"),
                F.lit(by_suffix).alias("by_suffix"),
                (F.right if by_suffix else F.left)(F.col("word"), F.floor(longer / 2).cast("int")).alias("half"),
            )
            for longer in (width, width + 1)
            for by_suffix in (False, True)
        ]
    )


def near_words(words: DataFrame, tile: int = TILE) -> DataFrame:
    """word, n_near and best (``less``, minus the occurrences, and ``word``), for words (word, n) that have near words."""
    route = F.explode(_routes(F.char_length("word"))).alias("route")
    routed = write_scratch(
        words.select("word", "n", route)
        .select("word", "n", "route.*")
        .withColumn("group", F.xxhash64("longer", "by_suffix", "half"))
    )
    # Two groups of one hash would only share a tile; their words do not become near by it.
    sizes = routed.groupBy("group").agg(
        F.count("*").alias("size"), F.count_if(F.char_length("word") == F.col("longer")).alias("own")
    )
    met = write_scratch(sizes.where("size > 1 and own > 0").select(F.col("group").alias("_group"), "size"))
    total = met.agg(F.sum(F.when(F.col("size") <= tile, F.col("size")))).first()[0] or 0
    buckets = max(1, -(-total // tile))
    joined = routed.join(broadcast_small(met), F.col("group") == F.col("_group"))
    blocks = F.ceil(F.col("size") / tile).cast("int")
    own = F.pmod(F.xxhash64("word", "group"), blocks).cast("int")
    cut = joined.withColumn("blocks", blocks).withColumn("own", own)
    # A block meets itself in one tile and every other block in one more.
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    split = cut.where("blocks > 1").select("*", other)
    columns = ["word", "n", "group", "longer", "by_suffix"]
    pairs = split.select(
        *columns,
        F.col("group").alias("tile"),
        F.least("own", "other").alias("low"),
        F.greatest("own", "other").alias("high"),
        F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("block"),
    )
    # Words of a tile have lengths of one size class, as short rows are padded to the longest.
    small = cut.where("blocks = 1").select(
        *columns,
        F.pmod(F.col("group"), F.lit(buckets)).alias("tile"),
        (-F.ceil(F.log2("longer")).cast("int")).alias("low"),
        (-F.ceil(F.log2("longer")).cast("int")).alias("high"),
        F.lit(0).alias("block"),
    )

    def compare(tile_rows: pa.Table) -> pa.Table:
        words = tile_rows["word"].to_pylist()
        counts, group, goal, suffix, block, low, high = (
            tile_rows[c].to_numpy() for c in ("n", "group", "longer", "by_suffix", "block", "low", "high")
        )
        i, j = near_pairs(words, group, goal, suffix, block if low[0] != high[0] else None)
        of, near = np.concatenate([i, j]), np.concatenate([j, i])
        rank = np.empty(len(words), np.int64)
        rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
        order = np.lexsort((rank[near], -counts[near], of))
        of, near = of[order], near[order]
        begins = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])[: len(of)])
        best = near[begins]
        return pa.table(
            {
                "word": pa.array([words[k] for k in of[begins]], pa.string()),
                "n_near": pa.array(np.diff(np.append(begins, len(of))), pa.int64()),
                "less": pa.array(-counts[best], pa.int64()),
                "near": pa.array([words[k] for k in best], pa.string()),
            }
        )

    found = (
        small.unionByName(pairs)
        .groupBy("tile", "low", "high")
        .applyInArrow(compare, "word string, n_near bigint, less bigint, near string")
    )
    return found.groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct("less", F.col("near").alias("word"))).alias("best")
    )


def _roots(forms: DataFrame) -> DataFrame:
    """word and root, for words (word, form) that have a form."""
    steps = write_scratch(forms.select("word", F.col("form").alias("root")))
    while True:
        further = steps.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        led = steps.join(further, F.col("root") == F.col("_word"), "left")
        steps = write_scratch(led.select("word", F.coalesce("_root", "root").alias("root"), F.col("_root").isNotNull().alias("moved")))
        if steps.where("moved").isEmpty():
            return steps.select("word", "root")
        steps = steps.select("word", "root")


def spelling_forms(words: DataFrame, tile: int = TILE) -> DataFrame:
    """word, form, root, n, n_near and form_n for every word of ``words`` (word, n; words are different).

    The form is the near word of most occurrences, if it has at least twice as many; the root ends the chain of forms.
    """
    words = write_scratch(words)
    near = near_words(words, tile).select(F.col("word").alias("_word"), "n_near", "best")
    strong = -F.col("best.less") >= 2 * F.col("n")
    formed = write_scratch(
        words.join(near, F.col("word") == F.col("_word"), "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(strong, F.col("best.word")).alias("form"),
            F.when(strong, -F.col("best.less")).alias("form_n"),
        )
    )
    roots = _roots(formed.where("form is not null")).select(F.col("word").alias("_word"), "root")
    return formed.join(roots, F.col("word") == F.col("_word"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
