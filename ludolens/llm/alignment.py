"""Links between the tokens of two tokenizers on the same bytes, by sparse matrix products.

Both tokenizers encode one text; their tokens tile the same bytes. With A the incidence of the first
tokenizer's tokens and the bytes, and B that of the second's, the rows of A·Bᵀ say which tokens
overlap and by how many bytes. Where two neighbouring rows share no column both tokenizers end a
token, and a group of tokens ends. The product of the two group incidences gives the links: all
pairs of tokens that share a group. Matrices are compressed rows in plain arrays, and products go row by row.

Neither tokenizer joins a space to what stands before it, so a text is cut in front of single
spaces between visible characters, and each different part is encoded and multiplied once for as long as it
is remembered. Batches have a bounded number of characters; a long text passes through several.

How many documents hold a pair of ids linked is counted over the whole table. The written links are joined
with these counts, which are broadcast only if they measure small.

Defined cases. A NULL or empty text, and a text that either tokenizer does not give back byte for
byte, has no tokens: zeros, and '' for its digest. NULL and repeated keys are rows like any other; each
repeated row is a document. An empty table gives an empty result. Only key and text are read, so other
columns cannot clash. A text without a place to cut is encoded as one part, whose memory grows with it.
"""

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from ludolens.llm.tables import bound_batches
from ludolens.scratch import broadcast_small, write_scratch

_CUT = re.compile(r"(?<=[!-~\w]) (?=[!-~\w])")
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")

# Characters cut and aligned together, and characters handed to a tokenizer in one call.
_CHARS_AT_ONCE = 3 << 20
_ENCODED_AT_ONCE = 1 << 18
# Parts, and characters of parts, beyond which a worker forgets what it has aligned.
_REMEMBERED = 300_000
_REMEMBERED_CHARS = 16 << 20
# Entries a product expands at a time.
_EXPANDED = 1 << 21


class Csr(NamedTuple):
    """Row ``i`` has ``value`` in ``column``, both from ``start[i]`` to ``start[i + 1]``."""

    start: np.ndarray
    column: np.ndarray
    value: np.ndarray

    def rows(self) -> np.ndarray:
        """The row of each entry."""
        return np.repeat(np.arange(len(self.start) - 1), np.diff(self.start))


def spans_of(start: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Places ``start[i]`` to ``start[i + 1]`` for each ``i`` of ``which``, one after another."""
    counts = start[which + 1] - start[which]
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start[which] - ends + counts, counts)


def summed(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys, ascending, and the sum of the values of each."""
    if not len(key):
        return key, value
    order = np.argsort(key, kind="stable")
    key = key[order]
    begins = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[begins], np.add.reduceat(value[order], begins)


def row_products(left: Csr, right: Csr, width: int) -> Csr:
    """``left`` times ``right``, which has ``width`` columns.

    Each row is the sum of the rows of ``right`` that it names, times its values; blocks of rows bound the memory.
    """
    rows = len(left.start) - 1
    expands = np.concatenate([[0], np.cumsum(np.diff(right.start)[left.column])])[left.start]
    keys, values, at = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    while at < rows:
        until = max(at + 1, int(np.searchsorted(expands, expands[at] + _EXPANDED, "right")) - 1)
        entry = np.arange(left.start[at], left.start[until])
        named = left.column[entry]
        counts = right.start[named + 1] - right.start[named]
        row = np.repeat(np.arange(at, until), np.diff(left.start[at : until + 1]))
        met = spans_of(right.start, named)
        key, value = summed(
            np.repeat(row, counts) * width + right.column[met], np.repeat(left.value[entry], counts) * right.value[met]
        )
        keys.append(key)
        values.append(value)
        at = until
    key = np.concatenate(keys)
    start = np.searchsorted(key, np.arange(rows + 1) * width)
    return Csr(start, key % max(1, width), np.concatenate(values))


def overlaps(left_sizes: np.ndarray, right_sizes: np.ndarray) -> Csr:
    """Bytes shared by each token of one tiling with each of another tiling of the same bytes."""
    total = int(left_sizes.sum())
    ones, places = np.ones(total, np.int64), np.arange(total + 1)
    left = Csr(np.concatenate([[0], np.cumsum(left_sizes)]), places[:-1], ones)
    right_by_byte = Csr(places, np.repeat(np.arange(len(right_sizes)), right_sizes), ones)
    return row_products(left, right_by_byte, len(right_sizes))


def common_groups(shared: Csr, right_count: int) -> tuple[np.ndarray, np.ndarray]:
    """Group of each token on both sides; groups end where tokens of both sides end together."""
    first, last = shared.column[shared.start[:-1]], shared.column[shared.start[1:] - 1]
    left = np.cumsum(np.concatenate([[0], first[1:] != last[:-1]])) if len(first) else first
    right = np.zeros(right_count, np.int64)
    right[shared.column] = left[shared.rows()]
    return left, right


def _incidence(group: np.ndarray, ids: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group, id and number of occurrences, for each id of each group."""
    key, count = summed(group * size + ids, np.ones(len(ids), np.int64))
    return key // size, key % size, count


class Aligned(NamedTuple):
    """Parts of texts: token and group counts, groups as text, and links as id pairs with numbers.

    The links of part ``i`` are ``start[i]`` to ``start[i + 1]``. ``lost`` parts do not come back byte for byte.
    """

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    lost: np.ndarray
    groups: list[str]
    start: np.ndarray
    pair: np.ndarray
    times: np.ndarray


class Aligner:
    """Two tokenizers and the bytes of their tokens.

    ``byte_bpe`` is a byte-level vocabulary file, ``pieces`` a piece model that puts a space in front.
    """

    def __init__(self, byte_bpe: str, pieces: str) -> None:
        self.a = Tokenizer.from_file(byte_bpe)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=pieces)
        self.a_bytes = _byte_level(self.a)
        self.b_bytes = [_piece_bytes(self.b, i) for i in range(self.b.get_piece_size())]
        self.a_sizes = np.array([len(x) for x in self.a_bytes])
        self.b_sizes = np.array([len(x) for x in self.b_bytes])
        self.ids_b = len(self.b_bytes)
        # Each id with what follows it in the text of groups.
        self.shown = [f"{i}{end}" for end in ",|" for i in range(len(self.a_bytes))]
        self.shown += [f"{i}{end}" for end in ",;\n" for i in range(self.ids_b)]
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.chars = 0
        none = np.zeros(0, np.int64)
        self.stored = Aligned(none, none, none, none.astype(bool), [], np.zeros(1, np.int64), none, none)

    def numbers(self, texts: list[str]) -> list[list[int]]:
        """Place of every part of each text in ``stored``, where parts not known yet are added."""
        if len(self.known) > _REMEMBERED or self.chars > _REMEMBERED_CHARS:
            self.forget()
        known, before = self.known, len(self.known)
        numbers = [[known.setdefault(p, len(known)) for p in _CUT.split(text)] for text in texts]
        fresh = list(islice(known, before, None))
        if fresh:
            self.chars += sum(map(len, fresh))
            self.stored = _joined([self.stored, self.align(fresh)])
        return numbers

    def _tokens(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both for a space and ``text``; None unless both give the bytes back."""
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        data = (" " + text).encode()
        if b"".join(map(self.a_bytes.__getitem__, a)) != data or b"".join(map(self.b_bytes.__getitem__, b)) != data:
            return None
        return np.array(a, np.int64), np.array(b, np.int64)

    def align(self, parts: list[str]) -> Aligned:
        """Alignment of each part, as it stands behind a space."""
        done, block, total = [], [], 0
        for part in parts:
            if block and total + len(part) > _ENCODED_AT_ONCE:
                done.append(self._block(block))
                block, total = [], 0
            block.append(part)
            total += len(part) + 1
        if block:
            done.append(self._block(block))
        return _joined(done)

    def _block(self, parts: list[str]) -> Aligned:
        tokens = self._tokens(" ".join(parts))
        if tokens is not None:
            a, b = tokens
            ends = np.cumsum([len(part.encode()) + 1 for part in parts])
            shared = overlaps(self.a_sizes[a], self.b_sizes[b])
            group_a, group_b = common_groups(shared, len(b))
            a_end = np.cumsum(self.a_sizes[a])
            # Both tokenizers end a token where a part ends, or the parts are not independent.
            last = np.searchsorted(a_end, ends)
            last[last == len(a)] = len(a) - 1
            closes = np.append(group_a[1:] != group_a[:-1], True)
            if (a_end[last] == ends).all() and closes[last].all():
                return self._entries(a, b, group_a, group_b, np.searchsorted(ends, a_end), len(parts))
        if len(parts) > 1:
            half = len(parts) // 2
            return _joined([self._block(parts[:half]), self._block(parts[half:])])
        zero, none = np.zeros(1, np.int64), np.zeros(0, np.int64)
        return Aligned(zero, zero, zero, np.ones(1, bool), [""], np.zeros(2, np.int64), none, none)

    def _entries(self, a, b, group_a, group_b, part_of_a, count) -> Aligned:
        groups = int(group_a[-1]) + 1
        a_from = np.searchsorted(group_a, np.arange(groups + 1))
        b_from = np.searchsorted(group_b, np.arange(groups + 1))
        part_of_group = part_of_a[a_from[:-1]]
        by_part = np.searchsorted(part_of_group, np.arange(count + 1))

        # The ids of both sides in the order of the text, each with what follows it.
        code = np.empty(len(a) + len(b), np.int64)
        a_ends = np.zeros(len(a), np.int64)
        a_ends[a_from[1:] - 1] = 1
        b_ends = np.zeros(len(b), np.int64)
        b_ends[b_from[1:] - 1] = 1
        b_ends[b_from[by_part[1:]] - 1] = 2
        size_a = len(self.a_bytes)
        code[np.arange(len(a)) + b_from[group_a]] = a + size_a * a_ends
        code[np.arange(len(b)) + a_from[group_b + 1]] = 2 * size_a + b + self.ids_b * b_ends
        text = "".join(map(self.shown.__getitem__, code.tolist()))

        in_group, id_a, times_a = _incidence(group_a, a, len(self.a_bytes))
        b_group, id_b, times_b = _incidence(group_b, b, self.ids_b)
        left = Csr(np.arange(len(id_a) + 1), in_group, times_a)
        right = Csr(np.searchsorted(b_group, np.arange(groups + 1)), np.arange(len(id_b)), times_b)
        links = row_products(left, right, len(id_b))
        row = links.rows()
        return Aligned(
            np.bincount(part_of_a, minlength=count),
            np.bincount(part_of_group[group_b], minlength=count),
            np.diff(by_part),
            np.zeros(count, bool),
            text.split("\n")[:count],
            np.searchsorted(part_of_group[in_group[row]], np.arange(count + 1)),
            id_a[row] * self.ids_b + id_b[links.column],
            links.value,
        )


def _joined(blocks: list[Aligned]) -> Aligned:
    if len(blocks) == 1:
        return blocks[0]
    columns = list(zip(*blocks))
    sizes = np.cumsum([0, *(len(b.pair) for b in blocks)])
    starts = [np.zeros(1, np.int64), *(b.start[1:] + size for b, size in zip(blocks, sizes))]
    made = [np.concatenate(c) if i != 4 else sum(c, []) for i, c in enumerate(columns)]
    made[5] = np.concatenate(starts)
    return Aligned(*made)


def _byte_level(tokenizer: Tokenizer) -> list[bytes]:
    """Bytes of each id: printable characters stand for themselves, the others are numbered from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    entries = [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size())]
    return [bytes(byte[c] for c in e) if all(c in byte for c in e) else e.encode() for e in entries]


def _piece_bytes(model: SentencePieceProcessor, number: int) -> bytes:
    piece = model.id_to_piece(number)
    if model.is_byte(number):
        return bytes([int(_BYTE_PIECE.fullmatch(piece)[1], 16)])
    return piece.replace("▁", " ").encode()


@lru_cache(maxsize=2)
def aligner(byte_bpe: str, pieces: str) -> Aligner:
    """One aligner per pair of files and worker process."""
    return Aligner(byte_bpe, pieces)


def cut_text(text: str, most: int) -> Iterator[str]:
    """``text`` in stretches of about ``most`` characters, cut where parts end."""
    at = 0
    while len(text) - at > most:
        place = _CUT.search(text, at + most - 1)
        if place is None:
            break
        yield text[at : place.start()]
        at = place.end()
    yield text[at:]


class _Document:
    """What is known of a text while its stretches pass."""

    def __init__(self) -> None:
        self.counts = np.zeros(3, np.int64)
        self.lost = False
        self.digest = hashlib.sha256()
        self.open = False
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []


def _align_stretches(made: Aligner, stretches: list[tuple[_Document, str]]) -> None:
    """Add the stretches to their documents."""
    numbers = made.numbers([text for _, text in stretches])
    aligned = made.stored
    part = np.array([n for stretch in numbers for n in stretch], np.int64)
    stretch = np.repeat(np.arange(len(numbers)), [len(n) for n in numbers])
    sums = [np.bincount(stretch, c[part], len(numbers)).astype(np.int64) for c in aligned[:3]]
    lost = np.bincount(stretch, aligned.lost[part], len(numbers)) > 0

    known = len(aligned.groups)
    held, often = summed(stretch * known + part, np.ones(len(part), np.int64))
    holder, part = held // known, held % known
    counts = np.diff(aligned.start)[part]
    at = spans_of(aligned.start, part)
    pairs = len(made.a_bytes) * made.ids_b
    key, times = summed(
        np.repeat(holder, counts) * pairs + aligned.pair[at], np.repeat(often, counts) * aligned.times[at]
    )
    begin = np.searchsorted(key, np.arange(len(numbers) + 1) * pairs)
    for i, (document, _) in enumerate(stretches):
        document.counts += [s[i] for s in sums]
        document.lost |= bool(lost[i])
        groups = ";".join([aligned.groups[n] for n in numbers[i]])
        document.digest.update(((";" if document.open else "") + groups).encode())
        document.open = True
        document.pairs.append(key[begin[i] : begin[i + 1]] - i * pairs)
        document.times.append(times[begin[i] : begin[i + 1]])


_LINKED = (
    "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string,"
    " pairs array<bigint>, times array<bigint>"
)


def _finished(rows: pa.RecordBatch, documents: list[_Document | None]) -> pa.RecordBatch:
    counts, digests, pairs, times = [], [], [], []
    none = np.zeros(0, np.int64)
    for document in documents:
        if document is None or document.lost:
            counts.append([0, 0, 0])
            digests.append("")
            pairs.append(none)
            times.append(none)
            continue
        counts.append(document.counts)
        digests.append(document.digest.hexdigest())
        if len(document.pairs) == 1:
            pair, often = document.pairs[0], document.times[0]
        else:
            pair, often = summed(np.concatenate(document.pairs), np.concatenate(document.times))
        pairs.append(pair)
        times.append(often)
    at = pa.array(np.concatenate([[0], np.cumsum([len(p) for p in pairs])]), pa.int32())
    columns = np.array(counts, np.int64).reshape(-1, 3).T
    links = pa.array([int(t.sum()) for t in times], pa.int64())
    lists = [pa.ListArray.from_arrays(at, pa.array(np.concatenate(c))) for c in (pairs, times)]
    made = [*rows.columns, *(pa.array(c) for c in columns), links, pa.array(digests, pa.string()), *lists]
    names = ["row", "key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]
    return pa.RecordBatch.from_arrays(made, names)


def link_tokens(
    docs: DataFrame, byte_bpe: str, pieces: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """row, key, counts, digest of the groups, and the linked id pairs with how often each, per document.

    ``row`` tells rows apart. A pair is the first id times the size of the second vocabulary, plus the second id.
    The paths are those of the vocabulary files on every worker.
    """
    bound_batches(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = aligner(byte_bpe, pieces)
        for batch in batches:
            documents, waiting, total, begin = [], [], 0, 0
            for i, whole in enumerate(batch.column(2).to_pylist()):
                documents.append(_Document() if whole else None)
                for stretch in cut_text(whole, _CHARS_AT_ONCE) if whole else []:
                    waiting.append((documents[-1], stretch))
                    total += len(stretch)
                    if total >= _CHARS_AT_ONCE:
                        _align_stretches(made, waiting)
                        waiting, total = [], 0
                if documents and not waiting:
                    yield _finished(batch.select([0, 1]).slice(begin, i + 1 - begin), documents)
                    documents, begin = [], i + 1
            if waiting:
                _align_stretches(made, waiting)
            if documents:
                yield _finished(batch.select([0, 1]).slice(begin), documents)

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(link, f"row bigint, key {kind}, {_LINKED}")


def pair_counts(linked: DataFrame, ids_b: int) -> DataFrame:
    """pair, the number of documents that hold it (docs), and whether its first id has no pair with more (best)."""
    counts = write_scratch(linked.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("docs")))
    first_id = F.floor(F.col("pair") / ids_b)
    # At most one row per id of the first vocabulary.
    most = counts.groupBy(first_id.alias("_id")).agg(F.max("docs").alias("_most"))
    return counts.join(F.broadcast(most), first_id == F.col("_id")).select(
        "pair", "docs", (F.col("docs") == F.col("_most")).alias("best")
    )


def align_documents(
    docs: DataFrame, byte_bpe: str, pieces: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Counts of tokens, groups and links per document, weighed by how many documents hold each pair."""
    linked = write_scratch(link_tokens(docs, byte_bpe, pieces, key, text))
    ids_b = SentencePieceProcessor(model_file=pieces).get_piece_size()
    counts = broadcast_small(write_scratch(pair_counts(linked, ids_b)))
    both = F.explode(F.arrays_zip("pairs", "times")).alias("link")
    links = linked.select("row", both).select("row", F.col("link.pairs").alias("pair"), F.col("link.times").alias("times"))
    weighed = (
        links.join(counts, "pair")
        .groupBy(F.col("row").alias("_row"))
        .agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
            F.sum(F.col("times") * F.col("docs")).alias("count_sum"),
        )
    )
    return linked.join(weighed, F.col("row") == F.col("_row"), "left").select(
        F.col("key").alias(key),
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        F.coalesce("n_best", F.lit(0)).cast("bigint").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("bigint").alias("count_sum"),
        "groups_sha256",
    )
