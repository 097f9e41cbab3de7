"""Packing documents into sequences of a fixed number of tokens.

A document's ids and a closing id are cut into pieces only where they exceed a
sequence. Bins are filled by minimum bin slack: the longest piece left opens a bin, and
a subset-sum over the lengths still available, held as the bits of one number,
finds the fullest way to complete it. That combination is removed and repeated
for as long as the lengths last.

Only counts per length decide the bins, and there are at most as many lengths as a
sequence has tokens, so the plan is found on the driver from a table of that bound,
however many pieces there are. It says which ranks of each length go to which
sequences and offsets; pieces are ranked within their length across tasks and look
their place up. The number of plan entries is bounded by the capacity too.

Defined cases. A NULL text is empty: one piece with the closing id alone. NULL and
repeated keys are packed like any others, one set of pieces per row. An
empty table gives an empty result. Only key and text are read, so other columns
cannot clash.
"""

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludolens.llm.tables import bound_batches
from ludolens.llm.tokens import encoder
from ludolens.operators.ordering import number_rows
from ludolens.scratch import write_scratch

CAPACITY = 2048
CLOSING_ID = 0

_ROWS_AT_ONCE = 512


def tokenize(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    closing_id: int = CLOSING_ID,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Pieces of every document: key, piece, start, length and the ids as 32-bit numbers.

    ``tokenizer`` is the path of the vocabulary file on every worker.
    """
    bound_batches(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    width, closing = 4 * capacity, np.array([closing_id], "<u4").tobytes()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS_AT_ONCE):
                part = batch.slice(at, _ROWS_AT_ONCE)
                row, piece, ids = [], [], []
                texts = [content or "" for content in part.column(1).to_pylist()]
                for i, encoded in enumerate(words.encode_all(texts)):
                    whole = encoded + closing
                    for number, start in enumerate(range(0, len(whole), width)):
                        row.append(i)
                        piece.append(number)
                        ids.append(whole[start : start + width])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(row, pa.int32())),
                        pa.array(piece, pa.int32()),
                        pa.array(np.array(piece, np.int64) * capacity),
                        pa.array([len(x) // 4 for x in ids], pa.int64()),
                        pa.array(ids, pa.binary()),
                    ],
                    ["key", "piece", "start", "length", "ids"],
                )

    return docs.select(F.col(key), F.col(text)).mapInArrow(
        pieces, f"key {kind}, piece int, start bigint, length bigint, ids binary"
    )


class Plan(NamedTuple):
    """Entry ``i``: pieces of one length from ``rank[i]`` on, ``times[i]`` to a sequence.

    ``at`` is length and first rank in one number, ascending.
    """

    at: np.ndarray
    rank: np.ndarray
    times: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray


_RANK_BITS = 44


def fullest(slack: int, available: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Lengths and how often each, adding up as near to ``slack`` as can be, longest first."""
    mask, reached, steps = (1 << slack + 1) - 1, 1, []
    for length, count in available:
        if length > slack:
            continue
        left, share = min(count, slack // length), 1
        while left:
            taken = min(share, left)
            steps.append((length, taken, reached))
            reached |= reached << length * taken & mask
            left, share = left - taken, share * 2
        if reached >> slack:
            break
    total, chosen = reached.bit_length() - 1, {}
    for length, taken, before in reversed(steps):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + taken
            total -= length * taken
    return sorted(chosen.items(), reverse=True)


def minimum_bin_slack(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Where the pieces of each length go."""
    left = dict(sorted(counts.items(), reverse=True))
    used = dict.fromkeys(left, 0)
    entries, sequence = [], 0
    while left:
        longest = next(iter(left))
        left[longest] -= 1
        rest = fullest(capacity - longest, [(n, c) for n, c in left.items() if c])
        left[longest] += 1
        combination = dict(rest)
        combination[longest] = combination.get(longest, 0) + 1
        repeats = min(left[n] // times for n, times in combination.items())
        offset = 0
        for length, times in sorted(combination.items(), reverse=True):
            entries.append((length, used[length], times, sequence, offset))
            used[length] += times * repeats
            left[length] -= times * repeats
            if not left[length]:
                del left[length]
            offset += length * times
        sequence += repeats
    entries.sort()
    columns = np.array(entries, np.int64).reshape(-1, 5).T
    return Plan((columns[0] << _RANK_BITS) + columns[1], *columns[1:])


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to ``pieces``, which need key, piece and length (1 to capacity).

    All columns must be small; join ids afterwards or take them along at their cost.
    """
    written = write_scratch(pieces)
    counts = {r["length"]: r["count"] for r in written.groupBy("length").count().collect()}
    plan = written.sparkSession.sparkContext.broadcast(minimum_bin_slack(counts, capacity))

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def placed(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        found = plan.value
        lengths, ranks = length.to_numpy(np.int64), rank.to_numpy(np.int64)
        entry = np.searchsorted(found.at, (lengths << _RANK_BITS) + ranks, "right") - 1
        after, times = ranks - found.rank[entry], found.times[entry]
        return pd.DataFrame(
            {
                "sequence_id": found.sequence[entry] + after // times,
                "offset": found.offset[entry] + after % times * lengths,
            }
        )

    order = [F.col(c) for c in pieces.columns if c != "length"]
    ranked = number_rows(written, order, "_rank", within=["length"])
    place = placed("length", F.col("_rank") - 1).alias("_place")
    return ranked.select(*pieces.columns, place).select(*pieces.columns, "_place.*")


def sequences(packed: DataFrame) -> DataFrame:
    """The ids of each sequence in order, from packed pieces that kept their ids.

    A sequence has at most as many pieces as tokens, so each group is small.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda made, part: F.concat(made, part["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))
