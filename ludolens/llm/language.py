"""Language identification by cross-parsing.

For each language a suffix automaton is built from a sample of its labelled
texts. A text is cut into the longest phrases that occur in that sample, from
left to right. In its own language it needs few, long phrases: the language
with the lowest ``phrases * log2(sample length) / characters`` wins.

The automaton is stored as one table of transitions in which a failing
character counts a phrase and starts the next one, so that many blocks of text
are parsed side by side with array lookups. The table has the ``DENSE`` most frequent characters of its own
language's sample; transitions by the others, of which large scripts have thousands, are looked up in a
sorted list, so every character of a sample counts. Texts are parsed whole, in blocks of
``BLOCK`` code points, each starting a new phrase, so a long text takes
no more memory than short ones.

The sample per language is bounded: ``SAMPLE_TEXTS`` different texts picked by a hash of
the text alone, one window of ``SAMPLE_WINDOW`` code points from each. The model's size is bounded by
``MODEL_TEXTS``: beyond ``MODEL_TEXTS / SAMPLE_TEXTS`` languages each gets an equal part of them, but
at least one text. No language is left out.

Defined cases. A text that is NULL, empty or without a letter is ``und`` with
score 0. Without labelled texts every text is ``und``. Equal figures go to the
language first in code point order. Rows with NULL text or label teach nothing; copies of
a text teach a language once. Prediction is a column expression, so all
columns of the input stay as they are.
"""

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ludolens.llm.tables import bound_batches
from ludolens.scratch import broadcast_small, write_scratch

UNDETERMINED = "und"
SAMPLE_TEXTS = 160
SAMPLE_WINDOW = 256
# Texts of all languages together, which bounds the model; many languages share them.
MODEL_TEXTS = 16 * SAMPLE_TEXTS
BLOCK = 256
DENSE = 62

# Code points parsed at a time; bounds the memory of a task.
_CHARS_AT_ONCE = 1 << 21
_OTHER, _PAD, _WIDTH = DENSE, DENSE + 1, DENSE + 2


class Parser(NamedTuple):
    """A language's table, the symbol of each character of the model, and what rare characters do.

    ``symbols`` and ``rare`` go by the model's number of a character; ``rare`` is -1 for characters in the
    table or not in the sample. ``keys`` are ascending, ``state * len(restarts) + rare``, and lead to ``values``.
    """

    table: np.ndarray
    symbols: np.ndarray
    rare: np.ndarray
    restarts: np.ndarray
    keys: np.ndarray
    values: np.ndarray


class Model(NamedTuple):
    languages: list[str]
    parsers: list[Parser]
    bits: list[float]
    codes: np.ndarray


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def sample_labelled(
    labelled: DataFrame,
    texts: int = SAMPLE_TEXTS,
    window: int = SAMPLE_WINDOW,
    text: str = "text",
    label: str = "lang",
) -> dict[str, str]:
    """At most ``texts`` windows of text per language, joined, brought to the driver."""
    known = labelled.where(F.col(label).isNotNull() & has_letter(F.col(text))).select(
        F.col(label).alias("label"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("picked")
    )
    # One row per label; copies of a text count once.
    counts = write_scratch(known.groupBy("label").agg(F.approx_count_distinct("picked").alias("distinct")))
    taken = max(1, min(texts, MODEL_TEXTS // max(1, counts.count())))
    # Twice as many as wanted are expected, of which those with the lowest hashes stay.
    share = F.least(F.lit(1.0), F.lit(2.0 * taken) / F.col("distinct")) * F.lit(1 << 20)
    start = F.pmod("picked", F.greatest(F.length("text") - window + 1, F.lit(1)).cast("bigint")) + 1
    windows = (
        known.join(broadcast_small(counts), "label")
        .where(F.pmod("picked", F.lit(1 << 20)) < share)
        .select("label", "picked", F.col("text").substr(start.cast("int"), F.lit(window)).alias("window"))
        .distinct()
    )
    order = W.partitionBy("label").orderBy("picked", "window")
    rows = windows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= taken).collect()
    found: dict[str, list] = {}
    for row in sorted(rows, key=lambda r: (r["label"], r["place"])):
        found.setdefault(row["label"], []).append(row["window"])
    return {name: "\n".join(parts) for name, parts in found.items()}


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton that accepts every substring."""
    edges: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for symbol in symbols:
        state = len(edges)
        edges.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and symbol not in edges[at]:
            edges[at][symbol] = state
            at = link[at]
        if at >= 0:
            target = edges[at][symbol]
            if length[target] != length[at] + 1:
                copy = len(edges)
                edges.append(dict(edges[target]))
                length.append(length[at] + 1)
                link.append(link[target])
                link[target] = copy
                while at >= 0 and edges[at].get(symbol) == target:
                    edges[at][symbol] = copy
                    at = link[at]
                target = copy
            link[state] = target
        last = state
    return edges


def _parser(sample: np.ndarray, known: int) -> Parser:
    """Parser of a sample of character numbers below ``known``, with two more for others and padding."""
    numbers, counts = np.unique(sample, return_counts=True)
    numbers = numbers[np.lexsort((numbers, -counts))]
    own = np.zeros(known, np.int64)
    own[numbers] = np.arange(len(numbers))
    edges = suffix_automaton(own[sample].tolist())
    dense, others = min(DENSE, len(numbers)), max(0, len(numbers) - DENSE)
    restart = np.ones(_WIDTH, np.int64)
    restarts = np.ones(others, np.int64)
    for symbol, state in edges[0].items():
        if symbol < dense:
            restart[symbol] = 2 * state * _WIDTH + 1
        else:
            restarts[symbol - dense] = 2 * state * _WIDTH + 1
    # Padding leads to the start and ends no phrase.
    restart[_PAD] = 0
    # ``table[state * width + symbol]`` is twice the next row, plus 1 if a phrase ended.
    table = np.tile(restart, (len(edges), 1))
    rest = []
    for state, out in enumerate(edges):
        for symbol, target in out.items():
            if symbol < dense:
                table[state, symbol] = 2 * target * _WIDTH
            else:
                rest.append((state * others + symbol - dense, 2 * target * _WIDTH))
    kind = np.int32 if 2 * len(edges) * _WIDTH < 2**31 else np.int64
    keys, values = np.array(sorted(rest), np.int64).reshape(-1, 2).T
    symbols = np.full(known + 2, _OTHER, np.uint8)
    symbols[numbers[:dense]] = np.arange(dense)
    symbols[known + 1] = _PAD
    rare = np.full(known + 2, -1, np.int32)
    rare[numbers[dense:]] = np.arange(others)
    return Parser(
        table.ravel().astype(kind), symbols, rare, restarts.astype(kind), keys.copy(), values.astype(kind)
    )


def learn(samples: dict[str, str]) -> Model:
    """One parser per language, each over all characters of its own sample."""
    lowered = {name: samples[name].lower() for name in sorted(samples)}
    points = [np.array([ord(c) for c in s], np.int64) for s in lowered.values()]
    characters = np.unique(np.concatenate([np.zeros(0, np.int64), *points]))
    codes = np.full(0x110000, len(characters), np.int32)
    codes[characters] = np.arange(len(characters))
    parsers = [_parser(codes[p], len(characters)) for p in points]
    return Model(list(lowered), parsers, [float(np.log2(max(2, len(s)))) for s in lowered.values()], codes)


def _phrases(parser: Parser, steps: np.ndarray) -> np.ndarray:
    """Phrases ended in each column of ``steps``, which holds one block per column."""
    row = np.zeros(steps.shape[1], parser.table.dtype)
    ended = np.zeros(steps.shape[1], np.int64)
    rare_at, column = (
        np.nonzero(parser.rare[steps] >= 0) if len(parser.restarts) else (np.zeros(0, np.int64),) * 2
    )
    bounds = np.searchsorted(rare_at, np.arange(len(steps) + 1))
    for k, numbers in enumerate(steps):
        before = row >> 1
        row = parser.table[before + parser.symbols[numbers]]
        if bounds[k] < bounds[k + 1]:
            at = column[bounds[k] : bounds[k + 1]]
            rare = parser.rare[numbers[at]]
            key = (before[at] // _WIDTH).astype(np.int64) * len(parser.restarts) + rare
            place = np.minimum(np.searchsorted(parser.keys, key), len(parser.keys) - 1)
            row[at] = np.where(parser.keys[place] == key, parser.values[place], parser.restarts[rare])
        ended += row & 1
    return ended


def phrase_rates(model: Model, texts: list[str]) -> np.ndarray:
    """Bits per character of every text in every language."""
    lengths = np.array([len(t) for t in texts])
    blocks = np.maximum(1, -(-lengths // BLOCK))
    first = np.concatenate([[0], np.cumsum(blocks)])
    # Numbers of characters; those in no sample have the last but one, padding the last.
    padding = len(model.parsers[0].symbols) - 1
    numbers = np.full(first[-1] * BLOCK, padding, np.int32)
    for text, start in zip(texts, first):
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        numbers[start * BLOCK : start * BLOCK + len(points)] = model.codes[points]
    steps = np.ascontiguousarray(numbers.reshape(-1, BLOCK).T)
    ended = [np.add.reduceat(_phrases(parser, steps), first[:-1]) for parser in model.parsers]
    return (np.stack(ended, 1) + 1) * np.array(model.bits) / np.maximum(1, lengths)[:, None]


def _batches(texts: list[str]) -> Iterator[slice]:
    start = total = 0
    for i, text in enumerate(texts):
        if total and total + len(text) > _CHARS_AT_ONCE:
            yield slice(start, i)
            start, total = i, 0
        total += len(text)
    if texts:
        yield slice(start, len(texts))


def predict_texts(model: Model, texts: list[str]) -> tuple[list[str], np.ndarray]:
    """The winning language of each text and how clearly it won, from 0 to 1."""
    names: list[str] = []
    scores = np.zeros(len(texts))
    for part in _batches(texts):
        rates = phrase_rates(model, [t.lower() for t in texts[part]])
        best = rates.argmin(1)
        names += [model.languages[i] for i in best]
        if len(model.languages) == 1:
            scores[part] = 1.0
        else:
            two = np.partition(rates, 1, axis=1)
            scores[part] = two[:, 1] / (two[:, 0] + two[:, 1])
    return names, scores


def predictor(spark: SparkSession, model: Model) -> Callable[[Column], Column]:
    """A function from a text column to a struct of ``lang`` and ``score``."""
    bound_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def parsed(texts: pd.Series) -> pd.DataFrame:
        names, scores = predict_texts(shared.value, texts.fillna("").tolist())
        return pd.DataFrame({"lang": names, "score": scores})

    nothing = F.struct(F.lit(UNDETERMINED).alias("lang"), F.lit(0.0).alias("score"))
    if not model.languages:
        return lambda text: nothing
    return lambda text: F.when(has_letter(text), parsed(text)).otherwise(nothing)


def identify(
    labelled: DataFrame,
    text: str = "text",
    label: str = "lang",
) -> Callable[[Column], Column]:
    """Learn from ``labelled`` and return the function that predicts."""
    model = learn(sample_labelled(labelled, text=text, label=label))
    return predictor(labelled.sparkSession, model)
