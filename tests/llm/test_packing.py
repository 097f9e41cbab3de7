import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import public_tokenizers
from ludolens.llm import packing
from ludolens.llm.tokens import WordEncoder

PATH = public_tokenizers.path("word_bpe_49k.json")


def _whole(pieces, capacity):
    """Sequences are gapless from 0 and none is over full."""
    bins = defaultdict(list)
    for r in pieces:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


@pytest.mark.parametrize(
    "text",
    ["don't I'LL we're 's it's''s", "½ x² ª º ÀÉ ß ĀĮı İ", "a\x1cb", "x\xa0y\x85z", "<|endoftext|> hi", "日本 text", "é", "", "\n\n", "('s)"],
)
def test_words_encode_like_the_whole_text(text):
    whole = Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(WordEncoder(PATH).encode(text), "<u4").tolist() == whole


def test_words_of_a_batch_encode_like_whole_texts(monkeypatch):
    monkeypatch.setattr("ludolens.llm.tokens._REMEMBERED", 50)
    rng, whole, words = random.Random(8), Tokenizer.from_file(PATH), WordEncoder(PATH)
    alphabet = "abcS'tTl  \t\n09.,!-é\xa0½ª日<|>"
    for _ in range(30):
        texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(20)]
        got = [np.frombuffer(ids, "<u4").tolist() for ids in words.encode_all(texts)]
        assert got == [whole.encode(t, add_special_tokens=False).ids for t in texts]


def test_fullest_is_the_best_subset_sum():
    rng = random.Random(2)
    for _ in range(200):
        available = [(n, rng.randint(1, 3)) for n in sorted(rng.sample(range(1, 30), 5), reverse=True)]
        slack = rng.randint(0, 60)
        sums = {0}
        for n, count in available:
            sums = {s + n * k for s in sums for k in range(count + 1)}
        chosen = packing.fullest(slack, available)
        assert sum(n * k for n, k in chosen) == max(s for s in sums if s <= slack)
        assert all(k <= dict(available)[n] for n, k in chosen)


def test_plan_uses_every_piece_once():
    counts = {2048: 3, 1500: 7, 500: 9, 48: 20, 1: 5}
    plan = packing.minimum_bin_slack(counts)
    assert len(plan.at) and plan.rank.min() == 0
    assert packing.minimum_bin_slack({}).at.size == 0


def test_pack_random_lengths(spark):
    rng = random.Random(4)
    rows = [(i, 0, 0, rng.randint(1, 100)) for i in range(2000)]
    pieces = spark.createDataFrame(rows, "key bigint, piece int, start bigint, length bigint").repartition(6)
    got = packing.pack(pieces, capacity=100).collect()
    assert sorted((r["key"], r["length"]) for r in got) == sorted((r[0], r[3]) for r in rows)
    bound = -(-sum(r[3] for r in rows) // 100)
    assert bound <= _whole(got, 100) <= bound * 1.01 + 1


def test_round_trip(odd):
    pieces = packing.tokenize(odd, PATH)
    whole = Tokenizer.from_file(PATH)
    want = defaultdict(list)
    for r in odd.collect():
        ids = whole.encode(r["text"] or "", add_special_tokens=False).ids + [0]
        for i in range(0, len(ids), 2048):
            part = np.array(ids[i : i + 2048], "<u4").tobytes()
            want[(r["doc_id"], i // 2048, i)].append(zlib.crc32(part))
    got = defaultdict(list)
    for r in pieces.collect():
        assert len(r["ids"]) == 4 * r["length"]
        got[(r["key"], r["piece"], r["start"])].append(zlib.crc32(bytes(r["ids"])))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    packed = packing.pack(pieces)
    rows = packed.collect()
    _whole(rows, 2048)
    made = {r["sequence_id"]: bytes(r["ids"]) for r in packing.sequences(packed).collect()}
    for r in rows:
        at = 4 * r["offset"]
        assert made[r["sequence_id"]][at : at + 4 * r["length"]] == bytes(r["ids"])


def test_no_rows(documents):
    assert packing.pack(packing.tokenize(documents([]), PATH).drop("ids")).collect() == []
