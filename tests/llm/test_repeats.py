import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ludolens.llm import repeats
from ludolens.llm.suffixes import repeated_starts, suffix_order


def _brute(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    count = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (key, _), t in zip(rows, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((key, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def _got(frame):
    return sorted(
        ((r[0], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in frame.collect()),
        key=repr,
    )


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 3), min_size=1, max_size=60), st.integers(1, 70))
def test_suffix_order(symbols, depth):
    order = suffix_order(np.array(symbols, np.int64), depth).tolist()
    assert sorted(order) == list(range(len(symbols)))
    prefixes = [symbols[i : i + depth] for i in order]
    assert prefixes == sorted(prefixes)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("ab", min_size=8, max_size=40), min_size=1, max_size=6), st.integers(8, 12))
def test_repeated_starts(texts, length):
    pieces = [t.encode() for t in texts if len(t) >= length]
    if not pieces:
        return
    starts = np.array([len(p) - length + 1 for p in pieces])
    count = Counter(p[i : i + length] for p, n in zip(pieces, starts) for i in range(n))
    want = [[i for i in range(n) if count[p[i : i + length]] > 1] for p, n in zip(pieces, starts)]
    assert [f.tolist() for f in repeated_starts(pieces, starts, length)] == want


def test_runs_hold_every_place_once():
    rng = random.Random(16)
    texts = ["".join(rng.choice("abc") for _ in range(n)).encode() for n in (10, 39, 40, 41, 300)]
    text, first, own, _ = repeats.runs_of(texts, 40, 8)
    places = [(t, f + i) for t, f, n in zip(text.tolist(), first.tolist(), own.tolist()) for i in range(n)]
    assert sorted(places) == [(t, i) for t in range(5) for i in range(len(texts[t]) - 39)]


@pytest.mark.parametrize("hot_runs", [1, 2, 3000])
def test_removal_equals_brute_force(documents, hot_runs):
    rng = random.Random(17)
    passages = ["".join(rng.choice("abcdé ") for _ in range(n)) for n in (30, 40, 45, 80)]
    rows = []
    for i in range(60):
        parts = ["".join(rng.choice("xyz") for _ in range(rng.randrange(60)))]
        for _ in range(rng.randrange(3)):
            parts += [rng.choice(passages), "".join(rng.choice("uvw") for _ in range(rng.randrange(9)))]
        rows.append((i, "".join(parts)))
    rows += [(100, "ab" * 50), (101, rows[0][1]), (102, ""), (103, None), (None, "q" * 90), (5, "short"), (5, "short")]
    got = repeats.remove_repeats(documents(rows).repartition(3), length=40, window=8, hot_runs=hot_runs)
    assert _got(got) == _brute(rows, 40)


def test_odd_rows(odd):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert _got(repeats.remove_repeats(odd, length=16, window=8)) == _brute(rows, 16)
    assert repeats.remove_repeats(odd.limit(0)).collect() == []


def test_spans_name_the_removed_bytes(documents):
    shared = "the same passage of text in two places " * 2
    got = repeats.remove_repeats(documents([(1, "a" + shared + "b"), (2, "c" + shared)]), length=40, window=8)
    spans = {r["doc_id"]: [tuple(s) for s in r["removed"]] for r in got.collect()}
    assert spans == {1: [(1, 1 + len(shared))], 2: [(1, 1 + len(shared))]}


def test_windows_of_long_texts_are_those_of_short_ones(monkeypatch):
    rng = np.random.default_rng(3)
    shared = rng.integers(0, 256, 60, np.uint8).tobytes()
    filler = [rng.integers(0, 256, n, np.uint8).tobytes() for n in (1500, 40, 2900, 7)]
    texts = [filler[0] + shared + filler[1], b"", filler[2] + shared, filler[3]]

    def windows():
        found = {}
        for part in repeats.all_runs(texts, 40, 8):
            for text, first, own, window in zip(*(c.tolist() for c in part)):
                for place in range(first, first + own):
                    assert (text, place) not in found
                    found[text, place] = window
        return found

    whole = windows()
    assert len(whole) == sum(max(0, len(t) - 39) for t in texts)
    assert all(whole[0, 1500 + i] == whole[2, 2900 + i] for i in range(21))
    for bits in (6, 7, 9, 10):
        monkeypatch.setattr(repeats, "_PLACE_BITS", bits)
        cut = windows()
        assert cut.keys() == whole.keys()
        assert all(cut[0, 1500 + i] == cut[2, 2900 + i] for i in range(21))


def test_more_bytes_than_places_is_an_error(monkeypatch):
    monkeypatch.setattr(repeats, "_PLACE_BITS", 7)
    with pytest.raises(ValueError):
        repeats.runs_of([bytes(200)], 40, 8)
