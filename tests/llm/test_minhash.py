import random
from collections import Counter

import numpy as np

from ludolens.llm import minhash
from ludolens.llm.shingles import shingle_elements


def _elements(text, size=5):
    words = text.lower().split()
    n = min(size, len(words)) or 1
    return Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if words else Counter()


def _similarity(a, b):
    x, y = _elements(a), _elements(b)
    union = sum((x | y).values())
    return sum((x & y).values()) / union if union else 0.0


def _classes(rows, least=0.8):
    """Smallest key in reach by equal texts or similarity, for rows of key and text."""
    named = [(k, t) for k, t in rows if k is not None and t is not None]
    low = {k: k for k, _ in named}
    pairs = [
        (a, b) for a, x in named for b, y in named if a < b and (x == y or _similarity(x, y) >= least)
    ]
    for _ in low:
        for a, b in pairs:
            low[a] = low[b] = min(low[a], low[b])
    return sorted(((k, low.get(k, k)) for k, _ in rows), key=repr)


def _copies(rng, count, words=60):
    base = [f"w{rng.randrange(500)}" for _ in range(words)]
    out = []
    for _ in range(count):
        copy = list(base)
        for _ in range(rng.randrange(4)):
            copy[rng.randrange(words)] = f"x{rng.randrange(10_000)}"
        out.append(" ".join(copy))
    return out


def test_shingles_are_counted_like_words_in_a_row():
    texts = ["a b a b a b a b", "one two", "", "  ", "A  b\ta\nb a b A b", "é ü é ü é x"]
    elements = shingle_elements(texts, 5)
    counts = np.diff(elements.start).tolist()
    assert counts == [sum(_elements(t).values()) for t in texts]
    sets = [set(elements.hashes[a:b].tolist()) for a, b in zip(elements.start, elements.start[1:])]
    assert sets[0] == sets[4]
    for i in range(6):
        for j in range(6):
            union = len(sets[i] | sets[j])
            assert (len(sets[i] & sets[j]) / union if union else 0.0) == _similarity(texts[i], texts[j])


def test_signatures_agree_as_often_as_texts_are_similar():
    rng = random.Random(12)
    texts = _copies(rng, 12) + ["short text", "short text of five words"]
    signed = minhash.signatures(texts, size=2000)
    for i in range(len(texts)):
        for j in range(i):
            assert abs((signed[i] == signed[j]).mean() - _similarity(texts[i], texts[j])) < 0.06


def test_signature_depends_on_the_text_alone():
    rng = random.Random(13)
    texts = _copies(rng, 6)
    alone = np.concatenate([minhash.signatures([t]) for t in texts])
    assert np.array_equal(minhash.signatures(texts), alone)


def test_classes_equal_brute_force(documents, monkeypatch):
    rng = random.Random(14)
    texts = [t for _ in range(5) for t in _copies(rng, 14)] + _copies(rng, 20, 7) + ["", "", " ", "one", "one", "One"]
    rng.shuffle(texts)
    rows = list(enumerate(texts)) + [(500, None), (None, texts[0]), (None, None)]
    # Small blocks, so that buckets are cut.
    monkeypatch.setattr(minhash, "_BLOCK_TEXTS", 4)
    got = minhash.near_duplicates(documents(rows).repartition(4)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == _classes(rows)


def test_odd_rows(odd):
    got = sorted((tuple(r) for r in minhash.near_duplicates(odd).collect()), key=repr)
    assert got == sorted(
        [(1, 1), (1, 1), (2, 1), (3, 3), (4, 4), (5, 5), (6, 6), (7, 7), (8, 8)] + [(None, None)] * 3, key=repr
    )
    assert minhash.near_duplicates(odd.limit(0)).collect() == []


def test_links_are_written_before_the_next_python_step(documents, monkeypatch):
    plans, components = [], minhash.components

    def seen(links, *names):
        plans.append(links._jdf.queryExecution().executedPlan().toString())
        return components(links, *names)

    monkeypatch.setattr(minhash, "components", seen)
    same = "the quick brown fox jumps over the lazy dog and runs away into the dark wood at night"
    docs = documents([(1, same), (2, same + " again"), (3, "und wieder ein ganz anderer Text")])
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(docs).collect()}
    assert got == {1: 1, 2: 1, 3: 3}
    assert len(plans) == 1 and "InArrow" not in plans[0]
