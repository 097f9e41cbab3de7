import random
import re
import zlib
from collections import Counter

import pytest

from ludolens.llm import spelling


def edited_once(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute_counts(texts):
    counts = Counter()
    for key, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            own = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if own % 97 == 0:
                at = own % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def brute_forms(counts):
    def keys(word):
        return {word, *(word[:i] + word[i + 1 :] for i in range(len(word)))}

    shared = {}
    for word in counts:
        for key in keys(word):
            shared.setdefault(key, []).append(word)
    rows = {}
    for word, n in counts.items():
        near = {w for key in keys(word) for w in shared[key] if edited_once(word, w)}
        best = min(near, key=lambda w: (-counts[w], w), default=None)
        rows[word] = (best if best is not None and counts[best] >= 2 * n else None, len(near))
    out = []
    for word, (form, near) in rows.items():
        root = word
        while rows[root][0] is not None:
            root = rows[root][0]
        out.append((word, form, root, counts[word], near, counts.get(form)))
    return sorted(out, key=repr)


def _words(seed, count):
    rng = random.Random(seed)
    letters = "abé"
    made = {"".join(rng.choice(letters) for _ in range(rng.randint(5, 9))) for _ in range(count)}
    return {w: rng.choice([3, 4, 6, 12, 25, 50, 100]) for w in sorted(made)}


@pytest.mark.parametrize("tile", [2, 16, 256])
def test_forms_equal_brute_force(spark, rows, tile):
    words = _words(tile, 600)
    table = spark.createDataFrame(list(words.items()), "word string, n bigint").repartition(3)
    got = rows(spelling.spelling_forms(table, tile=tile))
    assert got == brute_forms(words)


def test_many_words_with_one_half(spark, rows):
    words = {f"stamm{a}{b}{c}": 3 + (a == b) * 9 for a in "abcdefgh" for b in "abcdefgh" for c in "abcdefg"}
    table = spark.createDataFrame(list(words.items()), "word string, n bigint")
    assert rows(spelling.spelling_forms(table, tile=64)) == brute_forms(words)


def test_chain_of_forms_and_ties(spark, rows):
    words = {"abcde": 3, "abcdf": 6, "abcgf": 12, "abhgf": 24, "ibhgf": 48, "zzzzz": 3, "zzzzy": 6, "zzzzx": 6}
    table = spark.createDataFrame(list(words.items()), "word string, n bigint")
    got = {r[0]: r for r in rows(spelling.spelling_forms(table))}
    assert got["abcde"][1:3] == ("abcdf", "ibhgf")
    assert got["zzzzz"][1:3] == ("zzzzx", "zzzzx")
    assert list(got.values()) == brute_forms(words)


def test_words_of_odd_documents(spark, rows, documents):
    texts = [
        (1, "Straße STRASSE straße Ünder ünder, naïve ÿÿÿÿÿ ÿÿÿÿÿ ÿÿÿÿÿ"),
        (1, "Straße STRASSE straße Ünder ünder, naïve"),
        (1, "Straße STRASSE straße Ünder ünder, naïve"),
        (None, "Straße naïve naïveté × ÷ wordłword wordw"),
        (2, None),
        (3, ""),
        (4, "日本語 \U0001f600 Kİng"),
        (5, "wordy " * 5000 + "x" * 70_000 + " " + "x" * 70_000 + " " + "x" * 70_000),
        *((i, "common wording of other words") for i in range(10, 400)),
    ]
    counts = dict(rows(spelling.count_words(documents(texts))))
    assert counts == brute_counts(texts)
    assert rows(spelling.spelling_forms(spelling.count_words(documents(texts)))) == brute_forms(counts)


def test_empty_table_and_clashing_names(spark, rows, documents):
    assert rows(spelling.spelling_forms(spelling.count_words(documents([])))) == []
    texts = [(i, "again and again someword") for i in range(5)]
    more = spark.createDataFrame([(i, t, "x", 1, "g") for i, t in texts], "doc_id int, text string, word string, n int, group string")
    assert dict(rows(spelling.count_words(more))) == brute_counts(texts)
