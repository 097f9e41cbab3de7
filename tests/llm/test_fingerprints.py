import hashlib
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from ludolens.llm import fingerprints as fp


def of(text):
    return fp.prefixes(fp.code_points(text))


@settings(max_examples=60, deadline=None)
@given(st.text("ab", max_size=30), st.text("ab", max_size=30), st.data())
def test_spans_and_extensions(x, y, data):
    a, b = of(x), of(y)
    i = data.draw(st.integers(0, len(x)))
    j = data.draw(st.integers(0, len(y)))
    n = data.draw(st.integers(0, min(len(x) - i, len(y) - j)))
    assert fp.spans_equal(a, i, b, j, n) == (x[i : i + n] == y[j : j + n])
    common = 0
    while i + common < len(x) and j + common < len(y) and x[i + common] == y[j + common]:
        common += 1
    assert fp.common_extension(a, i, b, j) == common


def test_thue_morse_texts_differ():
    bits = [0]
    while len(bits) < 4096:
        bits += [1 - b for b in bits]
    one = "".join("ab"[b] for b in bits)
    other = "".join("ba"[b] for b in bits)
    assert fp.fingerprint(of(one)).text() != fp.fingerprint(of(other)).text()


def test_written_fingerprint_says_the_same():
    rng = random.Random(3)
    for n in (0, 1, 31, 32, 33, 64, 65, 1000):
        a = "".join(rng.choice("abcd") for _ in range(n))
        b = a[: n // 2] + "z" + a[n // 2 + 1 :]
        f, g = fp.fingerprint(of(a)), fp.fingerprint(of(b))
        f2, g2 = fp.parse_fingerprint(f.text()), fp.parse_fingerprint(g.text())
        assert fp.likeness(f, g) == fp.likeness(f2, g2)
        assert fp.likeness(f, f2) == 1.0
        assert n < 4 or fp.likeness(f, g) >= 1 - 2 * f.stride / n


def test_edited_prefixes_equal_those_of_the_edited_text():
    text, added = "abcdefgh" * 9, "xyz"
    ours = fp.edited_prefixes(of(text), 50, fp.code_points(added))
    assert np.array_equal(ours.hashes, of(text[:50] + added).hashes)


def _brute(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    texts = [t or "" for _, t in order]
    out = []
    for i, (key, _) in enumerate(order):
        cut = len(texts[i]) // 4
        out.append((key, texts[i][: len(texts[i]) - cut] + texts[(i + 1) % len(texts)][:cut]))
    return sorted(out, key=repr)


def test_neighbours_over_many_ranges(spark, documents):
    rng = random.Random(5)
    rows = [(i * 3, "".join(rng.choice("ab é\U0001f600") for _ in range(rng.randrange(40)))) for i in range(200)]
    docs = documents([(k, t) for k, t in rows]).repartition(5)
    got = fp.with_neighbours(docs).collect()
    assert sorted(((r["doc_id"], r["edited_text"]) for r in got), key=repr) == _brute(rows)
    for r in got:
        assert r["n_chars"] == len(dict(rows)[r["doc_id"]])
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1


def test_odd_rows(odd):
    got = fp.with_neighbours(odd).collect()
    assert len(got) == 12
    for r in got:
        assert fp.parse_fingerprint(r["fingerprint"]).length == r["n_chars"]
    same = {r["fingerprint"] for r in got if r["doc_id"] in (1, 2)}
    assert len(same) == 1


def test_equal_keys_are_split_by_text(documents):
    rows = [(None, f"text {i} " * 5) for i in range(60)]
    got = fp.with_neighbours(documents(rows)).collect()
    assert len(got) == 60
    followed = [hashlib.sha256(r["edited_text"].encode()).hexdigest() for r in got]
    assert len(set(followed)) == 60


def test_one_row_and_none(documents):
    only = fp.with_neighbours(documents([(1, "abcdefgh")])).first()
    assert only["edited_text"] == "abcdefab" and only["near_next"] == 1.0
    assert fp.with_neighbours(documents([])).collect() == []
