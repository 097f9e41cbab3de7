import hashlib
import random
from collections import Counter

import numpy as np
import pytest

import public_tokenizers
from ludolens.llm import alignment

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def made():
    return alignment.Aligner(*PATHS)


def brute(made, text):
    """Ids of both sides for each group; None without tokens."""
    if not text:
        return None
    a, b = made.a.encode(" " + text, add_special_tokens=False).ids, made.b.encode(text)
    data = (" " + text).encode()
    tokens = [[made.a_bytes[i] for i in a], [made.b_bytes[i] for i in b]]
    if any(b"".join(t) != data for t in tokens):
        return None
    ends = [np.cumsum([len(x) for x in t]).tolist() for t in tokens]
    groups, at = [], [0, 0]
    for end in sorted(set(ends[0]) & set(ends[1])):
        upto = [e.index(end) + 1 for e in ends]
        groups.append((a[at[0] : upto[0]], b[at[1] : upto[1]]))
        at = upto
    return groups


def brute_rows(made, texts):
    grouped = [brute(made, t) for _, t in texts]
    links = [Counter((p, q) for x, y in g or [] for p in x for q in y) for g in grouped]
    held = Counter(pair for link in links for pair in link)
    most = Counter()
    for (p, _), n in held.items():
        most[p] = max(most[p], n)
    out = []
    for (key, _), groups, link in zip(texts, grouped, links):
        if groups is None:
            out.append((key, 0, 0, 0, 0, 0, 0, ""))
            continue
        told = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        best = sum(n for pair, n in link.items() if held[pair] == most[pair[0]])
        counted = sum(n * held[pair] for pair, n in link.items())
        sizes = [sum(len(g[i]) for g in groups) for i in (0, 1)]
        digest = hashlib.sha256(told.encode()).hexdigest()
        out.append((key, *sizes, len(groups), sum(link.values()), best, counted, digest))
    return sorted(out, key=repr)


def odd_texts():
    rng = random.Random(5)
    alphabet = "ab c'st  \n\té日\U0001f600\xa0\x1c\x85.,1!<|>_́İß　"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) for _ in range(400)]
    texts += ["<|endoftext|> hi <s> </s> <unk> <0x41>", " ", "  a", "a ", "\x00", "don't we'll I 'm 's", "a  b c   d"]
    texts += ["▁", "a ▁ b", "x▁y", "x" * 5000, "日本語" * 500, "one two " * 2000, None, "", "one two one", "one two one"]
    return [(None if i % 50 == 3 else i % 300, t) for i, t in enumerate(texts)]


def test_documents_equal_brute_force(spark, rows, documents, made):
    texts = odd_texts()
    got = rows(alignment.align_documents(documents(texts).repartition(3), *PATHS))
    assert got == brute_rows(made, texts)


def test_stretches_do_not_change_a_text(made):
    text = " ".join(["a  b", "don't", "日本 x", "longer-words,", "\n\n", "tail "] * 40)
    whole, parts = alignment._Document(), alignment._Document()
    alignment._align_stretches(made, [(whole, text)])
    cut = list(alignment.cut_text(text, 50))
    assert len(cut) > 10 and " ".join(cut) == text
    for part in cut:
        alignment._align_stretches(made, [(parts, part)])
    assert whole.counts.tolist() == parts.counts.tolist() and whole.digest.digest() == parts.digest.digest()


def test_small_products_equal_dense_ones(monkeypatch):
    monkeypatch.setattr(alignment, "_EXPANDED", 5)
    rng = np.random.default_rng(3)
    for _ in range(20):
        dense = [rng.integers(0, 3, shape) * rng.integers(0, 2, shape) for shape in ((7, 9), (9, 6))]
        sparse = []
        for m in dense:
            row, column = np.nonzero(m)
            sparse.append(alignment.Csr(np.searchsorted(row, np.arange(len(m) + 1)), column, m[row, column]))
        made = alignment.row_products(*sparse, 6)
        back = np.zeros((7, 6), np.int64)
        back[made.rows(), made.column] = made.value
        assert (back == dense[0] @ dense[1]).all()


def test_overlaps_count_shared_bytes():
    shared = alignment.overlaps(np.array([3, 2, 1]), np.array([1, 4, 1]))
    assert list(zip(shared.rows(), shared.column, shared.value)) == [(0, 0, 1), (0, 1, 2), (1, 1, 2), (2, 2, 1)]
    assert [g.tolist() for g in alignment.common_groups(shared, 3)] == [[0, 0, 1], [0, 0, 1]]


def test_empty_table_and_clashing_names(spark, rows, documents):
    assert rows(alignment.align_documents(documents([]), *PATHS)) == []
    extra = spark.createDataFrame(
        [("k", "one two", 1, "x", [1])], "doc_id string, text string, row int, key string, pairs array<int>"
    )
    assert rows(alignment.align_documents(extra, *PATHS))[0][:2] == ("k", 2)
