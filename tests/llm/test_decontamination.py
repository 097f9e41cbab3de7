import random
import re

import pytest

from ludolens.llm import decontamination

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(docs, items, window):
    told = [(name, words(text)) for name, text in items]
    out = []
    for key, text in docs:
        own, hit, names = words(text), set(), set()
        for name, w in told:
            width = min(window, len(w))
            for i in range(len(w) - width + 1 if width else 0):
                for at in range(len(own) - width + 1):
                    if own[at : at + width] == w[i : i + width]:
                        hit.update(range(at, at + width))
                        names.add(name)
        out.append((key, len(own), len(hit), sorted(n for n in names if n is not None)))
    return sorted(out, key=repr)


def _case(seed, window):
    rng = random.Random(seed)
    vocabulary = ["ab", "Cd", "é", "7x", "日本", "ñ"]
    made = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(f"i{i}", made(rng.choice([1, 3, window, 2 * window + 1]))) for i in range(6)]
    items += [("i0", items[0][1]), (None, made(window)), ("none", None), ("blank", " .!? "), ("i2", made(window))]
    docs = []
    for i in range(40):
        text = made(rng.randint(0, 40))
        if rng.random() < 0.5:
            text += "; " + (rng.choice(items)[1] or "").upper()
        docs.append((i, text))
    docs += [(3, docs[3][1]), (3, docs[3][1]), (None, docs[5][1]), (90, None), (91, ""), (92, "..."), (93, (items[3][1] + " ") * 300)]
    return docs, items


@pytest.mark.parametrize("seed, window, block", [(1, 4, 1 << 20), (2, 4, 100), (3, 6, 300), (4, 10, 200)])
def test_matches_equal_brute_force(spark, rows, documents, seed, window, block):
    docs, items = _case(seed, window)
    if seed == 3:
        # Without items of one or three words, only long runs enter the order.
        items = [i for i in items if len(words(i[1])) >= window]
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    found = decontamination.find_matches(documents(docs).repartition(3), benchmark, window, block)
    got = rows(found, "doc_id", "n_words", "n_hit", "items")
    assert got == brute(docs, items, window)
    if seed == 2:
        clean = rows(decontamination.decontaminate(documents(docs), benchmark, window), "doc_id", "text")
        hit = {(r[0], r[1]) for r in zip([d[0] for d in docs], [d[1] for d in docs]) if brute([r], items, window)[0][2]}
        assert clean == sorted(((k, t) for k, t in docs if (k, t) not in hit), key=repr)


def test_small_shards_and_blocks_of_matches(spark, rows, documents, monkeypatch):
    docs, items = _case(7, 4)
    held = decontamination.Items([(n, t) for n, t in items if t is not None], 4)
    monkeypatch.setattr(decontamination, "_PLACES_AT_ONCE", 7)
    monkeypatch.setattr(decontamination, "_SLICE_BYTES", 9)
    shard = decontamination.Shard(held, [held.numbers(t or "") for _, t in docs])
    spans, listed = shard.hits()
    for i, (key, text) in enumerate(docs):
        want = brute([(key, text)], items, 4)[0]
        assert sum(e - b for b, e in spans.get(i, [])) == want[2]
        assert sorted({held.names[n] for n in listed.get(i, [])} - {None}) == want[3]


def test_longest_match_and_place(spark, documents):
    item = "one two three four five six seven eight"
    docs = [(1, "x three four five six seven y"), (2, "a b one two three four five z"), (3, "three four six")]
    benchmark = spark.createDataFrame([("q", item), ("r", "nothing of this kind here")], "item_id string, text string")
    got = decontamination.longest_matches(documents(docs), benchmark, window=4).collect()
    assert [tuple(r) for r in got] == [("q", 5, 0, 2, 2)]


def test_empty_tables_and_clashing_names(spark, rows, documents):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert rows(decontamination.find_matches(documents([]), none)) == []
    got = rows(decontamination.find_matches(documents([(1, "a b")]), none), "doc_id", "n_words", "n_hit", "items")
    assert got == [(1, 2, 0, [])]
    extra = spark.createDataFrame(
        [(1, "p q r", "x", 1, 2)], "doc_id int, text string, digest string, spans int, n_words int"
    )
    items = spark.createDataFrame([(5, "Q R", 1)], "item_id bigint, text string, block int")
    assert rows(decontamination.find_matches(extra, items), "doc_id", "n_hit", "items") == [(1, 2, ["5"])]
    assert decontamination.decontaminate(extra, none).columns == extra.columns
    assert decontamination.decontaminate(extra, items).count() == 0
