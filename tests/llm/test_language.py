import os
import random

import numpy as np
from pyspark.sql import functions as F

from ludolens.llm import language, queries
from ludolens.llm.language import BLOCK

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def greedy_phrases(sample, text):
    """Longest phrases of ``text`` that occur in ``sample``, found by searching; ended ones only.

    A character that the sample lacks ends a phrase and belongs to it.
    """
    ended = 0
    for block in (text[i : i + BLOCK] for i in range(0, len(text), BLOCK)):
        phrase = ""
        for c in block:
            if phrase + c in sample:
                phrase += c
                continue
            ended += 1
            phrase = c if c in sample else ""
    return ended


def test_parse_equals_search():
    rng = random.Random(1)
    sample = "".join(rng.choice("abc d") for _ in range(300))
    model = language.learn({"x": sample})
    texts = ["".join(rng.choice("abc dz") for _ in range(n)) for n in (0, 1, 5, 255, 256, 257, 900)]
    rates = language.phrase_rates(model, texts)[:, 0]
    ours = np.rint(rates * np.maximum(1, [len(t) for t in texts]) / model.bits[0]).astype(int) - 1
    assert ours.tolist() == [greedy_phrases(sample, t) for t in texts]


def test_automaton_accepts_exactly_the_substrings():
    symbols = [0, 1, 0, 0, 1, 1, 0, 1]
    edges = language.suffix_automaton(symbols)

    def accepts(word):
        state = 0
        for s in word:
            if s not in edges[state]:
                return False
            state = edges[state][s]
        return True

    parts = {tuple(symbols[i:j]) for i in range(9) for j in range(i, 9)}
    for n in range(6):
        for number in range(2**n):
            word = tuple(number >> i & 1 for i in range(n))
            assert accepts(word) == (word in parts)


def test_languages_are_told_apart(documents):
    docs = documents(
        [(i, "the cat and the dog of the house " * 3, "en", "s") for i in range(5)]
        + [(9 + i, "der hund und die katze von nebenan " * 3, "de", "s") for i in range(5)]
    )
    predict = language.identify(docs)
    got = docs.select("lang", predict(F.col("text"))["lang"].alias("found")).collect()
    assert all(r["lang"] == r["found"] for r in got)


def test_odd_rows(odd):
    predict = language.identify(odd)
    got = [(r["text"], *r["p"]) for r in odd.select("text", predict(F.col("text")).alias("p")).collect()]
    assert len(got) == 12
    assert all((lang == "und") == (not text or not any(c.isalpha() for c in text)) for text, lang, _ in got)
    assert all(0 <= score <= 1 for _, _, score in got)


def test_empty_and_unlabelled(documents, odd):
    none = documents([])
    assert none.select(language.identify(none)(F.col("text"))).collect() == []
    predict = language.identify(none)
    assert {r[0]["lang"] for r in odd.select(predict(F.col("text"))).collect()} == {"und"}


def test_one_language_wins_with_certainty(documents):
    docs = documents([(1, "only one language here", "en", "s")])
    assert docs.select(language.identify(docs)(F.col("text"))).first()[0] == ("en", 1.0)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang", F.length("text").alias("n"))
    got = queries.op1_language_id(spark, FOLDER).join(docs, "doc_id").where("held_out and n > 100").collect()
    assert len(got) > 10
    assert sum(r["lang"] == r["lang_pred"] for r in got) / len(got) > 0.97


def test_parse_equals_search_with_many_characters():
    rng = random.Random(2)
    signs = [chr(0x4E00 + i) for i in range(500)] + list("abc d")
    sample = "".join(rng.choice(signs) for _ in range(900))
    model = language.learn({"x": sample, "y": "other letters: éèñ"})
    texts = [sample[40:90] + "zab" + sample[300:333], "".join(rng.choice([*signs, "z", "é"]) for _ in range(700)), ""]
    rates = language.phrase_rates(model, texts)[:, 0]
    ours = np.rint(rates * np.maximum(1, [len(t) for t in texts]) / model.bits[0]).astype(int) - 1
    assert ours.tolist() == [greedy_phrases(sample, t) for t in texts]


def test_scripts_are_told_apart():
    rng = random.Random(3)
    # Two languages in each of four scripts, made of the same characters; one script is large.
    scripts = {"la": (0x61, 26), "cy": (0x430, 32), "gr": (0x3B1, 25), "zh": (0x4E00, 900)}
    words = {
        f"{name}{k}": ["".join(chr(first + rng.randrange(n)) for _ in range(rng.randrange(2, 6))) for _ in range(60)]
        for name, (first, n) in scripts.items()
        for k in (1, 2)
    }
    # The smaller the script's sample, the fewer of its characters are among the most frequent of all.
    sizes = {"la": 6000, "cy": 1200, "gr": 900, "zh": 900}
    text = lambda name, n: " ".join(rng.choice(words[name]) for _ in range(n))
    model = language.learn({name: text(name, sizes[name[:2]]) for name in words})
    texts = [(name, text(name, 12)) for name in words for _ in range(20)]
    found, _ = language.predict_texts(model, [t for _, t in texts])
    assert found == [name for name, _ in texts]


def test_more_languages_than_full_samples(documents):
    texts = {f"l{i:03}": f"{chr(0x4E00 + i) * 3} {chr(0x4E00 + i) * 2}" for i in range(300)}
    docs = documents([(i, text, name) for i, (name, text) in enumerate(texts.items())])
    samples = language.sample_labelled(docs)
    assert samples == texts
    names, _ = language.predict_texts(language.learn(samples), list(texts.values()))
    assert names == list(texts)


def test_texts_of_a_language_share_the_bound(documents, monkeypatch):
    monkeypatch.setattr(language, "MODEL_TEXTS", 10)
    docs = documents([(i, f"text {chr(97 + i)}", "ab"[i % 2]) for i in range(26)])
    assert {k: len(v.split("\n")) for k, v in language.sample_labelled(docs).items()} == {"a": 5, "b": 5}


def test_copies_teach_once(spark, documents):
    few = documents([(i, f"something else {chr(97 + i)}", "en") for i in range(20)])
    copies = spark.range(50_000).select(
        F.col("id").alias("doc_id"), F.lit("the same text").alias("text"), F.lit("en").alias("lang")
    )
    both = few.select("doc_id", "text", "lang").unionByName(copies)
    parts = language.sample_labelled(both)["en"].split("\n")
    assert len(parts) == 21 and len(set(parts)) == 21
    assert language.sample_labelled(both.withColumn("doc_id", -F.col("doc_id"))) == language.sample_labelled(both)
