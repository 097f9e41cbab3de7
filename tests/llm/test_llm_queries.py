"""The registered queries of this part on the smallest test tables."""

import base64
import hashlib
import os
import zlib

import comparing
import pytest
from test_alignment import PATHS, brute_rows
from test_repeats import _brute as brute_repeats
from test_spelling import brute_counts, brute_forms

import __spark_entry__ as contract
from ludolens.llm import alignment, queries

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    return sorted((r["doc_id"], r["text"] or "") for r in rows)


def _rows(spark, name):
    return [r.asDict() for r in queries.QUERIES[name](spark, FOLDER).collect()]


def test_all_operators_and_the_pipeline_are_registered():
    names = contract.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14))
    assert "pipeline" in names
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    connection = comparing.open_tables(FOLDER)
    ours = comparing.spark_bag(queries.QUERIES[name](spark, FOLDER))
    assert comparing.difference(ours, comparing.sql_bag(connection, queries.ORACLE_SQL[name])) is None
    connection.close()


def test_fingerprints(spark, texts):
    got = {r["doc_id"]: r for r in _rows(spark, "op2_fingerprints")}
    by_text = {}
    for i, (key, text) in enumerate(texts):
        following = texts[(i + 1) % len(texts)][1]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        row = got[key]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert row["near_edited"] > 0.6 and row["near_edited"] > row["near_next"]
        by_text.setdefault(text, set()).add(row["fingerprint"])
        if edited in by_text:
            assert by_text[edited] == {row["edited_fingerprint"]}
    assert all(len(f) == 1 for f in by_text.values())
    assert len(got) == len(texts) and len({min(f) for f in by_text.values()}) == len(by_text)


def test_sharding(spark, texts):
    got = _rows(spark, "op7_sharding")
    known = {k: (len(t.encode()) + 1, zlib.crc32(t.encode())) for k, t in texts}
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in got} == known
    assert all(r["law"] == "key" and r["grown_shard"] in (r["shard"], 16) for r in got)
    for shard in range(16):
        slots = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert slots == list(range(len(slots)))


def test_warc(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").collect()
    largest = {}
    for p in pages:
        largest[p["html"] or ""] = max(p["page_id"], largest.get(p["html"] or "", p["page_id"]))
    want = []
    for p in pages:
        payload = (p["html"] or "").encode()
        top = largest[p["html"] or ""]
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        first = top == p["page_id"]
        want.append((p["page_id"], len(payload), digest, "response" if first else "revisit", None if first else top))
    assert sorted(tuple(r.values()) for r in _rows(spark, "op4_warc")) == sorted(want)


def test_repeats(spark, texts):
    got = sorted((tuple(r.values()) for r in _rows(spark, "op10_suffix_dedup")), key=repr)
    assert got == brute_repeats(texts, 400)


def test_spelling_variants(spark, texts):
    got = sorted((tuple(r.values()) for r in _rows(spark, "op11_spelling_variants")), key=repr)
    assert got == brute_forms(brute_counts(texts))


def test_token_alignment(spark, texts):
    got = sorted((tuple(r.values()) for r in _rows(spark, "op12_token_alignment")), key=repr)
    assert got == brute_rows(alignment.Aligner(*PATHS), texts)


def test_mixing_repeats_itself(spark):
    first, again = (sorted(tuple(r.values()) for r in _rows(spark, "op5_mixing")) for _ in range(2))
    assert first == again


def test_secret_scan_finds_assigned_tokens(spark, texts):
    got = _rows(spark, "op9_secret_scan")
    found = {(r["doc_id"], r["candidate"]) for r in got if r["is_secret"]}
    for key, text in texts:
        for part in text.split('token = "')[1:]:
            assert (key, part.split('"')[0]) in found
    assert all(any(c.isdigit() for c in candidate) for _, candidate in found)
