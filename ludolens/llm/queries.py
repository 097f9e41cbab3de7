"""One query per operator of this folder, over its whole table, and SQL where it can say the same."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ludolens.llm import (
    alignment,
    decontamination,
    embeddings,
    fingerprints,
    language,
    minhash,
    mixing,
    packing,
    repeats,
    secrets,
    sharding,
    spelling,
    warc,
)
from ludolens.llm.tables import table

SHARDS = 16
VOCABULARY = "word_bpe_49k.json"
BYTE_VOCABULARY = "byte_bpe_50k.json"
PIECE_VOCABULARY = "piece_bpe_32k.model"


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from labelled documents that are not held out.

    A document without doc_id is neither learned from nor held out.
    """
    docs = table(spark, sf_dir, "documents")
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    predict = language.identify(docs.where(remainder != 0))
    found = predict(F.col("text"))
    return docs.select(
        "doc_id", F.coalesce(remainder == 0, F.lit(False)).alias("held_out"), found.alias("found")
    ).select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), "found.score")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often the mix takes each document of every source."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select(
        "row.doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).alias("taken"),
        "copies",
    )


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of each document among 16 shards, and its shard among 17."""
    placed = sharding.place(table(spark, sf_dir, "documents"), [1.0] * SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and of its text edited with the next document's."""
    compared = fingerprints.with_neighbours(table(spark, sf_dir, "documents"))
    return compared.select(
        "doc_id",
        "n_chars",
        fingerprints.sha256_hex(F.col("edited_text")).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
        "prefix_edited",
        "prefix_next",
    )


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequence and offset of each piece of every document."""
    pieces = packing.tokenize(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
    packed = packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))
    return packed.withColumnRenamed("key", "doc_id")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to and read back from archives."""
    pages = table(spark, sf_dir, "pages")
    records = warc.read_archives(warc.write_archives(pages, warc.archive_folder(spark)))
    kind = pages.schema["page_id"].dataType.simpleString()
    return records.select(
        warc.key_of("record_id", kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc.key_of("refers_to", kind).alias("refers_to"),
    )


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector."""
    return embeddings.link(table(spark, sf_dir, "embeddings"))


_EMBEDDING_SQL = """
with recursive valid as (
  select vec_id, label, embedding::double[] as v from embeddings
  where vec_id is not null and label is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0
), pairs as (
  select a.vec_id as a, b.vec_id as b from valid a join valid b
    on a.label = b.label and a.vec_id <> b.vec_id and len(a.v) = len(b.v)
  where list_cosine_similarity(a.v, b.v) >= 0.98
), reach(node, low) as (
  select vec_id, vec_id from valid
  union
  select p.b, r.low from reach r join pairs p on p.a = r.node where r.low < p.b
), least as (
  select node, min(low) as component from reach group by node
), linked as (
  select a, count(*) as n from pairs group by a
)
select e.vec_id, coalesce(n, 0) as n_links, coalesce(component, e.vec_id) as component_id,
  coalesce(e.vec_id = coalesce(component, e.vec_id), true) as kept
from embeddings e left join linked on a = e.vec_id left join least on node = e.vec_id
"""


def op8_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near-duplicates of every document, and whether it stays for its class."""
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", (F.col("doc_id") == F.col("class_id")).alias("kept"))


_NEAR_SQL = r"""
with recursive texts as (
  select min(doc_id) as node, text from documents where doc_id is not null and text is not null group by text
), worded as (
  select node, regexp_extract_all(lower(text), '[^\x20\x09-\x0D]+') as w from texts
), shingled as (
  select node, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as s from worded
), elements as (
  select node, s, row_number() over (partition by node, s) as nth from shingled
), sizes as (
  select node, count(*) as n from elements group by node
), shared as (
  select a.node as a, b.node as b, count(*) as c from elements a join elements b
    on a.s = b.s and a.nth = b.nth and a.node <> b.node group by a.node, b.node
), pairs as (
  select a, b from shared join sizes x on x.node = a join sizes y on y.node = b where c >= 0.8 * (x.n + y.n - c)
), reach(node, low) as (
  select node, node from texts
  union
  select p.b, r.low from reach r join pairs p on p.a = r.node where r.low < p.b
), least as (
  select node, min(low) as class_id from reach group by node
)
select d.doc_id, coalesce(l.class_id, d.doc_id) as class_id, d.doc_id = coalesce(l.class_id, d.doc_id) as kept
from documents d left join texts t on d.text = t.text and d.doc_id is not null left join least l on l.node = t.node
"""


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate in every document with the chance that it is a secret."""
    found = secrets.scan(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("key").alias("doc_id"), "word_no", "candidate", *secrets.FEATURES, "score", "is_secret"
    )


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without byte strings that occur elsewhere too."""
    kept = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frequent word with the more frequent spelling it goes back to."""
    return spelling.spelling_forms(spelling.count_words(table(spark, sf_dir, "documents")))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between the tokens of two tokenizers in every document."""
    return alignment.align_documents(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path(BYTE_VOCABULARY),
        public_tokenizers.path(PIECE_VOCABULARY),
    )


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that benchmark items hold verbatim."""
    found = decontamination.find_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


_LEAK_SQL = r"""
with item_words as (
  select distinct item_id::varchar as item_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark where text is not null
), windows as (
  select item_id, least(len(w), 10) as width,
    unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: array_to_string(w[i:i + 9], ' '))) as words
  from item_words where len(w) > 0
), doc_words as (
  select row_number() over () as doc_no, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents
), widths as (
  select distinct width from windows
), places as (
  select doc_no, width, w, unnest(range(1, len(w) - width + 2)) as pos from doc_words, widths where len(w) >= width
), met as (
  select p.doc_no, p.pos, p.width, n.item_id from
    (select doc_no, pos, width, array_to_string(w[pos:pos + width - 1], ' ') as words from places) p
    join windows n on n.width = p.width and n.words = p.words
), hit as (
  select doc_no, count(distinct place) as n from (select doc_no, unnest(range(pos, pos + width)) as place from met) group by doc_no
), listed as (
  select doc_no, count(*) as n, string_agg(item_id, ',' order by item_id) as items
  from (select distinct doc_no, item_id from met where item_id is not null) group by doc_no
)
select d.doc_id, len(w)::bigint as n_words, coalesce(h.n, 0)::bigint as n_hit, coalesce(l.n, 0)::bigint as n_items,
  sha256(coalesce(l.items, '')) as items_sha256, coalesce(h.n, 0) > 0 as contaminated
from doc_words d left join hit h on h.doc_no = d.doc_no left join listed l on l.doc_no = d.doc_no
"""


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_fingerprints": op2_fingerprints,
    "op3_packing": op3_packing,
    "op4_warc": op4_warc,
    "op5_mixing": op5_mixing,
    "op6_embedding_dedup": op6_embedding_dedup,
    "op7_sharding": op7_sharding,
    "op8_minhash_dedup": op8_minhash_dedup,
    "op9_secret_scan": op9_secret_scan,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_token_alignment": op12_token_alignment,
    "op13_decontamination": op13_decontamination,
}

_MIX_SQL = r"""
with sized as (
  select *, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
    (('0x' || substr(md5(concat_ws('|', 'mix', coalesce(doc_id::varchar, 'null'), coalesce(source, 'null'),
      coalesce(md5(text), 'null'))), 1, 13))::bigint::double + 0.5) / 4503599627370496.0 as draw
  from documents
), totals as (
  select source, sum(size)::hugeint as s from sized group by source
), weighted as (
  select *, [5, 2, 1][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int] as w from totals
), ranked as (
  select *, s * 10 // w as ratio, row_number() over (order by s * 10 // w, source nulls last) as k from weighted
), levels as (
  -- the first k sources stopped at their limit, the rest sharing what is left
  select k - 1 as stopped, (select sum(s) from totals) - coalesce(sum(3 * s) over (order by k rows between unbounded preceding and 1 preceding), 0) as left_words,
    sum(w) over (order by k rows between current row and unbounded following) as open_weight, w, s
  from ranked
), level as (
  select * from levels where left_words * w <= 3 * s * open_weight order by stopped limit 1
), targets as (
  select r.source, r.s, case when r.k <= l.stopped then (3 * r.s)::double
    else l.left_words::double * r.w / l.open_weight::double end as target
  from ranked r, level l
), rated as (
  select d.doc_id, d.size, t.s::bigint as source_size, t.target, d.draw,
    case when t.s > 0 then t.target / t.s::double else 0.0 end as rate
  from sized d join targets t on d.source is not distinct from t.source
)
select doc_id, size, source_size, target,
  size * (floor(rate)::bigint + (draw < rate - floor(rate))::int) as taken,
  floor(rate)::bigint + (draw < rate - floor(rate))::int as copies
from rated
"""

ORACLE_SQL = {
    "op5_mixing": _MIX_SQL,
    "op6_embedding_dedup": _EMBEDDING_SQL,
    "op8_minhash_dedup": _NEAR_SQL,
    "op13_decontamination": _LEAK_SQL,
}
