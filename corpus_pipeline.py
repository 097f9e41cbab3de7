"""From raw documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor kept; all but
the last return the columns of their input. Stages are written as Parquet in between.

Defined cases, besides those of the operators. Columns other than doc_id, text, lang, source and
n_chars pass through; an n_chars that is missing is not made. Every stage accepts an empty table, NULLs
in any column, repeated rows and texts of any length.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from ludolens.llm import language, minhash, mixing, packing, secrets
from ludolens.llm.tables import table, whole_row
from ludolens.scratch import broadcast_small, write_scratch

VOCABULARY = "word_bpe_49k.json"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter, each with the language that parses it in fewest phrases as its ``lang``.

    What ``lang`` said before only teaches: a wrong or missing label is replaced like any other.
    A document is rejected only if it has no letter, or if no document is labelled.
    """
    model = language.learn(language.sample_labelled(docs))
    # Rejection is decided without the parse, so that each text is parsed once.
    readable = docs.where(language.has_letter(F.col("text")) & F.lit(bool(model.languages)))
    found = language.predictor(spark, model)(F.col("text"))
    parsed = readable.select(whole_row(docs), found.alias("found"))
    return parsed.select(*[F.col("found.lang").alias(c) if c == "lang" else F.col(f"row.`{c}`") for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: the one with the smallest doc_id.

    Repeated rows of it are one. A NULL doc_id names no class, so of such rows only exact copies of each other go.
    """
    own_class = (F.col("doc_id") == F.col("class_id")) | F.col("doc_id").isNull()
    kept = minhash.near_duplicates(docs).where(own_class).select(F.col("doc_id").alias("_id")).distinct()
    row_id, digest = F.col("row.doc_id"), F.md5(F.col("row.text").cast("binary"))
    rows = docs.select(whole_row(docs))
    copies = (
        rows.groupBy(row_id.alias("_copy_id"), digest.alias("_copy_digest")).count().where("count > 1")
    )
    stays = rows.join(broadcast_small(write_scratch(kept)), row_id.eqNullSafe(F.col("_id")), "left_semi")
    same = row_id.eqNullSafe(F.col("_copy_id")) & digest.eqNullSafe(F.col("_copy_digest"))
    marked = stays.join(broadcast_small(write_scratch(copies)), same, "left")
    single = marked.where("count is null").select("row.*")
    one = (
        marked.where("count is not null")
        .groupBy("_copy_id", "_copy_digest")
        .agg(F.min_by("row", F.xxhash64("row")).alias("row"))
        .select("row.*")
    )
    return single.union(one)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with what the forest takes for a secret replaced by a mark."""
    return secrets.redact(docs, write_scratch(secrets.scan(docs)))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the target weights of the sources ask for."""
    return mixing.emit_copies(mixing.mix(docs))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document with their place in sequences of 2048 tokens."""
    pieces = packing.tokenize(docs, public_tokenizers.path(VOCABULARY))
    packed = packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))
    return packed.withColumnRenamed("key", "doc_id")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("source_mix", source_mix),
    ("best_fit_packing", best_fit_packing),
]

# Parsing by automata, dart hashing, forests and tokens are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of all documents that pass the stages."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = write_scratch(docs)
    return docs
