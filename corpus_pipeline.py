"""From the documents table to packed training sequences, in five written stages.

Every stage reads what its predecessor kept, drops or cuts documents and, but
for the last, returns the columns of ``documents``. A stage's rows are written
as Parquet into the shared folder and read again by the next.

Cases: null texts have no letter and go in the first stage; empty tables pass
through all stages; a document whose text is all repeated passages stays with
an empty text; extra columns are carried.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import common, exact_dedup, language_id, minhash_dedup, packing, suffix_dedup
from strata.session import broadcast_if_small, materialise

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; learned from three quarters of the labelled ones."""
    common.small_batches(spark)
    model = language_id.fit(docs.where(~language_id.held_out("doc_id", 4)))
    verdict = common.own_name(docs, "language")
    return language_id.predict(docs, model, out=verdict).where(~F.col(verdict)["rejected"]).drop(verdict)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    common.small_batches(spark)
    kept = common.own_name(docs, "kept")
    return exact_dedup.exact_dedup(docs).where(kept).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicates the document with the smallest id."""
    verdict = minhash_dedup.near_duplicates(docs)
    gone = materialise(verdict.where("NOT kept").select(F.col("doc_id").alias("_gone_id"), F.col("text_hash").alias("_gone_hash")), "near-copies")
    same = docs["doc_id"].eqNullSafe(F.col("_gone_id")) & (F.xxhash64(common.text_bytes("text")) == F.col("_gone_hash"))
    return docs.join(broadcast_if_small(gone), same, "left_anti")


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 200 bytes that occur again; no character is cut in two."""
    carry = [c for c in docs.columns if c != "text"]
    cut = suffix_dedup.remove_repeats(docs, carry=carry, whole_characters=True)
    kept = common.own_name(docs.select(*carry), "kept")
    changed = cut.withColumn("text", F.col(kept).cast("string"))
    return changed.select(*[F.length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of tokenised documents with their place in a sequence."""
    return packing.best_fit_packing(docs, TOKENIZER)


STAGES = [
    ("language ID", keep_known_languages),
    ("exact dedup", drop_exact_copies),
    ("MinHash near-dedup", drop_near_copies),
    ("suffix-array dedup", cut_repeated_passages),
    ("best-fit packing", pack_sequences),
]

# No stage but exact dedup can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
