"""Document corpus to searchable chunks, and receipts to typed fields."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.cleaning import extract_fields, join_elements
from strata.operators.documents import chunk_rows, doc_blocks, front_matter
from strata.operators.projections import filter_suffix
from strata.operators.vectors import similar, sync_embeddings
from strata.sources.files import read_binary, read_text_docs

# Fields of a receipt and their types.
RECEIPT_FIELDS: Mapping[str, str] = {
    "address": "string", "merchant_name": "string", "receipt_datetime": "string", "receipt_number": "string",
    "sub_total_after_discount": "decimal(10,2)", "tax": "decimal(10,2)", "total": "decimal(10,2)",
}
EMBEDDING_LAYOUT = "row_id long, content_hash string, embedding array<float>, embedding_error string"


def corpus_chunks(docs: DataFrame) -> DataFrame:
    """Markdown files (content, file_path, file_name) to one row per block with
    the metadata of its document, which travels along: no join, no shuffle."""
    matter = F.struct("file_name", front_matter("content").alias("m"))
    layout = docs.select(matter.alias("s")).schema["s"].dataType.simpleString()
    told = docs.withColumn("_matter", F.to_json(matter))
    blocks = chunk_rows(doc_blocks(told, "file_path", "content", "md", carry="_matter"), "file_path")
    return blocks.withColumn("_d", F.from_json("_matter", layout)).select(
        "row_id", "_d.m.title", "_d.m.date", "_d.m.categories", "_d.m.tags", "html_tag", "content", "file_path",
        "_d.file_name", "position"
    )


def load_corpus(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return corpus_chunks(read_text_docs(spark, paths))


def index_chunks(index: DataFrame | None, chunks: DataFrame) -> DataFrame:
    """Embedding index brought up to date with the chunks."""
    base = index if index is not None else chunks.sparkSession.createDataFrame([], EMBEDDING_LAYOUT)
    return sync_embeddings(base, chunks, id_col="row_id", text_col="content")


def search_chunks(index: DataFrame, chunks: DataFrame, query: Sequence[float], k: int, without_tag: str | None = None) -> DataFrame:
    """Best chunks for a query vector, optionally leaving out documents with a
    tag; the k hits are joined back to their text."""
    rows = index
    if without_tag is not None:
        allowed = chunks.filter(~F.array_contains("tags", without_tag)).select("row_id")
        rows = index.join(allowed, "row_id", "left_semi")
    hits = similar(rows, query, k, "row_id", "embedding")
    return F.broadcast(hits).join(chunks, "row_id").orderBy(F.desc("score"), "row_id")


def receipt_files(spark: SparkSession, path: str, extensions: Sequence[str] = (".png", ".jpg", ".jpeg")) -> DataFrame:
    """Image files of a folder with their name, size and content."""
    return filter_suffix(read_binary(spark, path), "src_file_name", extensions)


def parsed_receipts(parsed: DataFrame, parse_col: str = "parse_output") -> DataFrame:
    """Text of each parsed receipt; null where the parse reported an error."""
    return parsed.withColumns({
        "parse_error": F.try_variant_get(F.try_parse_json(F.col(parse_col)), "$.error_status", "string"),
        "parse_text": join_elements(parse_col),
    })


def receipt_fields(extracted: DataFrame, result_col: str = "extract_result") -> DataFrame:
    """Typed receipt columns out of an extraction result."""
    return extracted.withColumns(extract_fields(result_col, RECEIPT_FIELDS)).drop(result_col)
