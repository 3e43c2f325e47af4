"""Streaming readers: file-change streams with a rate cap."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def _reader(spark: SparkSession, max_files: int | None):
    reader = spark.readStream
    return reader.option("maxFilesPerTrigger", max_files) if max_files else reader


def stream_json(spark: SparkSession, path: str, schema: StructType | str, max_files: int | None = 75) -> DataFrame:
    """New JSON-lines files as a stream, at most ``max_files`` per micro-batch."""
    return _reader(spark, max_files).schema(schema).json(path)


def stream_text(spark: SparkSession, path: str, max_files: int | None = 75) -> DataFrame:
    """New files as raw lines, for streams that need ``with_rescued``."""
    return _reader(spark, max_files).text(path)


def stream_parquet(spark: SparkSession, path: str, schema: StructType, max_files: int | None = 10, recursive: bool = False) -> DataFrame:
    """An append-only table folder as a stream; ``recursive`` for one folder per batch."""
    return _reader(spark, max_files).schema(schema).option("recursiveFileLookup", recursive).parquet(path)
