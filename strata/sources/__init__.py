"""Readers: files, landing folders, streams, schema evolution, rescued data."""

from strata.sources.evolution import evolve_schema, load_schema, read_rescued, seen_schema, store_schema, widened, with_rescued
from strata.sources.files import (
    copy_tables,
    jdbc_reader,
    landing_folder,
    parquet_reader,
    read_binary,
    read_csv,
    read_json,
    read_json_flat,
    read_landing_window,
    read_parquet,
    read_text_docs,
    read_text_lines,
    sql_on_file,
    table,
    tables,
)
from strata.sources.streams import stream_json, stream_parquet, stream_text

__all__ = [
    "copy_tables", "evolve_schema", "jdbc_reader", "landing_folder", "load_schema",
    "parquet_reader", "read_binary", "read_csv", "read_json", "read_json_flat",
    "read_landing_window", "read_parquet", "read_rescued", "read_text_docs",
    "read_text_lines", "seen_schema", "sql_on_file", "store_schema", "stream_json", "stream_parquet", "stream_text",
    "table", "tables", "widened", "with_rescued",
]
