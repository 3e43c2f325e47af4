"""Run-to-completion streams: bronze ingest, silver, dimension and fact streams."""

from strata.streaming.evolving import UnknownField, ingest_evolving, read_evolving
from strata.streaming.jobs import bucket_15min, dim_stream, fact_stream, ingest_bronze, once, read_quarantine, read_route_counts, silver_stream
from strata.streaming.progress import batch_counts, log_progress, progress_of
from strata.streaming.windows import WindowedStream

__all__ = [
    "UnknownField", "WindowedStream", "batch_counts", "bucket_15min", "dim_stream", "fact_stream", "ingest_bronze", "ingest_evolving", "once",
    "log_progress", "progress_of", "read_evolving", "read_quarantine", "read_route_counts", "silver_stream",
]
