"""Writers: tables, slices, streams, versioned snapshot tables, metadata."""

from strata.sinks.catalog import annotate, create_table, create_view, ctas, describe_metadata, set_tags, tagged_tables
from strata.sinks.snapshots import SnapshotTable
from strata.sinks.tables import (
    append_files,
    create_or,
    pack_batches,
    read_appended,
    replace_slice,
    reset_table,
    write_by,
    write_stream,
    write_table,
)

__all__ = [
    "SnapshotTable", "annotate", "append_files", "create_or", "create_table", "create_view",
    "ctas", "describe_metadata", "pack_batches", "read_appended", "replace_slice",
    "reset_table", "set_tags", "tagged_tables", "write_by", "write_stream", "write_table",
]
