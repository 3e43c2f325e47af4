"""Streams of the medallion layers. Each processes what has arrived and stops.

A micro-batch handed to ``foreachBatch`` is read from its files once for the
bad rows and once for the good ones, which costs less than keeping all of its
columns in memory. What a merge reads several times is persisted. Batch numbers
make every write repeatable: merges skip a committed batch, quarantine folders
are overwritten per batch.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from strata import storage
from strata.functions.dates import second_precision
from strata.operators.quality import Rule, observed_routes, route, to_quarantine
from strata.operators.windows import latest_per_key
from strata.sinks.snapshots import SnapshotTable
from strata.sources.evolution import with_rescued
from strata.sources.streams import stream_parquet, stream_text
from strata.streaming.progress import log_progress

Plan = Callable[[DataFrame, DataFrame], DataFrame]


def ingest_bronze(
    spark: SparkSession, landing: str, out: str, checkpoint: str, schema: StructType, run_id: str,
    *, max_files: int | None = 75, name: str | None = None,
) -> StreamingQuery:
    """Landed JSON lines -> typed columns, rescued data, lineage -> append."""
    lines = stream_text(spark, landing, max_files).select(
        "value",
        F.col("_metadata.file_path").alias("_input_filename"),
        F.col("_metadata.file_modification_time").alias("_input_file_modification_date"),
    )
    typed = with_rescued(lines, schema).withColumns({
        "_pipeline_run_id": F.lit(run_id),
        "_processing_date": second_precision(F.current_timestamp()),
    })
    writer = (typed.writeStream.format("parquet").outputMode("append")
              .option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True))
    log_progress(spark)
    return (writer.queryName(name) if name else writer).start()


def ingest_csv(
    spark: SparkSession, landing: str, out: str, checkpoint: str, columns: Sequence[str], run_id: str,
    *, max_files: int | None = 75, name: str | None = None,
) -> StreamingQuery:
    """Landed CSV with a header -> all columns as text, lineage -> append. A
    file whose header is another one stops the stream: its values would end up
    in the wrong columns."""
    reader = spark.readStream.schema(", ".join(f"`{c}` string" for c in columns)).option("header", True).option("enforceSchema", False)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.csv(landing).select(
        *[F.col(f"`{c}`") for c in columns],
        F.col("_metadata.file_path").alias("_input_filename"),
        F.col("_metadata.file_modification_time").alias("_input_file_modification_date"),
        F.lit(run_id).alias("_pipeline_run_id"),
        second_precision(F.current_timestamp()).alias("_processing_date"),
    )
    writer = (rows.writeStream.format("parquet").outputMode("append")
              .option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True))
    log_progress(spark)
    return (writer.queryName(name) if name else writer).start()


def once(table: SnapshotTable, writer: str, batch_id: int, fn: Callable[[], object]) -> bool:
    """Run ``fn`` unless this batch is committed already."""
    if table.done(writer, batch_id):
        return False
    fn()
    return True


def _write_quarantine(rows: DataFrame, folder: str, stream: str, batch_id: int) -> None:
    rows.write.mode("overwrite").parquet(f"{folder}/_stream={stream}/_batch={batch_id}")


def write_route_counts(spark: SparkSession, folder: str, stream: str, batch_id: int, counted: Observation) -> None:
    line = {"stream": stream, "batch": batch_id, **counted.get}
    storage.write_text(spark, f"{folder}_counts/{stream}/{batch_id}.json", json.dumps(line), overwrite=True)


def read_route_counts(spark: SparkSession, folder: str, stream: str) -> DataFrame:
    """Rows per batch of a stream: passed, schema_failed and rule_failed, those before restarts too."""
    layout = "stream string, batch long, passed long, schema_failed long, rule_failed long"
    return spark.read.schema(layout).json(f"{folder}_counts/{stream}")


def read_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """All quarantined rows of all streams, in the shared layout."""
    return spark.read.parquet(folder).drop("_stream", "_batch")


def _start(stream: DataFrame, process, checkpoint: str, name: str) -> StreamingQuery:
    log_progress(stream.sparkSession)
    return (stream.writeStream.foreachBatch(process).outputMode("append")
            .option("checkpointLocation", checkpoint).queryName(name).trigger(availableNow=True).start())


def silver_stream(
    spark: SparkSession, bronze: str, bronze_schema: StructType, table: SnapshotTable, *,
    transform: Callable[[DataFrame], DataFrame], rules: Sequence[Rule], keys: Sequence[str], order: Sequence[Column],
    plan: Plan, quarantine: str, checkpoint: str, run_id: str, dataset: str, name: str,
    max_files: int | None = 10, dedup: str = "after", recursive: bool = False,
) -> StreamingQuery:
    """Bronze rows -> flags -> latest good row per key -> merge; bad rows to
    the quarantine folder."""

    def process(batch: DataFrame, batch_id: int) -> None:
        rows = transform(batch)
        routed = route(rows, rules, keys, order, dedup)
        # The pass that writes the bad rows sees all rows and counts them on its way.
        counted = Observation()
        failed = observed_routes(rows if dedup == "after" else latest_per_key(rows, keys, order), rules, counted)
        bad = to_quarantine(failed, rules, dataset=dataset, table_name=name, layer="silver", keys=keys, run_id=run_id)
        _write_quarantine(bad, quarantine, name, batch_id)
        write_route_counts(rows.sparkSession, quarantine, name, batch_id, counted)
        # The merge reads its source several times; it is ranked once.
        passed = routed.passed.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            table.merge(passed, plan, writer=name, batch_id=batch_id, run_id=run_id)
        finally:
            passed.unpersist()

    return _start(stream_parquet(spark, bronze, bronze_schema, max_files, recursive), process, checkpoint, name)


def dim_stream(
    spark: SparkSession, changes: str, schema: StructType, table: SnapshotTable, *,
    transform: Callable[[DataFrame], DataFrame], plan: Plan, checkpoint: str, run_id: str, name: str,
) -> StreamingQuery:
    """Changed members -> dimension merge. ``transform`` leaves one row per member."""

    def process(batch: DataFrame, batch_id: int) -> None:
        rows = transform(batch).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            table.merge(rows, plan, writer=name, batch_id=batch_id, run_id=run_id)
        finally:
            rows.unpersist()

    return _start(_follow(spark, changes, schema), process, checkpoint, name)


def fact_stream(
    spark: SparkSession, changes: str, schema: StructType, table: SnapshotTable, *,
    build: Callable[[DataFrame], tuple[DataFrame, DataFrame | None]], plan: Plan | None, checkpoint: str, run_id: str,
    name: str, quarantine: str | None = None,
) -> StreamingQuery:
    """Changed silver rows -> star lookups -> fact. ``build`` returns the fact
    rows and, if it rejects any, rows in quarantine layout. Without ``plan``
    the fact is append-only."""

    def process(batch: DataFrame, batch_id: int) -> None:
        rows, bad = build(batch)
        if bad is not None and quarantine:
            _write_quarantine(bad, quarantine, name, batch_id)
        if plan is None:
            table.append(rows, writer=name, batch_id=batch_id, run_id=run_id)
            return
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            table.merge(rows, plan, writer=name, batch_id=batch_id, run_id=run_id)
        finally:
            rows.unpersist()

    return _start(_follow(spark, changes, schema), process, checkpoint, name)


def _follow(spark: SparkSession, changes: str, schema: StructType) -> DataFrame:
    """The published change folders of a snapshot table as a stream; rows
    carry ``_commit_version``."""
    schema = StructType(list(schema.fields)).add("_commit_version", "long")
    return spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(changes)


def bucket_15min(df: DataFrame, ts: str, **aggregates: Column) -> DataFrame:
    """Tumbling 15-minute buckets on event time. On a stream add a watermark
    first, so that finished buckets can be dropped from the state."""
    return df.groupBy(F.window(F.col(ts), "15 minutes").alias("_w")).agg(
        F.count(F.lit(1)).alias("rows"), *[a.alias(n) for n, a in aggregates.items()]
    ).select(F.col("_w.start").alias("bucket_start"), F.col("_w.end").alias("bucket_end"), "rows", *aggregates)


def reset_stream(spark: SparkSession, table: SnapshotTable, checkpoint: str, quarantine: str | None = None, name: str | None = None) -> None:
    """Demo reset: forget a table, the progress of the stream that fills it and,
    given the quarantine folder and the stream's name, the rows it rejected."""
    storage.remove(spark, table.root)
    storage.remove(spark, checkpoint)
    if quarantine and name:
        storage.remove(spark, f"{quarantine}_counts/{name}")
        storage.remove(spark, f"{quarantine}/_stream={name}")
