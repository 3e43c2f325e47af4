"""Ingest streams whose schema grows with the files that land.

A stream runs with the schema stored for it. Every micro-batch first looks at
the fields its lines have, nested ones too. At an unknown field the wider schema
is stored and the stream stops before anything of that batch is written; it is
then started again on the same checkpoint and takes the same batch with the
schema that fits. A batch owns one folder of the table, so a repeated batch
replaces its rows.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.functions.dates import second_precision
from strata.sources.evolution import load_schema, seen_schema, store_schema, widened, with_rescued
from strata.sources.streams import stream_text
from strata.streaming.progress import log_progress

MODES = ("add", "rescue", "fail")


class UnknownField(Exception):
    """A batch has fields that the stream's schema lacks."""


def ingest_evolving(
    spark: SparkSession, landing: str, out: str, checkpoint: str, schema_path: str, run_id: str, *,
    start: StructType | None = None, mode: str = "add", max_files: int | None = 75, name: str | None = None,
) -> int:
    """Landed JSON lines -> typed columns, rescued data, lineage -> one folder per
    batch. Returns how often the stream was started again with a wider schema.

    ``start`` is the schema before anything has landed. ``mode`` says what an
    unknown field does: ``add`` widens the schema, ``rescue`` keeps the field in
    ``_rescued_data`` (top level) and ``fail`` raises.
    """
    if mode not in MODES:
        raise ValueError(f"mode is one of {MODES}")
    restarts = 0
    while True:
        schema = load_schema(spark, schema_path)
        if schema is None:
            schema = start or StructType()
            store_schema(spark, schema_path, schema)
        grown: list[StructType] = []

        def process(batch: DataFrame, batch_id: int, schema: StructType = schema, grown: list = grown) -> None:
            batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
            try:
                if mode != "rescue":
                    wider = widened(schema, seen_schema(batch))
                    if wider != schema:
                        grown.append(wider)
                        raise UnknownField(f"batch {batch_id}: {sorted(set(wider.fieldNames()) - set(schema.fieldNames())) or 'nested fields'}")
                typed = with_rescued(batch, schema).withColumns({
                    "_pipeline_run_id": F.lit(run_id), "_processing_date": second_precision(F.current_timestamp()),
                })
                typed.write.mode("overwrite").parquet(f"{out}/_batch={batch_id}")
            finally:
                batch.unpersist()

        lines = stream_text(spark, landing, max_files).select(
            "value", F.col("_metadata.file_path").alias("_input_filename"),
            F.col("_metadata.file_modification_time").alias("_input_file_modification_date"),
        )
        writer = lines.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint).trigger(availableNow=True)
        log_progress(spark)
        query = (writer.queryName(name) if name else writer).start()
        try:
            query.awaitTermination()
            return restarts
        except StreamingQueryException as stopped:
            if not grown:
                raise
            if mode == "fail":
                raise UnknownField(f"{landing} has fields that {schema_path} lacks") from stopped
            store_schema(spark, schema_path, grown[0])
            restarts += 1


def read_evolving(spark: SparkSession, out: str, schema_path: str) -> DataFrame:
    """All rows under the widest schema; earlier rows have nulls in fields that came later."""
    schema = load_schema(spark, schema_path) or StructType()
    lineage = "_input_filename string, _input_file_modification_date timestamp, _rescued_data string, _pipeline_run_id string, _processing_date timestamp"
    return spark.read.schema(StructType([*schema.fields, *StructType.fromDDL(lineage).fields])).option("recursiveFileLookup", True).parquet(out)
