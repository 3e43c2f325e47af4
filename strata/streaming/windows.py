"""Event-time windows over landed files, with late rows kept.

Two streams. The first compares every row with the watermark its micro-batch
starts with (the highest event time of all batches before, less the delay) and
writes it to the rows on time or to the late ones. The highest event time is
stored per batch, so a repeated batch sorts its rows the same way again. The
second stream counts windows over the rows on time in Spark's state store and
appends each window once the watermark has passed its end. Its watermark is
never ahead of the first one's, so it drops nothing: every landed row is in a
window or in the table of late rows.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata import storage
from strata.sources.streams import stream_json, stream_parquet
from strata.streaming.jobs import bucket_15min
from strata.streaming.progress import log_progress


class WindowedStream:
    """Folders of one windowed stream: ``on_time``, ``late``, ``windows``, ``marks`` and checkpoints below ``root``."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType, ts: str, delay: str = "30 minutes", name: str = "windows"):
        self.spark, self.root, self.schema, self.ts, self.delay, self.name = spark, root, schema, ts, delay, name

    def path(self, part: str) -> str:
        return f"{self.root}/{part}"

    def _mark(self, batch_id: int) -> str | None:
        """Highest event time of the batches before this one."""
        known = [int(n) for n in storage.list_names(self.spark, self.path("marks")) if n.isdigit() and int(n) < batch_id]
        return storage.read_text(self.spark, f"{self.path('marks')}/{max(known)}") if known else None

    def _split(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            mark = self._mark(batch_id)
            when = F.col(self.ts)
            late = when.isNull() if mark is None else F.coalesce(when < F.lit(mark).cast("timestamp") - F.expr(f"INTERVAL {self.delay}"), F.lit(True))
            batch.filter(~late).write.mode("overwrite").parquet(f"{self.path('on_time')}/_batch={batch_id}")
            batch.filter(late).write.mode("overwrite").parquet(f"{self.path('late')}/_batch={batch_id}")
            highest = batch.agg(F.greatest(F.max(when), F.lit(mark).cast("timestamp")).cast("string")).first()[0]
            if highest is not None:
                storage.write_text(self.spark, f"{self.path('marks')}/{batch_id}", highest, overwrite=True)
        finally:
            batch.unpersist()

    def run(self, landing: str, *, max_files: int | None = None, **aggregates: Column) -> None:
        """Take what has landed and append the windows that are now complete."""
        log_progress(self.spark)
        rows = stream_json(self.spark, landing, self.schema, max_files)
        (rows.writeStream.foreachBatch(self._split).option("checkpointLocation", self.path("checkpoint_split"))
            .queryName(f"{self.name}_split").trigger(availableNow=True).start().awaitTermination())
        if not storage.exists(self.spark, self.path("on_time")):
            return
        # No file cap: all rows on time of a run reach the state together, in any order.
        timely = stream_parquet(self.spark, self.path("on_time"), self.schema, None, recursive=True).withWatermark(self.ts, self.delay)
        (bucket_15min(timely, self.ts, **aggregates).writeStream.format("parquet").outputMode("append").option("path", self.path("windows"))
            .option("checkpointLocation", self.path("checkpoint_windows")).queryName(self.name).trigger(availableNow=True).start().awaitTermination())

    def windows(self) -> DataFrame:
        return self.spark.read.parquet(self.path("windows"))

    def late(self) -> DataFrame:
        return self.spark.read.schema(self.schema).option("recursiveFileLookup", True).parquet(self.path("late"))
