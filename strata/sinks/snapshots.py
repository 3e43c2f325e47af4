"""Versioned Parquet tables for merges, without a table-format library.

Rows live in ``data/<attempt>/_bucket=B``, one folder per attempt to write. A
commit record names the folders that make up a version; it appears last and is
never overwritten, so readers see a whole version or none. Of two writers that
aim for one version the second fails and leaves only unused files behind. A
merge reads and rewrites only the folders that hold a key of its source; rows
with new keys are added beside the others. A stream's batch number is kept in
the record, which makes a replayed batch a no-op.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata import storage
from strata.functions.types import relaxed
from strata.operators.merge import CHANGE
from strata.session import fits_broadcast

HISTORY = (
    "version long, operation string, writer string, batch_id long, run_id string, inserted long, updated long, "
    "rows_written long, at_ms long"
)


class SnapshotTable:
    """One table under ``root``; ``keys`` choose the bucket of a row."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], schema: StructType | None = None, buckets: int = 16):
        self.spark, self.root, self.keys = spark, root.rstrip("/"), list(keys)
        latest = self._latest()
        if latest:
            self.schema = StructType.fromJson(latest["schema"])
            self.buckets = latest["buckets"]
        elif schema is not None:
            self.schema, self.buckets = relaxed(schema), buckets
        else:
            raise ValueError(f"{root} holds no table yet; give its schema")

    # -- commit records ---------------------------------------------------
    def _record_path(self, version: int) -> str:
        return f"{self.root}/_commits/{version:020d}.json"

    def _latest(self) -> dict | None:
        names = [n for n in storage.list_names(self.spark, f"{self.root}/_commits") if n.endswith(".json") and not n.startswith(".")]
        return json.loads(storage.read_text(self.spark, f"{self.root}/_commits/{names[-1]}")) if names else None

    def version(self) -> int:
        latest = self._latest()
        return latest["version"] if latest else 0

    def history(self) -> DataFrame:
        """One row per commit with its operation and row counts."""
        return self.spark.read.schema(HISTORY).json(f"{self.root}/_commits").orderBy("version")

    def done(self, writer: str, batch_id: int) -> bool:
        latest = self._latest()
        return bool(latest) and latest["writers"].get(writer, -1) >= batch_id

    # -- reading ----------------------------------------------------------
    def _folders(self, parts: Sequence[Sequence]) -> list[str]:
        return [f"{self.root}/data/{attempt}/_bucket={b}" for attempt, b in parts]

    def _record(self, version: int) -> dict:
        return json.loads(storage.read_text(self.spark, self._record_path(version)))

    def _changes(self, version: int) -> DataFrame:
        """Rows a commit inserted or updated, with their mark."""
        record = self._record(version)
        rows = self._load([(record["attempt"], b) for b in record["changed_buckets"]], CHANGE)
        return rows.filter(F.col(CHANGE).isNotNull()).withColumn("_commit_version", F.lit(version).cast("long"))

    def _load(self, parts: Sequence[Sequence], extra: str = "") -> DataFrame:
        schema = StructType(list(self.schema.fields))
        if extra:
            schema = schema.add(extra, "string")
        if not parts:  # known to be empty, so that joins with it fold away
            return self.spark.range(1).filter(F.lit(False)).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])
        return self.spark.read.schema(schema).parquet(*self._folders(parts))

    def read(self, version: int | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
        record = self._latest() if version is None else self._record(version)
        parts = record["parts"] if record else []
        if buckets is not None:
            wanted = set(buckets)
            parts = [p for p in parts if p[1] in wanted]
        return self._load(parts)

    def change_feed(self, after_version: int = 0) -> DataFrame:
        """Rows inserted or updated by the commits after a version."""
        frames = [self._changes(v) for v in range(after_version + 1, self.version() + 1)]
        if not frames:
            schema = StructType(list(self.schema.fields)).add(CHANGE, "string").add("_commit_version", "long")
            return self.spark.createDataFrame([], schema)
        return reduce(DataFrame.unionByName, frames)

    def publish_changes(self, folder: str) -> list[int]:
        """Copy the changes of committed versions to an append-only folder that
        streams can follow; versions already there are skipped. The column
        ``_commit_version`` orders several changes of one key."""
        added = []
        there = [int(n.split("=")[1]) for n in storage.list_names(self.spark, folder) if n.startswith("_commit=")]
        # The last folder may be unfinished; those before it were completed first.
        for v in range(max(there, default=1), self.version() + 1):
            target = f"{folder.rstrip('/')}/_commit={v}"
            if storage.exists(self.spark, f"{target}/_SUCCESS"):
                continue
            self._changes(v).drop(CHANGE).write.mode("overwrite").parquet(target)
            added.append(v)
        return added

    # -- writing ----------------------------------------------------------
    def _bucket(self):
        return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in self.keys]), F.lit(self.buckets)).cast("int")

    def _publish(
        self, rows: DataFrame, replaced: Sequence[Sequence] | None, operation: str, writer: str, batch_id: int, run_id: str,
    ) -> dict:
        """Write rows and commit them in place of the ``replaced`` (attempt, bucket) folders; None replaces all."""
        latest = self._latest()
        version = (latest["version"] if latest else 0) + 1
        attempt = f"{version:020d}-{uuid.uuid4().hex}"
        folder = f"{self.root}/data/{attempt}"
        # A rebalance keeps one bucket together but splits an oversized one.
        rows.withColumn("_bucket", self._bucket()).hint("rebalance", F.col("_bucket")) \
            .write.mode("errorifexists").partitionBy("_bucket").parquet(folder)
        written = {int(n.split("=")[1]) for n in storage.list_names(self.spark, folder) if n.startswith("_bucket=")}
        mine = [[attempt, b] for b in sorted(written)]
        counts = {None: 0, "insert": 0, "update": 0}
        changed: list[int] = []
        if mine:
            marks = self._load(mine, CHANGE).groupBy(CHANGE).agg(F.count(F.lit(1)).alias("n")).collect()
            counts |= {r[CHANGE]: r["n"] for r in marks}
            if operation != "compact":
                changed = sorted(written)
        gone = None if replaced is None else {tuple(p) for p in replaced}
        kept = [] if gone is None else [p for p in (latest["parts"] if latest else []) if tuple(p) not in gone]
        writers = dict(latest["writers"]) if latest else {}
        if writer:
            writers[writer] = batch_id
        record = {
            "version": version, "attempt": attempt, "operation": operation, "writer": writer, "batch_id": batch_id, "run_id": run_id,
            "inserted": counts["insert"], "updated": counts["update"], "rows_written": sum(counts.values()),
            "at_ms": int(time.time() * 1000), "buckets": self.buckets, "schema": self.schema.jsonValue(),
            "writers": writers, "changed_buckets": changed, "parts": kept + mine,
        }
        storage.publish_text(self.spark, self._record_path(version), json.dumps(record))
        return record

    def _parts(self, buckets: Sequence[int]) -> list[Sequence]:
        latest, wanted = self._latest(), set(buckets)
        return [p for p in latest["parts"] if p[1] in wanted] if latest else []

    def _holding(self, parts: Sequence[Sequence], source: DataFrame) -> list[Sequence]:
        """Those folders that hold a key of the source; reads their key columns only."""
        if not parts:
            return []
        rows = self._load(parts).select(
            *[F.col(k).alias(f"_t_{k}") for k in self.keys],
            F.regexp_extract(F.col("_metadata.file_path"), "/data/([^/]+/_bucket=[0-9]+)/[^/]*$", 1).alias("_part"))
        wanted = source.select(*[F.col(k).alias(f"_s_{k}") for k in self.keys])
        wanted = F.broadcast(wanted) if fits_broadcast(source) else wanted
        same = reduce(lambda a, b: a & b, [F.col(f"_t_{k}").eqNullSafe(F.col(f"_s_{k}")) for k in self.keys])
        found = {r[0] for r in rows.join(wanted, same, "left_semi").select("_part").distinct().collect()}
        return [p for p in parts if f"{p[0]}/_bucket={p[1]}" in found]

    def merge(
        self, source: DataFrame, plan: Callable[[DataFrame, DataFrame], DataFrame], *, operation: str = "merge",
        writer: str = "", batch_id: int = -1, run_id: str = "",
    ) -> dict | None:
        """Apply ``plan(target, source)`` to the folders that hold a key of the
        source and commit.

        ``plan`` is one of the plan-level merges with ``mark_changes=True``.
        None is returned when this batch is committed already.
        """
        if writer and self.done(writer, batch_id):
            return None
        held: list[Sequence] = []
        if self._parts(range(self.buckets)):
            # At most one number per bucket comes back to the driver.
            touched = sorted(r[0] for r in source.select(self._bucket().alias("b")).distinct().collect())
            held = self._holding(self._parts(touched), source)
        result = plan(self._load(held), source)
        if CHANGE not in result.columns:
            result = result.withColumn(CHANGE, F.lit(None).cast("string"))
        shaped = result.select(*[F.col(f.name).cast(f.dataType) for f in self.schema], CHANGE)
        return self._publish(shaped, held, operation, writer, batch_id, run_id)

    def append(self, rows: DataFrame, *, writer: str = "", batch_id: int = -1, run_id: str = "") -> dict | None:
        """Add rows without reading what is there."""
        if writer and self.done(writer, batch_id):
            return None
        shaped = rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema], F.lit("insert").alias(CHANGE))
        return self._publish(shaped, [], "append", writer, batch_id, run_id)

    def overwrite(self, rows: DataFrame, *, run_id: str = "") -> dict:
        shaped = rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema], F.lit("insert").alias(CHANGE))
        return self._publish(shaped, None, "overwrite", "", -1, run_id)

    def delete_where(self, condition: str, *, run_id: str = "") -> dict:
        """Rewrite the buckets that hold a matching row, without those rows."""
        hit = F.coalesce(F.expr(condition), F.lit(False))
        touched = sorted(r[0] for r in self.read().filter(hit).select(self._bucket().alias("b")).distinct().collect())
        rest = self.read(buckets=touched).filter(~hit).withColumn(CHANGE, F.lit(None).cast("string"))
        return self._publish(rest, self._parts(touched), "delete", "", -1, run_id)

    def add_columns(self, schema: StructType) -> None:
        """Columns only the given schema has; old files read them as null."""
        have = set(self.schema.fieldNames())
        self.schema = relaxed(StructType(self.schema.fields + [f for f in schema if f.name not in have]))

    # -- maintenance ------------------------------------------------------
    def compact(self, *, every_days: int | None = None, run_id: str = "") -> dict | None:
        """Rewrite all buckets into few files. With ``every_days`` nothing is
        done when a compaction lies within that time."""
        if every_days is not None:
            since = int(time.time() * 1000) - every_days * 86_400_000
            recent = self.history().filter((F.col("operation") == "compact") & (F.col("at_ms") >= since))
            if recent.limit(1).count():
                return None
        return self._publish(self.read().withColumn(CHANGE, F.lit(None).cast("string")), None, "compact", "", -1, run_id)

    def expire(self, days: float = 7) -> list[str]:
        """Remove data folders that the latest version does not use and that
        are older than the retention time, those of failed attempts included."""
        latest = self._latest()
        used = {p[0] for p in latest["parts"]} if latest else set()
        limit = int(time.time() * 1000) - int(days * 86_400_000)
        gone = []
        for name in storage.list_names(self.spark, f"{self.root}/data"):
            path = f"{self.root}/data/{name}"
            if name not in used and storage.modified_ms(self.spark, path) <= limit:
                storage.remove(self.spark, path)
                gone.append(name)
        return gone
