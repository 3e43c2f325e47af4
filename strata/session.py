"""Session set-up, run parameters, shared scratch space and size checks."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import storage

# A side is broadcast only when Catalyst's estimate of its plan is at most this
# many bytes. The estimate is of compressed, column-pruned files, so the hash
# table built from it may be several times larger; 8 MiB leaves room for that.
BROADCAST_BYTES = 8 * 1024 * 1024


def get_spark(app: str = "strata", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the library relies on (adaptive plans, UTC)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        # Rank filters keep their limit before the shuffle for any n.
        "spark.sql.optimizer.windowGroupLimitThreshold": str(2**31 - 1),
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@dataclass(frozen=True)
class RunConfig:
    """Parameters of one job run, passed into columns and table names."""

    run_id: str
    environment: str = "dev"
    reset: bool = False
    start_date: str | None = None
    end_date: str | None = None
    parameters: Mapping[str, str] = field(default_factory=dict)

    def table(self, layer: str, name: str, schema: str | None = None) -> str:
        """``[schema.]env_layer_name``: one naming rule for every layer."""
        plain = f"{self.environment}_{layer}_{name}"
        return f"{schema}.{plain}" if schema else plain

    def get(self, name: str, default: str | None = None) -> str:
        if name in self.parameters:
            return self.parameters[name]
        if default is None:
            raise KeyError(f"job parameter '{name}' is required")
        return default


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for written intermediates.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session
    without that setting gets a folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="strata-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{_own_scratch(spark)}/{label}-{uuid.uuid4().hex}"


def _own_scratch(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/strata/{spark.sparkContext.applicationId}"


def size_shuffles(spark: SparkSession, *inputs: DataFrame, target_bytes: int = 128 * 1024 * 1024) -> int:
    """Set the number of shuffle partitions for a job over these inputs.

    The default of 200 suits neither 100 TB nor a test. Inputs are compressed,
    so the count aims at ``target_bytes`` of compressed input per partition;
    adaptive execution then merges what turns out small. To be called where a
    job starts.
    """
    wanted = -(-sum(plan_bytes(df) for df in inputs) // target_bytes)
    parts = int(min(max(wanted, spark.sparkContext.defaultParallelism), 200_000))
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    return parts


def in_parallel(*steps: Callable[[], object]) -> list:
    """Run independent steps at the same time. The threads only submit Spark
    work and wait; a failed step raises here."""
    with ThreadPoolExecutor(max_workers=len(steps)) as pool:
        return [done.result() for done in [pool.submit(step) for step in steps]]


def clear_scratch(spark: SparkSession) -> bool:
    """Remove what this application wrote to the shared folder. Call it at the
    end of a job; frames read from there are gone afterwards."""
    return storage.remove(spark, _own_scratch(spark))


@contextmanager
def dropped_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within this, the shuffle files of a query go when it ends, not when the
    driver happens to collect garbage. For jobs whose steps are written tables:
    a frame that is run again makes its shuffles again."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def materialise(df: DataFrame, label: str = "stage", path: str | None = None, compression: str | None = None) -> DataFrame:
    """Cut lineage through a written table in the shared folder.

    Unlike a cached or locally checkpointed frame it survives executor loss,
    and every later read sees the same rows. Give a ``path`` of ``scratch_path``
    to remove the table before the application ends.
    """
    path = path or scratch_path(df.sparkSession, label)
    writer = df.write.mode("errorifexists")
    (writer.option("compression", compression) if compression else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimized plan, without running it."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    return plan_bytes(df) <= max_bytes


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint behind a size check; otherwise the frame unchanged, so
    the join shuffles and adaptive execution may still switch on real sizes."""
    return F.broadcast(df) if fits_broadcast(df, max_bytes) else df
