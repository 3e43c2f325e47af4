"""Batch readers over files and tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata import storage


def tables(spark: SparkSession, folder: str, *names: str) -> tuple[DataFrame, ...]:
    """Several Parquet tables of one folder, in the order asked for."""
    return tuple(spark.read.parquet(f"{folder}/{name}.parquet") for name in names)


def table(spark: SparkSession, name: str) -> DataFrame:
    """Catalog table scan."""
    return spark.table(name)


def read_json(spark: SparkSession, path: str | list[str], schema: StructType | str | None = None) -> DataFrame:
    """JSON lines from a file, folder or glob. Without a schema Spark makes one
    extra pass to infer it, so give one for large inputs."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.json(path)


def read_json_flat(spark: SparkSession, path: str, mapping: Mapping[str, str]) -> DataFrame:
    """Multi-line JSON array flattened by ``{column: source path}``.

    A source name that contains a dot is written in back-ticks:
    ``"rain.`1h`"``.
    """
    raw = spark.read.option("multiLine", True).json(path)
    return raw.select(*[F.col(source).alias(name) for name, source in mapping.items()])


def read_csv(spark: SparkSession, path: str | list[str], schema: StructType | str | None = None) -> DataFrame:
    """CSV with a header; all columns are text unless a schema is given."""
    reader = spark.read.option("header", True)
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def read_parquet(spark: SparkSession, *paths: str, merge_schema: bool = False) -> DataFrame:
    return spark.read.option("mergeSchema", merge_schema).parquet(*paths)


def sql_on_file(spark: SparkSession, fmt: str, path: str) -> DataFrame:
    """Query a file by path, without a table."""
    return spark.sql(f"SELECT * FROM {fmt}.`{path}`")


def read_binary(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Whole files as rows with name, size and modification time."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).withColumn("src_file_name", F.element_at(F.split("path", "/"), -1))


def read_text_docs(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One row per text file, with its path and name."""
    return spark.read.text(paths, wholetext=True).select(
        F.col("value").alias("content"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_name").alias("file_name"),
    )


def read_text_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return spark.read.text(paths)


def landing_folder(root: str, at: datetime, minutes: int = 15, layout: str = "%Y/%m/%d/%H%M%S") -> str:
    """Folder a run triggered at ``at`` has to read: the slot before it."""
    return f"{root.rstrip('/')}/{(at - timedelta(minutes=minutes)).strftime(layout)}"


def read_landing_window(
    spark: SparkSession, root: str, at: datetime, minutes: int = 15, schema: StructType | str | None = None,
    layout: str = "%Y/%m/%d/%H%M%S",
) -> DataFrame:
    """JSON files of one time slot. A missing or empty folder is an error, so
    that a run never passes silently on no data."""
    folder = landing_folder(root, at, minutes, layout)
    if not [n for n in storage.list_names(spark, folder) if n.endswith(".json")]:
        raise FileNotFoundError(f"no landed files in {folder}")
    return read_json(spark, f"{folder}/*.json", schema)


def parquet_reader(spark: SparkSession, folder: str) -> Callable[[str], DataFrame]:
    return lambda name: spark.read.parquet(f"{folder}/{name}.parquet")


def jdbc_reader(
    spark: SparkSession,
    url: str,
    partitioning: Mapping[str, tuple[str, int, int, int]],
    properties: Mapping[str, str],
) -> Callable[[str], DataFrame]:
    """Reader of database tables, each split over executors by a numeric
    column: ``{table: (column, lowest, highest, partitions)}``."""

    def read(name: str) -> DataFrame:
        column, low, high, parts = partitioning[name]
        return spark.read.jdbc(
            url, name, column=column, lowerBound=low, upperBound=high,
            numPartitions=parts, properties=dict(properties),
        )

    return read


def copy_tables(read: Callable[[str], DataFrame], names: Sequence[str], out: str, parallel: int = 5) -> list[str]:
    """Copy tables one by one to Parquet folders, a few at a time. Each copy is
    a distributed job; the threads only submit them."""

    def copy(name: str) -> str:
        target = f"{out}/{name}.parquet"
        read(name).write.mode("overwrite").parquet(target)
        return target

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        return list(pool.map(copy, names))
