"""Table and file writers."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata import storage


def write_table(df: DataFrame, name: str, mode: str = "overwrite", location: str | None = None) -> None:
    """Overwrite or append a catalog table, external when a location is given.
    Appends go by column name, so the column order of the frame does not matter."""
    spark = df.sparkSession
    if mode == "append" and spark.catalog.tableExists(name):
        target = spark.table(name)
        unknown = [c for c in df.columns if c not in target.columns]
        if unknown:
            raise ValueError(f"{name} has no column {unknown}; use append_files for a growing layout")
        filled = [
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.schema
        ]
        df.select(*filled).write.insertInto(name)
    else:
        writer = df.write.format("parquet").mode(mode)
        (writer.option("path", location) if location else writer).saveAsTable(name)


def append_files(df: DataFrame, path: str) -> None:
    """Append to a folder whose columns may grow; see ``read_appended``."""
    df.write.mode("append").parquet(path)


def read_appended(spark: SparkSession, path: str) -> DataFrame:
    """All appended rows under the union of their columns."""
    return spark.read.option("mergeSchema", True).parquet(path)


def create_or(df: DataFrame, name: str, action: Callable[[DataFrame, str], None], location: str | None = None) -> str:
    """Create the table from the frame when missing, else run ``action``."""
    if df.sparkSession.catalog.tableExists(name):
        action(df, name)
        return "applied"
    write_table(df, name, "overwrite", location)
    return "created"


def write_by(df: DataFrame, cols: str | Sequence[str], path: str, files: int | None = None) -> None:
    """One folder per value of ``cols``, snappy Parquet.

    Without ``files`` a rebalance keeps the file count low and still splits a
    value that holds most of the rows over several files; ``files=1`` writes
    single-file folders and is meant for small exports.
    """
    names = [cols] if isinstance(cols, str) else list(cols)
    placed = df.coalesce(files) if files else df.hint("rebalance", *[F.col(c) for c in names])
    placed.write.mode("overwrite").option("compression", "snappy").partitionBy(*names).parquet(path)


def replace_slice(df: DataFrame, path: str, slice_cols: str | Sequence[str], slices: Sequence[Sequence] = ()) -> None:
    """Idempotent reload: the slices present in the frame are replaced. Slices
    named in ``slices`` lose the rows they have now, so a reload without rows
    empties them. They are found by comparing values of the column's type with
    the folders there are, and emptied only after the new rows are written, so a
    failed write loses nothing."""
    spark = df.sparkSession
    names = [slice_cols] if isinstance(slice_cols, str) else list(slice_cols)
    old = [f for folder in _slice_folders(df, path, names, slices) for f in storage.list_names(spark, folder) for f in [f"{folder}/{f}"]]
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*names).parquet(path))
    for file in old:  # of a slice that came again they are gone already
        storage.remove(spark, file)


def _slice_folders(df: DataFrame, path: str, names: Sequence[str], slices: Sequence[Sequence]) -> list[str]:
    """Folders of the named slices, whatever way their values are written."""
    if not slices:
        return []
    spark = df.sparkSession
    unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    folders: list[tuple[str, tuple]] = [(path, ())]
    for name in names:
        folders = [
            (f"{folder}/{entry}", (*values, None if (value := unescape(entry.split("=", 1)[1])) == "__HIVE_DEFAULT_PARTITION__" else value))
            for folder, values in folders for entry in storage.list_names(spark, folder) if unescape(entry.split("=", 1)[0]) == name
        ]
    if not folders:
        return []
    wanted = [tuple(None if v is None else str(v) for v in values) for values in slices]
    if any(len(values) != len(names) for values in wanted):
        raise ValueError(f"a slice needs a value for each of {names}")
    kinds = [df.schema[n].dataType for n in names]
    cols = [f"c{i}" for i in range(len(names))]
    text = ", ".join(f"{c} string" for c in cols)
    typed = [F.col(c).try_cast(kind).alias(c) for c, kind in zip(cols, kinds)]
    there = spark.createDataFrame([(folder, *values) for folder, values in folders], f"folder string, {text}").select("folder", *typed)
    asked = spark.createDataFrame(wanted, text).select(*[t.alias(f"a{i}") for i, t in enumerate(typed)])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"a{i}")) for i, c in enumerate(cols)])
    return sorted(r["folder"] for r in there.join(asked, same, "left_semi").collect())


def write_stream(df: DataFrame, path: str, checkpoint: str, name: str | None = None) -> StreamingQuery:
    """Append stream into a folder: process what is there, then stop."""
    from strata.streaming.progress import log_progress

    log_progress(df.sparkSession)
    writer = (df.writeStream.format("parquet").outputMode("append")
              .option("path", path).option("checkpointLocation", checkpoint)
              .trigger(availableNow=True))
    return (writer.queryName(name) if name else writer).start()


def reset_table(spark: SparkSession, name: str, checkpoint: str | None = None) -> None:
    """Drop a table and forget the progress of the stream that fills it."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    if checkpoint:
        storage.remove(spark, checkpoint)


def pack_batches(
    df: DataFrame, id_col: str, send: Callable[[pd.DataFrame], str] | None = None, size: int = 250
) -> DataFrame:
    """Hand documents over in batches of ``size``, one status row per batch.

    Each partition is cut on its own and each document is sent once. ``send``
    gets one batch and returns its status; the default only reports success.
    """
    deliver = send or (lambda batch: "Success")

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def status(batch: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({
                "start_id": [str(batch[id_col].iloc[0])], "end_id": [str(batch[id_col].iloc[-1])],
                "documents": [len(batch)], "upload_status": [deliver(batch)],
            })

        held = None
        for frame in frames:
            held = frame if held is None else pd.concat([held, frame], ignore_index=True)
            while len(held) >= size:
                yield status(held.iloc[:size])
                held = held.iloc[size:]
        if held is not None and len(held):
            yield status(held)

    return df.mapInPandas(work, "start_id string, end_id string, documents long, upload_status string")
