"""Small-file access through the Hadoop file system of the session, so that
schemas and commit records live on the same shared storage as the data."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def list_names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p))


def write_text(spark: SparkSession, path: str, text: str, overwrite: bool = False) -> None:
    """Write a small file; without ``overwrite`` an existing file is an error."""
    fs, p = _fs(spark, path)
    out = fs.create(p, overwrite)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """Make a small file appear whole and only once: written aside, then
    renamed without overwriting. Fails when the name is taken."""
    jvm = spark._jvm
    folder, name = path.rsplit("/", 1)
    aside = f"{folder}/.{name}.{uuid.uuid4().hex}"
    write_text(spark, aside, text)
    target = jvm.org.apache.hadoop.fs.Path(path)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        target.toUri(), spark._jsc.hadoopConfiguration()
    ) if target.toUri().getScheme() else jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        spark._jsc.hadoopConfiguration()
    )
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.valueOf("NONE")
    try:
        context.rename(jvm.org.apache.hadoop.fs.Path(aside), target, options)
    except Exception:
        remove(spark, aside)
        raise


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.delete(p, True)


def modified_ms(spark: SparkSession, path: str) -> int:
    fs, p = _fs(spark, path)
    return fs.getFileStatus(p).getModificationTime()
