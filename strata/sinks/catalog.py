"""Catalog objects: CTAS, views, typed empty tables, searchable metadata."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TAG_PREFIX = "tag."


def ctas(spark: SparkSession, name: str, sql: str, location: str | None = None, **frames: DataFrame) -> DataFrame:
    """Table from a query; frames named in braces stand for tables."""
    where = f"LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE {name} USING parquet {where} AS {sql}", **frames)
    return spark.table(name)


def create_view(spark: SparkSession, name: str, sql: str) -> DataFrame:
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {sql}")
    return spark.table(name)


def create_table(spark: SparkSession, name: str, columns: str, location: str | None = None) -> DataFrame:
    """Typed empty table from a DDL column list."""
    where = f"LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {where}")
    return spark.table(name)


def _text(value: str) -> str:
    return value.replace("\\", "\\\\").replace("'", "\\'")


def annotate(
    spark: SparkSession,
    name: str,
    comment: str | None = None,
    columns: Mapping[str, str] | None = None,
    tags: Mapping[str, str] | None = None,
) -> None:
    """Table comment, column comments and tags (kept as table properties)."""
    if comment is not None:
        spark.sql(f"COMMENT ON TABLE {name} IS '{_text(comment)}'")
    for column, text in (columns or {}).items():
        spark.sql(f"ALTER TABLE {name} ALTER COLUMN `{column}` COMMENT '{_text(text)}'")
    if tags:
        set_tags(spark, name, tags)


def set_tags(spark: SparkSession, name: str, tags: Mapping[str, str]) -> None:
    listed = ", ".join(f"'{TAG_PREFIX}{_text(k)}' = '{_text(v)}'" for k, v in tags.items())
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({listed})")


def describe_metadata(spark: SparkSession, name: str) -> DataFrame:
    """Column names, types and comments as rows."""
    described = spark.sql(f"DESCRIBE TABLE {name}")
    return described.filter(~F.col("col_name").startswith("#") & (F.col("col_name") != ""))


def tagged_tables(spark: SparkSession, database: str = "default") -> DataFrame:
    """One row per tag of every table in a database (catalog metadata only)."""
    rows = []
    for t in spark.catalog.listTables(database):
        if t.isTemporary:
            continue
        props = spark.sql(f"SHOW TBLPROPERTIES {database}.{t.name}").collect()
        rows += [
            (t.catalog, database, t.name, p["key"][len(TAG_PREFIX):], p["value"])
            for p in props if p["key"].startswith(TAG_PREFIX)
        ]
    schema = "catalog_name string, schema_name string, table_name string, tag_name string, tag_value string"
    return spark.createDataFrame(rows, schema)
