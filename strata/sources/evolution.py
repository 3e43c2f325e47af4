"""Schema evolution and rescued data for JSON landing files.

File streams keep one schema per start. ``evolve_schema`` infers files before a
start; ``seen_schema`` and ``widened`` do it for the rows of a micro-batch, which
``streaming.evolving`` uses to stop at an unknown field and go on with a wider
schema. Values that do not fit the schema stay with their row in a
``_rescued_data`` JSON text.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DecimalType, DoubleType, LongType, NullType, StringType, StructField, StructType, VariantType

from strata import storage


def load_schema(spark: SparkSession, schema_path: str) -> StructType | None:
    if not storage.exists(spark, schema_path):
        return None
    return StructType.fromJson(json.loads(storage.read_text(spark, schema_path)))


def evolve_schema(spark: SparkSession, new_files: str | list[str], schema_path: str) -> StructType:
    """Stored schema plus the columns only the new files have, stored again.

    A column whose type changed keeps the stored type; its odd values are for
    ``with_rescued`` to keep.
    """
    known = load_schema(spark, schema_path) or StructType()
    seen = spark.read.json(new_files).schema
    have = set(known.fieldNames())
    merged = StructType(known.fields + [f for f in seen.fields if f.name not in have])
    if merged != known:
        storage.write_text(spark, schema_path, merged.json(), overwrite=True)
    return merged


def store_schema(spark: SparkSession, schema_path: str, schema: StructType) -> None:
    storage.write_text(spark, schema_path, schema.json(), overwrite=True)


def _plain(kind: DataType) -> DataType | None:
    """Column type for an inferred one; None while only nulls were seen."""
    if isinstance(kind, NullType):
        return None
    if isinstance(kind, DecimalType):
        return LongType() if kind.scale == 0 and kind.precision <= 18 else DoubleType()
    if isinstance(kind, VariantType):  # values of several types
        return StringType()
    if isinstance(kind, ArrayType):
        element = _plain(kind.elementType)
        return element and ArrayType(element)
    if isinstance(kind, StructType):
        fields = [StructField(f.name, t) for f in kind if (t := _plain(f.dataType)) is not None]
        return StructType(fields) if fields else None
    return kind


def seen_schema(lines: DataFrame, text_col: str = "value") -> StructType:
    """Fields and types of JSON lines, nested ones too, by one mergeable aggregate."""
    found = lines.agg(F.schema_of_variant_agg(F.try_parse_json(text_col))).first()[0] or "VOID"
    parts = re.split(r"(`(?:[^`]|``)*`)", found)  # quoted names stay as they are
    ddl = "".join(p if i % 2 else p.replace("OBJECT<", "STRUCT<") for i, p in enumerate(parts))
    if not ddl.startswith("STRUCT<"):
        return StructType()
    return _plain(StructType.fromDDL(f"_all {ddl}")[0].dataType) or StructType()


def widened(known: DataType, seen: DataType) -> DataType:
    """``known`` with the fields that only ``seen`` has, at every depth. Known
    fields keep type and place; names that differ in case are one field."""
    if isinstance(known, ArrayType) and isinstance(seen, ArrayType):
        return ArrayType(widened(known.elementType, seen.elementType), known.containsNull)
    if not (isinstance(known, StructType) and isinstance(seen, StructType)):
        return known
    new = {f.name.lower(): f for f in reversed(seen.fields)}
    kept = [StructField(f.name, widened(f.dataType, new[f.name.lower()].dataType) if f.name.lower() in new else f.dataType, f.nullable, f.metadata) for f in known]
    have = {f.name.lower() for f in known}
    added = []
    for f in seen:
        if f.name.lower() not in have:
            have.add(f.name.lower())
            added.append(StructField(f.name, f.dataType))
    return StructType(kept + added)


def type_ddl(kind: DataType) -> str:
    """A type as SQL writes it, with quoted field names."""
    if isinstance(kind, StructType):
        return "struct<" + ", ".join(f"`{f.name.replace('`', '``')}`: {type_ddl(f.dataType)}" for f in kind) + ">"
    if isinstance(kind, ArrayType):
        return f"array<{type_ddl(kind.elementType)}>"
    return kind.simpleString()


def with_rescued(raw: DataFrame, schema: StructType, text_col: str = "value") -> DataFrame:
    """Typed columns from JSON lines, plus ``_rescued_data``.

    A field is rescued when its name is unknown or its value does not cast to
    the declared type; an unreadable line is rescued whole. The row is kept in
    every case. All of it is column expressions, one pass over the text; only a
    line with an unknown name or an unset field is taken apart into a map.
    """
    passed = [c for c in raw.columns if c != text_col]
    parsed = raw.select(*passed, F.col(text_col).alias("_line"), F.try_parse_json(text_col).alias("_v"))
    typed = parsed.select(
        *passed, "_line", "_v",
        *[F.try_variant_get("_v", f"$['{f.name}']", type_ddl(f.dataType)).alias(f.name) for f in schema],
    )
    known = F.array(*[F.lit(f.name) for f in schema]).cast("array<string>")
    unset = F.array_compact(F.array(*[F.when(F.col(f.name).isNull(), F.lit(f.name)) for f in schema])).cast("array<string>")
    # Names once a row, not once an entry of its map.
    named = typed.withColumns({"_extra": F.array_except(F.json_object_keys("_line"), known), "_unset": unset})
    odd = F.map_filter(
        F.from_json("_line", "map<string,string>"),
        lambda k, v: F.array_contains("_extra", k) | (F.array_contains("_unset", k) & v.isNotNull()),
    )
    # The map stands once in the branch, so that it is made once and for such lines alone.
    shown = F.get(F.transform(F.array(odd), lambda m: F.when(F.size(m) > 0, F.to_json(m))), F.lit(0))
    rescued = (
        F.when(F.col("_v").isNull(), F.to_json(F.create_map(F.lit("_unreadable"), F.col("_line"))))
        .when((F.size("_extra") > 0) | (F.size("_unset") > 0), shown)
    )
    return named.select(*passed, *[F.col(f.name) for f in schema], rescued.alias("_rescued_data"))


def read_rescued(spark: SparkSession, path: str | list[str], schema: StructType) -> DataFrame:
    lines = spark.read.text(path).select("value", F.col("_metadata").alias("_metadata_copy"))
    return with_rescued(lines, schema).withColumnRenamed("_metadata_copy", "_file")
