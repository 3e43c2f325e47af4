"""Type helpers."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, DataType, MapType, StructField, StructType


def relaxed(dtype: DataType) -> DataType:
    """The same type with every part nullable, as files hold it. Casts between
    types that differ only in null flags are refused, so merges cast to this."""
    if isinstance(dtype, ArrayType):
        return ArrayType(relaxed(dtype.elementType), True)
    if isinstance(dtype, MapType):
        return MapType(relaxed(dtype.keyType), relaxed(dtype.valueType), True)
    if isinstance(dtype, StructType):
        return StructType([StructField(f.name, relaxed(f.dataType), True, f.metadata) for f in dtype])
    return dtype
