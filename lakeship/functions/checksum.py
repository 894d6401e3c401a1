"""Checksums of whole tables; order of rows and columns does not matter, duplicates count.

A table's checksum is a sum over its rows, so checksums of parts add up to that of the whole, and a part that is removed is
subtracted. The row text behind it is plain enough for other engines to repeat.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BinaryType, MapType, StructField, StructType, TimestampType, VariantType,
)


def hashable(df: DataFrame) -> list[Column]:
    """Columns in a form that `hash` takes; maps become sorted entries."""
    return [
        F.array_sort(F.map_entries(F.col(f"`{f.name}`"))) if isinstance(f.dataType, MapType) else F.col(f"`{f.name}`")
        for f in df.schema
    ]


def _text(field: StructField) -> Column:
    """A value as text that tells different values of its type apart."""
    value, kind = F.col(f"`{field.name}`"), field.dataType
    if isinstance(kind, TimestampType):
        return F.unix_micros(value).cast("string")
    if isinstance(kind, BinaryType):
        return F.hex(value)
    if isinstance(kind, MapType):
        return F.to_json(F.array_sort(F.map_entries(value)))
    if isinstance(kind, (StructType, ArrayType)):
        return F.to_json(value, {"ignoreNullFields": "false"})
    if isinstance(kind, VariantType):
        return F.to_json(value)
    return value.cast("string")


def row_text(schema: StructType) -> Column:
    """A row as `name=length:text` of its values in the order of their names; nulls are left out.

    So a column that a table gets later, null in the rows it has, changes nothing, and no two rows share a text.
    """
    parts = []
    for field in sorted(schema, key=lambda f: f.name):
        text = _text(field)
        parts.append(F.concat(F.lit(f"{field.name}="), F.length(text).cast("string"), F.lit(":"), text))
    return F.concat_ws(",", *parts)


def row_number_of(schema: StructType) -> Column:
    """60 bits of the MD5 of a row's text."""
    return F.conv(F.substring(F.md5(row_text(schema)), 1, 15), 16, 10).cast("decimal(20,0)")


def checksum_of(rows: Column) -> Column:
    """The sum of rows' numbers; as decimal(38,0) it has room for 10^19 rows."""
    return F.coalesce(F.sum(rows), F.lit(0)).cast("decimal(38,0)")


def table_checksum(df: DataFrame) -> DataFrame:
    """One row: n_rows, hash_sum (`sum(hash(*))`), and checksum, which also sees where NULLs are.

    `hash` skips NULLs, so for it a value that moves to another column of a row with NULLs would not show.
    """
    return df.agg(
        F.count("*").alias("n_rows"),
        F.coalesce(F.sum(F.hash(*hashable(df)).cast("bigint")), F.lit(0)).alias("hash_sum"),
        checksum_of(row_number_of(df.schema)).alias("checksum"),
    )
