"""Readable forms of nested records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamfuse.functions.base58 import encoder


def _has_binary(kind: T.DataType) -> bool:
    if isinstance(kind, T.BinaryType):
        return True
    if isinstance(kind, T.ArrayType):
        return _has_binary(kind.elementType)
    if isinstance(kind, T.MapType):
        return _has_binary(kind.keyType) or _has_binary(kind.valueType)
    if isinstance(kind, T.StructType):
        return any(_has_binary(f.dataType) for f in kind)
    return False


def _render(column: Column, kind: T.DataType) -> Column:
    if not _has_binary(kind):
        return column
    if isinstance(kind, T.StructType):
        fields = [_render(column[f.name], f.dataType).alias(f.name) for f in kind]
        return F.when(column.isNotNull(), F.struct(*fields))
    return encoder(kind)(column)


def render_binary(df: DataFrame) -> DataFrame:
    """Replace every byte array, at any depth, by its base58 text.

    The schema decides at plan time which parts hold bytes; only those leave the JVM, the rest of
    a record is put together again by built-in expressions.
    """
    return df.select(*[_render(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema])


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """Add the first ``n`` lines of the record as indented JSON, and how many lines follow."""
    text = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"pretty": "true"})
    lines = F.split(text, "\n")
    return df.withColumn("_lines", lines).select(
        *df.columns,
        F.slice("_lines", 1, n).alias("preview"),
        F.greatest(F.size("_lines") - n, F.lit(0)).alias("more_lines"),
    )
