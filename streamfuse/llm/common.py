"""Small helpers that several operators share."""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamfuse.session import new_work_dir


def whole(column: str | Column) -> Column:
    """A text, with null as the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def ascii_lower(column: Column) -> Column:
    """A-Z to a-z and nothing else; ``lower`` alone would also change letters beyond ASCII."""
    plain = F.octet_length(column) == F.char_length(column)
    table = F.translate(column, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(plain, F.lower(column)).otherwise(table)


def neutral(docs: DataFrame, needed: Sequence[str]) -> DataFrame:
    """All columns as c0, c1, ... and the needed ones under their own names as well, so that no column of
    the table can clash with those an operator adds."""
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    return plain.withColumns({n: F.col(f"c{names.index(n)}") for n in needed})


def original(docs: DataFrame, **changed: Column) -> list[Column]:
    """The columns of ``docs`` from their neutral names, with some of them changed."""
    return [changed.get(n, F.col(f"c{i}")).alias(n) for i, n in enumerate(docs.columns)]


def written(df: DataFrame, label: str) -> DataFrame:
    """Compute a table once, into the shared folder, where it outlives lost executors."""
    path = new_work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def crc32_sql(text: str) -> str:
    """SQL for the unsigned CRC-32 of an ASCII text: bytes go in one by one, eight steps of the reflected polynomial each."""
    step = "lambda y, z: xor(y >> 1, 3988292384::UBIGINT * (y & 1))"
    byte = f"lambda c, b: list_reduce(list_prepend(xor(c, b), [0::UBIGINT FOR i IN range(8)]), {step})"
    codes = f"[ascii(x)::UBIGINT FOR x IN string_split({text}, '')]"
    return f"xor(list_reduce(list_prepend(4294967295::UBIGINT, {codes}), {byte}), 4294967295::UBIGINT)"
