"""Column expressions shared by several operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ASCII white space (\x20 and \x09-\x0D) and the letters A-Z.
BLANKS = " \t\n\x0b\f\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z and nothing else. ``lower`` does that for plain ASCII and is much cheaper than ``translate``."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, UPPER.lower()))


def hex64(c: Column) -> Column:
    """16 lowercase hex digits of a long."""
    return F.lower(F.lpad(F.hex(c), 16, "0"))


def blank_words(c: Column) -> Column:
    """The runs of characters that are not ASCII white space; none for null."""
    parts = F.split(F.trim(F.coalesce(c, F.lit("")), F.lit(BLANKS)), r"[\x20\x09-\x0D]+")
    return F.array_remove(parts, "")


def rows_of(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few given rows as a table of literals."""
    names, kinds = zip(*(field.split(" ", 1) for field in schema.split(", ")))
    each = [F.struct(*[F.lit(x).cast(kind).alias(name) for x, name, kind in zip(row, names, kinds)]) for row in rows]
    whole = F.array(*each).cast(f"array<struct<{', '.join(f'{n}:{k}' for n, k in zip(names, kinds))}>>")
    return spark.range(1).select(F.inline(whole))


def like(df: DataFrame, schema_of: DataFrame) -> DataFrame:
    """The columns of ``schema_of``, in its order."""
    return df.select(*[F.col(f"`{c}`") for c in schema_of.columns])
