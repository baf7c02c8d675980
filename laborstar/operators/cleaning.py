"""Row filters and defaults.

Every function is DataFrame -> DataFrame (or returns a Column predicate) and
is map-only: no shuffle, and predicates on raw columns reach the scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from laborstar.functions import coerce_numeric, last_two

# Cell texts that a delimited-file read treats as missing
# (the default missing-value list of the pandas CSV reader). Matched
# exactly, before any trimming.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)


def null_tokens(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """S3: missing-value tokens in string columns -> NULL."""
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    return df.withColumns({
        c: F.when(~F.col(c).isin(*NULL_TOKENS), F.col(c)) for c in columns
    })


def keys_present(keys: list[str]) -> Column:
    """Predicate of F1: every key column is non-NULL."""
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def drop_null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """drop rows with a NULL in any key column.

    Runs before trimming, so a blank-but-present key survives (the
    reference order). The number dropped is reported by the load audit.
    """
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ValueError(f"key column(s) {missing} not in {df.columns}")
    return df.where(keys_present(keys))


def national_rows(df: DataFrame, column: str = "area_type") -> Column:
    """Predicate of F2: national rows (area_type = 1); true when the column is absent."""
    if column not in df.columns:
        return F.lit(True)
    return F.coalesce(coerce_numeric(column) == 1, F.lit(False))


def filter_national(df: DataFrame, column: str = "area_type") -> DataFrame:
    """keep national rows, only if the area column exists."""
    return df.where(national_rows(df, column))


def detailed_code(c) -> Column:
    """Predicate of F3: the code is not a roll-up (does not end in '00')."""
    return F.coalesce(last_two(c) != "00", F.lit(False))


def filter_detailed(df: DataFrame, column: str = "onetsoc_code") -> DataFrame:
    """drop roll-up codes."""
    return df.where(detailed_code(column))


def optional(df: DataFrame, column: str, default) -> Column:
    """The column if the input has it, else a literal default."""
    if column in df.columns:
        return F.col(column)
    return default if isinstance(default, Column) else F.lit(default)
