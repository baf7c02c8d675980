"""A bounded sample that does not depend on partitioning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def smallest(df: DataFrame, column: str, n: int) -> DataFrame:
    """The ``n`` rows with the smallest hashes of ``column`` (null left out), as a table of at most n rows.

    A threshold on the hash leaves about 2 n rows before they are ordered, so few rows meet in the final sort; where few
    distinct values leave fewer than n, all rows are ordered.
    """
    rows = df.where(F.col(column).isNotNull()).withColumn("__order", F.xxhash64(column))
    total = rows.count()
    if total > 2 * n:
        few = rows.where(F.col("__order") < int(-(1 << 63) + 2 * n / total * (1 << 64)))
        rows = few if few.limit(n).count() == n else rows
    return rows.orderBy("__order", *df.columns).limit(n).drop("__order")
