"""Differences between two releases of a table, and dimensions over all facts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _summary(df: DataFrame, keys: list[str], columns: list[str], name: str) -> DataFrame:
    """Per key: the number of rows and a sum of row hashes, which does not depend on row order."""
    # A hash skips NULLs, so every value is preceded by whether it is one.
    row = F.xxhash64(*[x for c in columns for x in (F.col(c).isNull(), F.col(c))]) if columns else F.lit(0).cast("bigint")
    return df.groupBy(*[F.col(k).alias(f"{name}_{k}") for k in keys]).agg(
        F.count(F.lit(1)).alias(f"rows_{name}"), F.sum(row.cast("decimal(20,0)")).alias(f"hash_{name}"))


def snapshot_diff(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Keys whose rows were added, removed or changed: keys, change, rows_old, rows_new.

    Both releases are reduced to one row per key before they meet (combined
    map-side, so a key with a third of all rows is one row per task). Rows of
    a key are compared as a multiset; a NULL key is a key.
    """
    columns = sorted(c for c in old.columns if c not in keys)
    if sorted(old.columns) != sorted(new.columns):
        raise ValueError(f"columns differ: {old.columns} and {new.columns}")
    a, b = _summary(old, keys, columns, "old"), _summary(new, keys, columns, "new")
    same = reduce(lambda x, y: x & y, [a[f"old_{k}"].eqNullSafe(b[f"new_{k}"]) for k in keys])
    change = (F.when(F.col("rows_old").isNull(), "added").when(F.col("rows_new").isNull(), "removed")
              .when((F.col("rows_old") != F.col("rows_new")) | (F.col("hash_old") != F.col("hash_new")), "changed"))
    return (a.join(b, same, "full_outer").withColumn("change", change).where(F.col("change").isNotNull())
            .select(*[F.when(F.col("rows_new").isNull(), F.col(f"old_{k}")).otherwise(F.col(f"new_{k}")).alias(k) for k in keys],
                    "change", F.coalesce("rows_old", F.lit(0)).alias("rows_old"), F.coalesce("rows_new", F.lit(0)).alias("rows_new")))


def dim_scale(*facts: DataFrame) -> DataFrame:
    """One row per scale id over all scored facts: rows, smallest and largest value."""
    whole = reduce(DataFrame.unionByName, [f.select("scale_id", "data_value") for f in facts])
    return whole.groupBy("scale_id").agg(F.count(F.lit(1)).alias("scored_rows"), F.min("data_value").alias("min_value"),
                                         F.max("data_value").alias("max_value"))


def dim_element(**facts: DataFrame) -> DataFrame:
    """One row per domain (the argument's name) and element id, with its smallest name."""
    whole = reduce(DataFrame.unionByName, [f.select(F.lit(d).alias("domain"), "element_id", "element_name") for d, f in facts.items()])
    return whole.groupBy("domain", "element_id").agg(F.min("element_name").alias("element_name"))
