"""Elements and scales as dimensions with keys that facts refer to.

Keys are dense: 1, 2, 3, ... in the order of the columns. The distinct rows are
range-partitioned and sorted, numbered inside their task, and moved by the
rows of the tasks before - one number per task, so nothing is numbered in one place.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SCORED = ("fact_skills", "fact_knowledge", "fact_education")
ELEMENT = ["element_id", "element_name"]
SCALE = ["scale_id"]


def dense_keys(rows: DataFrame, columns: list[str], key: str, store) -> DataFrame:
    """(key, columns) for every distinct combination; NULL sorts first and is a value.

    ``store`` writes a frame and reads it back: the numbers of the tasks must not be drawn again.
    """
    placed = (rows.select(*columns).distinct().repartitionByRange(*columns).sortWithinPartitions(*columns)
              .withColumn("__at", F.monotonically_increasing_id()))
    placed = store(placed.select(*columns, F.shiftright("__at", 33).alias("__part"), F.col("__at").bitwiseAND((1 << 33) - 1).alias("__nth")))
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)            # one row per task
    before = (placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
              .select("__part", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before")))
    return placed.join(before, "__part").select((F.col("__before") + F.col("__nth") + 1).cast("long").alias(key), *columns)


def _joined(left: DataFrame, right: DataFrame, columns: list[str], how: str = "inner") -> DataFrame:
    """Null-safe equi-join that keeps the left side's columns once."""
    renamed = right.withColumnsRenamed({c: f"__{c}" for c in columns})
    same = reduce(lambda a, b: a & b, [left[c].eqNullSafe(renamed[f"__{c}"]) for c in columns])
    return left.join(renamed, same, how).drop(*[f"__{c}" for c in columns])


def by_key(fact: DataFrame, elements: DataFrame, scales: DataFrame) -> DataFrame:
    """A fact with element_key and scale_key in place of the texts. Dimensions are left to the optimizer: broadcast if small, else AQE splits a hot element."""
    found = _joined(_joined(fact, elements, ELEMENT), scales, SCALE)
    return found.select("onetsoc_code", "element_key", "scale_key", *[c for c in fact.columns if c not in ("onetsoc_code", *ELEMENT, *SCALE)])


def by_text(keyed: DataFrame, elements: DataFrame, scales: DataFrame, columns: list[str]) -> DataFrame:
    """The fact as it was, from its keys."""
    return keyed.join(elements, "element_key").join(scales, "scale_key").select(*columns)


def dimensions(facts: list[DataFrame], store) -> tuple[DataFrame, DataFrame]:
    """(elements, scales) over all facts: (element_key, element_id, element_name) and (scale_key, scale_id)."""
    elements = reduce(DataFrame.unionByName, [f.select(*ELEMENT).distinct() for f in facts])
    scales = reduce(DataFrame.unionByName, [f.select(*SCALE).distinct() for f in facts])
    return dense_keys(elements, ELEMENT, "element_key", store), dense_keys(scales, SCALE, "scale_key", store)
