"""The scored facts stored by keys: dim_element and dim_scale as tables that they refer to.

``normalise`` adds the two dimensions and the keyed facts to a stored warehouse, in one publish;
``NormalisedWarehouse`` answers the same reports from them. A column of two short texts per fact
row becomes two numbers, and the texts are joined back after the reports' aggregations have asked for them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from laborstar import schemas
from laborstar.operators import dimensions as D
from laborstar.sources.warehouse import Entry, StoredWarehouse, publish, read_entry, write_shelves


def normalise(spark: SparkSession, warehouse_dir: str) -> "NormalisedWarehouse":
    """Build and publish the dimensions and the keyed facts of the current version."""
    root = warehouse_dir.rstrip("/")
    wh = StoredWarehouse(spark, root)

    def store(df: DataFrame) -> DataFrame:
        path = f"{root}/staging/keys-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    facts = {t: getattr(wh, t) for t in D.SCORED}
    elements, scales = D.dimensions(list(facts.values()), store)
    entries = {}
    for name, df in (("dim_element", elements), ("dim_scale", scales)):
        entries[name] = Entry(name, (), write_shelves(df, root, name))
    elements, scales = (read_entry(spark, root, entries[n]) for n in ("dim_element", "dim_scale"))
    for table, df in facts.items():
        bounds = wh.entries[table].bounds
        entries[f"{table}_keyed"] = Entry(f"{table}_keyed", bounds, write_shelves(D.by_key(df, elements, scales), root, f"{table}_keyed", bounds))
    publish(spark, root, entries)
    return NormalisedWarehouse(spark, root)


class NormalisedWarehouse(StoredWarehouse):
    """The stored tables, the scored facts read through their keys."""

    def __getattr__(self, table: str) -> DataFrame:
        if table in D.SCORED:
            keyed, elements, scales = (super(NormalisedWarehouse, self).__getattr__(t) for t in (f"{table}_keyed", "dim_element", "dim_scale"))
            return D.by_text(keyed, elements, scales, schemas.TABLES[table].fieldNames())
        return super().__getattr__(table)
