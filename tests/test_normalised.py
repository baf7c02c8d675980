"""Facts by keys: dense keys over several tasks, and reports equal over the normalised tables."""
from __future__ import annotations

import os

from laborstar.operators import dimensions as D
from laborstar.plans.normalised import normalise
from laborstar.plans.pipeline import load_entries
from laborstar.plans.reports import reports
from laborstar.sources.fixtures import Warehouse
from laborstar.sources.warehouse import StoredWarehouse, manifest
from tests.conftest import SF_SMALL
from tests.test_pipeline import rows


def test_keys_are_dense_and_in_order(spark, scratch):
    def store(df):
        path = os.path.join(scratch, "keys")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    conf = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(conf, "false")
    try:
        df = spark.range(5_000).selectExpr("CASE WHEN id % 7 = 0 THEN NULL ELSE concat('e', id % 900) END AS a", "CAST(id % 3 AS STRING) AS b")
        found = D.dense_keys(df, ["a", "b"], "k", store).orderBy("k").collect()
    finally:
        spark.conf.set(conf, "true")
    want = sorted({(r["a"], r["b"]) for r in df.collect()}, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    assert [(r["a"], r["b"]) for r in found] == want and [r["k"] for r in found] == list(range(1, len(want) + 1))
    assert spark.read.parquet(os.path.join(scratch, "keys")).select("__part").distinct().count() > 1
    empty = D.dense_keys(df.limit(0), ["a"], "k", lambda d: d)
    assert empty.count() == 0


def test_reports_are_equal_over_the_normalised_tables(spark, scratch):
    wh = os.path.join(scratch, "wh")
    load_entries(spark, Warehouse.of(spark, SF_SMALL).raw, wh, "2024-01-01", rows_per_shelf=2_000)
    plain, keyed = StoredWarehouse(spark, wh), normalise(spark, wh)
    for table in D.SCORED:
        assert rows(getattr(plain, table)) == rows(getattr(keyed, table)), table
        assert "element_name" not in spark.read.parquet(*[os.path.join(wh, p) for p in manifest(spark, wh)[f"{table}_keyed"].shelves.values()]).columns
    a, b = reports(plain, "15-1002.00"), reports(keyed, "15-1002.00")
    for name in a:
        assert list(map(tuple, a[name].collect())) == list(map(tuple, b[name].collect())), name
