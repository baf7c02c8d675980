"""Physical-plan checks: no Python on executors, pre-aggregation before the
joins, distributed top-k, pushdown into stored Parquet."""
from __future__ import annotations

import contextlib
import io
import os

import pytest

import __spark_entry__ as E
from laborstar.plans import marts
from laborstar.plans.registry import QUERIES
from laborstar.sources.fixtures import Warehouse
from laborstar.sources.warehouse import write_table, StoredWarehouse
from tests.conftest import SF_SMALL


def explain(df, mode: str = "extended") -> str:
    """The text of ``df.explain(mode)`` (public API; printed by PySpark)."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def plan(df) -> str:
    """Physical plan (final adaptive plan once the frame has been executed)."""
    return explain(df, "formatted")


def optimized(df) -> str:
    text = explain(df, "extended")
    return text[text.index("== Optimized Logical Plan =="):text.index("== Physical Plan ==")]


def test_no_python_evaluation_anywhere(spark):
    for key in QUERIES:
        fn = E.queries()[key]
        p = plan(fn(spark, SF_SMALL))
        for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas", "FlatMapGroupsInPandas"):
            assert node not in p, (key, node)


def test_top_k_is_take_ordered(spark):
    for key in ("q1_top_paying", "q3_critical_thinking", "q6_occupation_profile"):
        df = E.queries()[key](spark, SF_SMALL)
        assert "TakeOrderedAndProject" in plan(df) and "GlobalLimit" in optimized(df), key


def test_facts_are_aggregated_before_the_join(spark):
    w = Warehouse.of(spark, SF_SMALL)
    opt = optimized(marts.q2_skill_by_group(w.dim_occupation, w.fact_skills))
    # The join's inputs are Aggregates (per-code summaries), not raw fact rows.
    join_at = opt.index("Join Inner")
    assert opt.count("Aggregate", join_at) >= 2


def test_q6_never_joins_whole_fact_groups(spark):
    w = Warehouse.of(spark, SF_SMALL)
    df = marts.q6_occupation_profile(w.dim_occupation, w.fact_wages, w.fact_skills, w.fact_knowledge,
                                     code="15-1002.00")
    opt = optimized(df)
    # four per-side limits feed the joins, and every join is cut again
    assert opt.count("GlobalLimit 10") == 7


def test_q1_scans_wages_once(spark):
    w = Warehouse.of(spark, SF_SMALL)
    opt = optimized(marts.q1_top_paying(w.dim_occupation, w.fact_wages))
    assert opt.count("c_custkey") and opt.count("Relation [c_custkey") == 1


def test_k_is_checked(spark):
    w = Warehouse.of(spark, SF_SMALL)
    for k in (0, marts.MAX_K + 1):
        with pytest.raises(ValueError, match="between"):
            marts.q1_top_paying(w.dim_occupation, w.fact_wages, k)


def test_q5_takes_the_group_from_the_dimension(spark):
    """A code that does not start with its group counts too."""
    dim = spark.createDataFrame([("15-1.00", "15"), ("99-1.00", "15"), ("15-2.00", "11")], "onetsoc_code string, soc_major_group string")
    known = spark.createDataFrame([("15-1.00", "Law", "IM", 2.0), ("99-1.00", "Law", "IM", 4.0), ("15-2.00", "Law", "IM", 7.0)],
                                  "onetsoc_code string, element_name string, scale_id string, data_value double")
    assert [tuple(r) for r in marts.q5_tech_knowledge(dim, known).collect()] == [("Law", 2, 3.0, 4.0)]
    assert [tuple(r) for r in marts.r5_tech_knowledge(dim, known).collect()] == [("Law", 2, 3.0)]


def test_stored_scan_prunes_and_pushes(spark, scratch):
    w = Warehouse.of(spark, SF_SMALL)
    wh = os.path.join(scratch, "wh")
    write_table(w.fact_knowledge, wh, "fact_knowledge")
    write_table(w.dim_occupation, wh, "dim_occupation")
    s = StoredWarehouse(spark, wh)
    p = plan(marts.q5_tech_knowledge(s.dim_occupation, s.fact_knowledge))
    assert "EqualTo(scale_id,IM)" in p and "EqualTo(soc_major_group,15)" in p
    assert "ReadSchema: struct<onetsoc_code:string,element_name:string,scale_id:string,data_value:double>" in p


def test_stored_files_hold_disjoint_ranges(spark, scratch):
    """Shuffled rows, a third of them on one code: files cover disjoint (code, element) ranges and the code is split."""
    import pyarrow.parquet as pq
    from pyspark.sql import functions as F
    from laborstar import schemas
    from laborstar.sources.warehouse import table_paths

    hot = F.when(F.col("id") % 3 == 0, F.lit("15-0500.00")).otherwise(F.format_string("15-%04d.00", F.col("id") % 1000))
    facts = (spark.range(30_000).select(hot.alias("onetsoc_code"), F.format_string("e%05d", F.col("id")).alias("element_id"))
             .orderBy(F.rand(1)).repartition(7))
    facts = facts.select(*[F.col(f.name) if f.name in facts.columns else F.lit(None).cast(f.dataType).alias(f.name)
                           for f in schemas.FACT_SKILLS.fields])
    conf = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(conf, "false")
    try:
        entry = write_table(facts, os.path.join(scratch, "wh"), "fact_skills")
    finally:
        spark.conf.set(conf, "true")
    (folder,) = table_paths(os.path.join(scratch, "wh"), entry)
    spans = []
    for name in os.listdir(folder):
        if name.endswith(".parquet"):
            t = pq.read_table(os.path.join(folder, name), columns=["onetsoc_code", "element_id"]).to_pylist()
            keys = [(r["onetsoc_code"], r["element_id"]) for r in t]
            assert keys == sorted(keys)
            if keys:
                spans.append((keys[0], keys[-1]))
            groups = pq.ParquetFile(os.path.join(folder, name)).metadata
            stats = [groups.row_group(g).column(0).statistics for g in range(groups.num_row_groups)]
            assert all(x.max <= keys[-1][0] and x.min >= keys[0][0] for x in stats)
    spans.sort()
    assert len(spans) == 8 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    assert sum(a[0] <= "15-0500.00" <= b[0] for a, b in spans) >= 2


def test_per_code_cut_is_limited_before_the_shuffle(spark):
    """Q1 and Q3 cut wage rows per code with a group limit that
    runs on the map side (a hot code sends at most k rows per task)."""
    for key in ("q1_top_paying", "q3_critical_thinking"):
        df = E.queries()[key](spark, SF_SMALL)
        p = plan(df)
        assert "WindowGroupLimit" in p and "Partial" in p, key


def test_hot_wage_code_is_split_in_j2(spark):
    """With a code holding a third of the wage rows, AQE splits it in the
    rewritten left join (it cannot in a plain left outer join)."""
    from pyspark.sql import functions as F

    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    saved = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        dim = spark.range(200).select(F.format_string("15-%04d.00", "id").alias("onetsoc_code"),
                                      F.lit("t").alias("title"))
        hot = F.when(F.col("id") % 3 == 0, F.lit("15-0007.00")).otherwise(
            F.format_string("15-%04d.00", F.col("id") % 200))
        wages = spark.range(60000).select(hot.alias("onetsoc_code"), (F.col("id") * 1.0).alias("annual_median_wage"))
        rewritten = marts.join_left_wages(dim, wages)
        plain = dim.join(wages, "onetsoc_code", "left").select("onetsoc_code", "title", "annual_median_wage")
        assert sorted(map(tuple, rewritten.collect())) == sorted(map(tuple, plain.collect()))
        assert "AQEShuffleRead skewed" in explain(rewritten, "simple")
        assert "skewed" not in explain(plain, "simple")
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
