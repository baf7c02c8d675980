"""Table transforms (T1-T7), the audit invariant and idempotence."""
from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from laborstar import schemas
from laborstar.operators import transforms as T
from laborstar.operators.audit import load_audit
from laborstar.sources import fixtures as fx
from tests.conftest import SF_SMALL


def same_types(df, schema):
    return [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in schema]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_occupations(spark):
    raw = spark.createDataFrame([
        ("  15-1252.00 ", " software DEVELOPERS-web (ai) ", " Writes code. "),
        (None, "x", "y"),
        ("11-1011.00", None, "z"),
        ("11-1011.00", "  ", None),
    ], ["O*NET-SOC Code", "Title", "Description"])
    out = T.transform_occupations(raw)
    assert same_types(out, schemas.DIM_OCCUPATION)
    assert rows(out) == [("11-1011.00", "", "", "11"),
                         ("15-1252.00", "Software Developers-Web (Ai)", "Writes code.", "15")]


def test_skills_clip_round_date(spark):
    raw = spark.createDataFrame([
        ("15-1252.00", "2.A.1", "Critical Thinking", " im", "4.125", "08/2023"),
        ("15-1252.00", "2.A.2", "Programming", "IM", "9.5", "2023-07-01"),
        ("15-1252.00", "2.A.3", "Writing", "lv", "-1", "bad"),
        ("15-1252.00", "2.A.4", "Reading", "IM", "n/a", None),
        ("15-1252.00", None, "Reading", "IM", "1", None),
    ], ["O*NET-SOC Code", "Element ID", "Element Name", "Scale ID", "Data Value", "Date"])
    out = T.transform_skills(raw)
    assert same_types(out, schemas.FACT_SKILLS)
    got = {r.element_id: (r.scale_id, r.data_value, r.date_updated) for r in out.collect()}
    assert got == {
        "2.A.1": ("IM", 4.12, dt.datetime(2023, 8, 1)),
        "2.A.2": ("IM", 7.0, dt.datetime(2023, 7, 1)),
        "2.A.3": ("LV", 0.0, None),
        "2.A.4": ("IM", None, None),
    }


def test_skills_without_date_uses_load_date(spark):
    raw = spark.createDataFrame([("15-1252.00", "2.A.1", "Writing", "IM", "3")],
                                ["O*NET-SOC Code", "Element ID", "Element Name", "Scale ID", "Data Value"])
    assert T.transform_skills(raw, as_of="2024-05-06").first().date_updated == dt.datetime(2024, 5, 6)


def test_education_category_defaults(spark):
    raw = spark.createDataFrame([
        ("15-1252.00", "2.D.1", "Required Level of Education", " rl", "3.7", "150"),
        ("15-1252.00", "2.D.1", "Required Level of Education", "RL", "n/a", "55.555"),
    ], ["O*NET-SOC Code", "Element ID", "Element Name", "Scale ID", "Category", "Data Value"])
    out = T.transform_education(raw)
    assert same_types(out, schemas.FACT_EDUCATION)
    assert rows(out.select("category", "data_value")) == [(0, 55.56), (3, 100.0)]
    assert rows(T.transform_education(raw.drop("Category")).select("category")) == [(0,), (0,)]


def test_tasks_defaults(spark):
    raw = spark.createDataFrame([
        ("15-1252.00", "101", "  Write code ", None, "n/a"),
        ("15-1252.00", "102", "Test", "Supplemental", "7.9"),
        ("15-1252.00", "103", None, "Core", "1"),
    ], ["O*NET-SOC Code", "Task ID", "Task", "Task Type", "Incumbents Responding"])
    out = T.transform_tasks(raw)
    assert same_types(out, schemas.FACT_TASKS)
    assert rows(out) == [("15-1252.00", "101", "Write code", "Core", 0),
                         ("15-1252.00", "102", "Test", "Supplemental", 7)]
    bare = T.transform_tasks(raw.drop("Task Type", "Incumbents Responding"))
    assert rows(bare.select("task_type", "incumbents_responding")) == [("Core", 0), ("Core", 0)]


def test_wages(spark):
    raw = spark.createDataFrame([
        (" 15-1252 ", "1", "133080", "80000", "200000", "63.98"),
        ("15-1000", "1", "1", "1", "1", "1"),          # roll-up code
        ("15-1253", "2", "1", "1", "1", "1"),          # not national
        (None, "1", "1", "1", "1", "1"),               # no code
        ("29-1215", "1", "#", "*", "#", "114.61"),     # suppressed
    ], ["OCC_CODE", "AREA_TYPE", "A_MEDIAN", "A_PCT10", "A_PCT90", "H_MEDIAN"])
    out = T.transform_wages(raw)
    assert same_types(out, schemas.FACT_WAGES)
    assert rows(out) == [("15-1252.00", 133080.0, 80000.0, 200000.0, 63.98, 2023),
                         ("29-1215.00", None, None, None, 114.61, 2023)]
    assert T.transform_wages(raw, wage_year=2024).first().wage_year == 2024


def test_missing_required_column_fails(spark):
    raw = spark.createDataFrame([("a", "b")], ["O*NET-SOC Code", "Title"])
    with pytest.raises(schemas.ContractError):
        T.transform_occupations(raw)


def test_clean_twice_is_clean_once(spark):
    w = fx.Warehouse.of(spark, SF_SMALL)
    for table, fn in [("dim_occupation", T.transform_occupations), ("fact_skills", T.transform_skills),
                      ("fact_knowledge", T.transform_knowledge), ("fact_education", T.transform_education),
                      ("fact_tasks", T.transform_tasks)]:
        once = getattr(w, table)
        assert rows(fn(once)) == rows(once), table


def test_scores_within_range(spark):
    w = fx.Warehouse.of(spark, SF_SMALL)
    for df, hi in [(w.fact_skills, 7), (w.fact_knowledge, 7), (w.fact_education, 100)]:
        lo_, hi_ = df.agg(F.min("data_value"), F.max("data_value")).first()
        assert 0 <= lo_ and hi_ <= hi
        assert df.where(F.isnan("data_value")).count() == 0


def test_audit_invariant(spark):
    w = fx.Warehouse.of(spark, SF_SMALL)
    audit = {r.table: r for r in load_audit(w.raw, as_of="2024-01-01").collect()}
    assert set(audit) == {s.table for s in T.TABLE_SPECS}
    for spec in T.TABLE_SPECS:
        r = audit[spec.table]
        assert r.rows_in == r.rows_out + r.rows_dropped
        assert r.rows_out == getattr(w, spec.table).count()


def test_dim_skill_element_unique(spark):
    out = T.dim_skill_element(fx.Warehouse.of(spark, SF_SMALL).fact_skills)
    assert out.count() == out.select("element_id").distinct().count()


def test_blank_title_survives_cleaning_and_fails_v2(spark):
    """The NULL-key drop runs before trimming, so a blank title is kept as ''
    and only the V2 check reports it."""
    from laborstar.operators import validation as V
    raw = spark.createDataFrame([("11-1011.00", "   ", "d"), ("11-1012.00", "Chief", "d"), ("11-1013.00", None, "d")],
                                ["O*NET-SOC Code", "Title", "Description"])
    dim = T.transform_occupations(raw)
    assert rows(dim.select("title")) == [("",), ("Chief",)]
    assert V.v2_null_titles(dim).first().violations == 1
