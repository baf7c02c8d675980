"""Empty inputs and all-NULL columns."""
from __future__ import annotations

from laborstar import schemas
from laborstar.operators import transforms as T
from laborstar.operators import validation as V
from laborstar.plans import marts

RAW_COLUMNS = {
    "occupation_data": ["O*NET-SOC Code", "Title", "Description"],
    "skills": ["O*NET-SOC Code", "Element ID", "Element Name", "Scale ID", "Data Value", "Date"],
    "knowledge": ["O*NET-SOC Code", "Element ID", "Element Name", "Scale ID", "Data Value", "Date"],
    "education_training_experience": ["O*NET-SOC Code", "Element ID", "Element Name", "Scale ID", "Category", "Data Value"],
    "task_statements": ["O*NET-SOC Code", "Task ID", "Task", "Task Type", "Incumbents Responding"],
    "wages": ["OCC_CODE", "AREA_TYPE", "A_MEDIAN", "A_PCT10", "A_PCT90", "H_MEDIAN"],
}


def empty_raw(spark, cols):
    return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in cols))


def test_transforms_of_empty_files(spark):
    for spec in T.TABLE_SPECS:
        out = spec.clean(empty_raw(spark, RAW_COLUMNS[spec.source]), as_of="2024-01-01")
        assert out.count() == 0
        assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in spec.schema]


def test_all_null_columns(spark):
    cols = RAW_COLUMNS["skills"]
    raw = spark.createDataFrame([("15-1252.00", "2.A.1", "Writing", None, None, None)] * 3,
                                ", ".join(f"`{c}` string" for c in cols))
    out = T.transform_skills(raw).collect()
    assert len(out) == 3 and all(r.scale_id is None and r.data_value is None and r.date_updated is None for r in out)
    dim = spark.createDataFrame([("15-1252.00", "Dev", "", "15")], schemas.DIM_OCCUPATION)
    skills = spark.createDataFrame([("15-1252.00", "2.A.1", "Writing", "IM", None, None)], schemas.FACT_SKILLS)
    q2 = marts.q2_skill_by_group(dim, skills).collect()
    assert [tuple(r) for r in q2] == [("15", 1, None, None, None)]      # the occupation still counts


def empty(spark, schema):
    return spark.createDataFrame([], schema)


def test_reports_and_checks_on_an_empty_warehouse(spark):
    dim, skills, knowledge = (empty(spark, schemas.DIM_OCCUPATION), empty(spark, schemas.FACT_SKILLS),
                              empty(spark, schemas.FACT_KNOWLEDGE))
    education, wages = empty(spark, schemas.FACT_EDUCATION), empty(spark, schemas.FACT_WAGES)
    for df in (marts.q1_top_paying(dim, wages), marts.q2_skill_by_group(dim, skills),
               marts.q3_critical_thinking(dim, skills, wages), marts.q4_wage_by_education(dim, education, wages),
               marts.q5_tech_knowledge(dim, knowledge),
               marts.q6_occupation_profile(dim, wages, skills, knowledge),
               marts.r4_wage_by_education(dim, education, wages), marts.join_left_wages(dim, wages)):
        assert df.count() == 0
    report = {r.check: (r.violations, r.passed) for r in V.validation_report(dim, skills, knowledge, wages).collect()}
    assert report == {c: (0, True) for c in V.CHECKS}
