"""Reports vs the plain SQL definitions on small random warehouses.

The driver's fixtures have unique dimension and wage codes, so they never
exercise the duplicate-row weighting of the pre-aggregated plans or the
per-side top-k cuts. Here each warehouse has a hot code holding about a
third of every table, duplicate dimension and wage rows, NULL scores and
wages, and many ties; the reports must equal the straightforward SQL (the
oracle texts, run by DuckDB over the same rows).
"""
from __future__ import annotations

import random

import duckdb
import pandas as pd
import pytest

import oracle_queries as O
from laborstar import schemas
from laborstar.plans import marts
from tools.compare import digest

CODES = ["15-1002.00", "15-1003.00", "11-1011.00", "29-1215.00", "15-1004.01", "17-2001.00", "15-1005.00"]
HOT = "15-1002.00"
SKILLS = ["Critical Thinking", "Programming", "Writing", "Reading"]
DOMAINS = ["Mathematics", "Design", "Physics", ""]


def _code(rng):
    return HOT if rng.random() < 0.35 else rng.choice(CODES)


def make_warehouse(seed: int) -> dict[str, pd.DataFrame]:
    rng = random.Random(seed)
    val = lambda hi: None if rng.random() < 0.08 else round(rng.choice([1.0, 2.5, 4.38, 4.38, hi]) * 1.0, 2)
    dim = [(c, f"Title {c[-4:]} {i}", "desc" if i % 2 else None, c[:2])
           for c in CODES[:-1] for i in range(1 + (3 if c == HOT else rng.randint(0, 1)))]
    wages = [(_code(rng).replace(".01", ".00"), rng.choice([None, 50000.0, 75000.0, 75000.0, 120000.0]), 1.0,
              rng.choice([None, 2.0, 9.0]), rng.choice([None, 20.5, 36.06]), 2023) for _ in range(40)]
    skills = [(_code(rng), f"2.A.{i % 4}", rng.choice(SKILLS), rng.choice(["IM", "IM", "LV"]), val(7.0), None)
              for i in range(300)]
    knowledge = [(_code(rng), "2.C.1", rng.choice(DOMAINS), rng.choice(["IM", "IM", "LV"]), val(5.0), None)
                 for _ in range(200)]
    education = [(_code(rng), "2.D.1", rng.choice(["Required Level of Education", "On-Site Training"]), "RL",
                  rng.randint(0, 13), rng.choice([None, 10.0, 50.0, 50.01, 75.0]))
                 for _ in range(200)]
    cols = {name: [f.name for f in schema] for name, schema in schemas.TABLES.items()}
    frames = {
        "dim_occupation": dim, "fact_wages": wages, "fact_skills": skills,
        "fact_knowledge": knowledge, "fact_education": education,
    }
    return {t: pd.DataFrame(rows, columns=cols[t]) for t, rows in frames.items()}


def spark_tables(spark, pdfs):
    return {t: spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), schemas.TABLES[t])
            for t, pdf in pdfs.items()}


_SCORES = """SELECT onetsoc_code AS "O*NET-SOC Code", element_id AS "Element ID", element_name AS "Element Name", scale_id AS "Scale ID",
CAST(data_value AS VARCHAR) AS "Data Value" """
# Raw rows that clean to the warehouse's rows: the report SQL starts from raw texts.
RAW_VIEWS = {
    "raw_skills": f"{_SCORES} FROM fact_skills", "raw_knowledge": f"{_SCORES} FROM fact_knowledge",
    "raw_education": f"{_SCORES}, CAST(category AS VARCHAR) AS \"Category\" FROM fact_education",
    "raw_wages": """SELECT left(onetsoc_code, 7) AS "OCC_CODE", 1 AS "AREA_TYPE", CAST(annual_median_wage AS VARCHAR) AS "A_MEDIAN",
                    CAST(hourly_median_wage AS VARCHAR) AS "H_MEDIAN" FROM fact_wages""",
}


def duck_result(pdfs, sql):
    con = duckdb.connect()
    for t, pdf in pdfs.items():
        con.register(f"{t}_pdf", pdf)
        casts = ", ".join(
            f"CAST({f.name} AS {'DOUBLE' if f.dataType.simpleString() == 'double' else 'INTEGER' if f.dataType.simpleString() == 'int' else 'TIMESTAMP' if f.dataType.simpleString() == 'timestamp' else 'VARCHAR'}) AS {f.name}"
            for f in schemas.TABLES[t])
        con.execute(f"CREATE VIEW {t} AS SELECT {casts} FROM {t}_pdf")
    for view, text in RAW_VIEWS.items():
        con.execute(f"CREATE VIEW {view} AS {text}")
    cur = con.execute(sql)
    return [d[0] for d in cur.description], cur.fetchall()


REPORTS = {
    "q1_top_paying": lambda t: marts.q1_top_paying(t["dim_occupation"], t["fact_wages"]),
    "q2_skill_by_group": lambda t: marts.q2_skill_by_group(t["dim_occupation"], t["fact_skills"]),
    "q3_critical_thinking": lambda t: marts.q3_critical_thinking(t["dim_occupation"], t["fact_skills"], t["fact_wages"]),
    "q4_wage_by_education": lambda t: marts.q4_wage_by_education(t["dim_occupation"], t["fact_education"], t["fact_wages"]),
    "q5_tech_knowledge": lambda t: marts.q5_tech_knowledge(t["dim_occupation"], t["fact_knowledge"]),
    "q6_occupation_profile": lambda t: marts.q6_occupation_profile(
        t["dim_occupation"], t["fact_wages"], t["fact_skills"], t["fact_knowledge"], code=HOT),
    "r1_top_paying": lambda t: marts.r1_top_paying(t["dim_occupation"], t["fact_wages"]),
    "r2_skill_by_group": lambda t: marts.r2_skill_by_group(t["dim_occupation"], t["fact_skills"]),
    "r3_critical_thinking": lambda t: marts.r3_critical_thinking(t["dim_occupation"], t["fact_skills"], t["fact_wages"]),
    "r4_wage_by_education": lambda t: marts.r4_wage_by_education(t["dim_occupation"], t["fact_education"], t["fact_wages"]),
    "r5_tech_knowledge": lambda t: marts.r5_tech_knowledge(t["dim_occupation"], t["fact_knowledge"]),
    "join_inner": lambda t: marts.join_inner(t["dim_occupation"], t["fact_wages"]),
    "join_left_wages": lambda t: marts.join_left_wages(t["dim_occupation"], t["fact_wages"]),
}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_reports_equal_plain_sql(spark, seed):
    pdfs = make_warehouse(seed)
    tables = spark_tables(spark, pdfs)
    for key, build in REPORTS.items():
        df = build(tables)
        got = [tuple(r) for r in df.collect()]
        cols, expected = duck_result(pdfs, O.QUERIES[key].replace("'15-1002.00'", f"'{HOT}'"))
        assert sorted(df.columns) == sorted(cols), key
        assert len(got) == len(expected), (key, got, expected)
        assert digest(df.columns, got)[0] == digest(cols, expected)[0], (key, got, expected)


def test_hot_code_really_is_hot():
    pdfs = make_warehouse(1)
    for t in ("fact_skills", "fact_wages", "fact_knowledge"):
        assert (pdfs[t]["onetsoc_code"] == HOT).mean() > 0.3
    assert (pdfs["dim_occupation"]["onetsoc_code"] == HOT).sum() == 4


def test_reports_invariant_under_repartitioning(spark):
    """Partitioning of the inputs (including by the hot key) never changes a result."""
    pdfs = make_warehouse(4)
    base = spark_tables(spark, pdfs)
    moved = {t: (df.repartition(5, "onetsoc_code") if i % 2 else df.repartition(3)) for i, (t, df) in
             enumerate(base.items())}
    for key, build in REPORTS.items():
        a = sorted(map(tuple, build(base).collect()), key=repr)
        b = sorted(map(tuple, build(moved).collect()), key=repr)
        assert a == b, key
