"""Golden micro-warehouse: a few literal rows from the published result
tables; the reports must reproduce the published order and NULLs."""
from __future__ import annotations

from laborstar import schemas
from laborstar.plans import marts

# Rows of the published top-paying and critical-thinking tables.
Q1_ROWS = [
    ("29-1215.00", "Family Medicine Physicians", 238380.0, 114.61),
    ("29-1216.00", "General Internal Medicine Physicians", 236350.0, 113.63),
    ("53-2011.00", "Airline Pilots, Copilots, And Flight Engineers", 226600.0, None),
    ("29-1029.00", "Dentists, All Other Specialists", 225770.0, 108.54),
    ("29-1151.00", "Nurse Anesthetists", 223210.0, 107.31),
    ("29-1221.00", "Pediatricians, General", 210130.0, 101.03),
    ("11-1011.00", "Chief Executives", 206420.0, 99.24),
    ("29-1021.00", "Dentists, General", 172790.0, 83.07),
    ("11-3021.00", "Computer And Information Systems Managers", 171200.0, 82.31),
    ("11-9041.00", "Architectural And Engineering Managers", 167740.0, 80.64),
]
EXTRA = [("15-2011.00", "Actuaries", 125770.0, 60.47), ("23-1023.00", "Judges, Magistrate Judges, And Magistrates",
                                                         156210.0, 75.1)]
Q3_SCORES = [
    ("23-1023.00", 4.88), ("11-9032.00", 4.5), ("23-1011.00", 4.5), ("29-1211.00", 4.5), ("11-1011.00", 4.38),
    ("29-1214.00", 4.38), ("29-1215.00", 4.38), ("29-1218.00", 4.38), ("11-3013.01", 4.25), ("15-2011.00", 4.25),
    ("13-2011.00", 3.0),
]


def _dim_wages(spark):
    titles = {c: t for c, t, _, _ in Q1_ROWS + EXTRA}
    for code, _ in Q3_SCORES:
        titles.setdefault(code, "Title " + code)
    dim = spark.createDataFrame([(c, t, "", c[:2]) for c, t in titles.items()], schemas.DIM_OCCUPATION)
    wages = spark.createDataFrame([(c, a, None, None, h, 2023) for c, _, a, h in Q1_ROWS + EXTRA],
                                  schemas.FACT_WAGES)
    return dim, wages


def test_q1_golden_order_and_null_spread(spark):
    dim, wages = _dim_wages(spark)
    out = marts.q1_top_paying(dim, wages).collect()
    assert [r.onetsoc_code for r in out] == [c for c, _, _, _ in Q1_ROWS]
    assert all(r.wage_spread is None for r in out)
    assert out[2].hourly_median_wage is None and out[0].soc_major_group == "29"


def test_q3_golden_order_with_ties(spark):
    dim, wages = _dim_wages(spark)
    skills = spark.createDataFrame(
        [(c, "2.A.2.a", "Critical Thinking", "IM", v, None) for c, v in Q3_SCORES]
        + [(c, "2.A.2.a", "Critical Thinking", "LV", 6.0, None) for c, _ in Q3_SCORES],
        schemas.FACT_SKILLS)
    out = marts.q3_critical_thinking(dim, skills, wages).collect()
    assert [r.onetsoc_code for r in out] == [c for c, _ in Q3_SCORES[:10]]
    assert [r.importance_score for r in out] == [v for _, v in Q3_SCORES[:10]]
    # codes without a wage row keep a NULL wage (left join); .01 codes never match a wage
    assert {r.onetsoc_code for r in out if r.annual_median_wage is None} >= {"29-1211.00", "11-3013.01"}


def test_q3_expands_duplicate_rows(spark):
    """Eleven identical top rows for one code: the report keeps ten copies."""
    dim, wages = _dim_wages(spark)
    skills = spark.createDataFrame([("15-2011.00", "2.A.2.a", "Critical Thinking", "IM", 5.0, None)] * 11
                                   + [("11-1011.00", "2.A.2.a", "Critical Thinking", "IM", 4.0, None)],
                                   schemas.FACT_SKILLS)
    out = marts.q3_critical_thinking(dim, skills, wages).collect()
    assert len(out) == 10 and {r.onetsoc_code for r in out} == {"15-2011.00"}
