"""Golden micro-warehouses for Q2, Q4, Q5 and Q6.

The published result tables cannot be replayed (their input data is not
shipped). Instead, literal rows are built so that the aggregates equal the
published figures, and each report must print exactly the published table:
values, rounding, labels and row order (including the order of ties).
"""
from __future__ import annotations

from laborstar import schemas
from laborstar.plans import marts

# Published skill-importance table (group, occupations, avg, max, min), in published order.
Q2_GOLDEN = [
    ("17", 55, 2.9, 4.25, 1.0), ("11", 54, 2.9, 4.88, 1.0), ("29", 82, 2.79, 4.62, 1.0), ("19", 59, 2.79, 4.75, 1.0),
    ("15", 31, 2.77, 5.0, 1.0), ("49", 50, 2.72, 4.88, 1.0), ("21", 14, 2.72, 5.0, 1.0), ("25", 61, 2.67, 4.88, 1.0),
    ("13", 45, 2.61, 4.62, 1.0), ("33", 25, 2.53, 4.38, 1.0), ("27", 38, 2.5, 4.88, 1.0), ("53", 49, 2.48, 4.88, 1.0),
    ("23", 7, 2.47, 5.0, 1.0), ("47", 61, 2.45, 4.75, 1.0), ("51", 107, 2.42, 4.12, 1.0), ("41", 21, 2.42, 4.25, 1.0),
    ("37", 8, 2.42, 4.0, 1.0), ("45", 12, 2.39, 4.12, 1.0), ("31", 19, 2.39, 4.12, 1.0), ("39", 29, 2.3, 4.12, 1.0),
    ("43", 51, 2.29, 4.38, 1.0), ("35", 16, 2.22, 4.12, 1.0),
]

# Published wage-by-education table (level, label, occupations, avg annual, avg hourly).
Q4_GOLDEN = [
    (1, "No HS Diploma", 26, 41928.0, 20.16), (2, "HS Diploma / GED", 188, 50237.0, 24.11),
    (3, "Some College / Assoc.", 18, 57977.0, 27.87), (4, "Bachelor's Degree", 2, 43175.0, 20.76),
    (5, "Graduate Degree", 17, 77444.0, 37.23), (6, "Post-Baccalaureate", 97, 89867.0, 43.57),
    (7, "Master's Degree", 1, 73850.0, 35.5), (8, "Post-Master's", 26, 86163.0, 42.08),
    (9, "First Professional Degree", 1, 86930.0, 41.79), (11, "Doctoral Degree", 36, 109516.0, 68.52),
    (12, "Post-Doctoral", 12, 223240.0, 107.33),
]

# Published knowledge-domain table for group 15 (domain, avg, max); 31 occupations each.
Q5_GOLDEN = [
    ("Computers and Electronics", 4.38, 4.96), ("English Language", 3.73, 4.29), ("Mathematics", 3.51, 4.93),
    ("Engineering and Technology", 3.16, 4.25), ("Customer and Personal Service", 3.12, 4.24),
    ("Administration and Management", 2.99, 4.0), ("Education and Training", 2.89, 3.72), ("Design", 2.78, 4.26),
    ("Telecommunications", 2.66, 4.9), ("Administrative", 2.53, 3.45), ("Communications and Media", 2.51, 4.1),
    ("Economics and Accounting", 2.19, 3.78), ("Production and Processing", 2.18, 3.71),
    ("Law and Government", 2.18, 3.45), ("Public Safety and Security", 2.17, 3.27),
    ("Personnel and Human Resources", 2.15, 3.14), ("Sales and Marketing", 2.0, 3.0), ("Psychology", 1.98, 3.3),
    ("Geography", 1.73, 4.71), ("Sociology and Anthropology", 1.7, 3.0), ("Mechanical", 1.68, 3.66),
    ("Physics", 1.63, 3.0), ("Biology", 1.5, 3.8), ("Medicine and Dentistry", 1.48, 3.7),
    ("Transportation", 1.44, 2.1), ("Building and Construction", 1.4, 2.67), ("Chemistry", 1.37, 2.75),
    ("Foreign Language", 1.35, 1.9), ("Philosophy and Theology", 1.32, 1.83), ("History and Archeology", 1.32, 2.08),
    ("Therapy and Counseling", 1.28, 2.1), ("Fine Arts", 1.25, 2.65), ("Food Production", 1.08, 1.33),
]

# Published profile of one occupation (top skill x knowledge pairs).
Q6_CODE = "15-1252.00"
Q6_KNOWLEDGE = [
    ("Computers and Electronics", 4.75), ("Mathematics", 3.57), ("Customer and Personal Service", 3.56),
    ("English Language", 3.27), ("Education and Training", 2.84), ("Engineering and Technology", 2.8),
    ("Design", 2.7), ("Telecommunications", 2.62), ("Public Safety and Security", 2.57),
    ("Production and Processing", 2.54),
]


def dim_rows(codes):
    return [(c, "Title " + c, "", c[:2]) for c in codes]


def codes_of(group, n):
    return [f"{group}-{1000 + i}.00" for i in range(n)]


def test_q2_golden(spark):
    dim, skills = [], []
    for group, n, avg, hi, lo in Q2_GOLDEN:
        codes = codes_of(group, n)
        dim += dim_rows(codes)
        rest = (n * avg - hi - lo) / (n - 2)          # the other codes share one value
        for c, v in zip(codes, [hi, lo] + [rest] * (n - 2)):
            skills.append((c, "2.A.1", "Writing", "IM", v, None))
            skills.append((c, "2.A.1", "Writing", "LV", 6.5, None))   # other scale: ignored
    out = marts.q2_skill_by_group(spark.createDataFrame(dim, schemas.DIM_OCCUPATION),
                                  spark.createDataFrame(skills, schemas.FACT_SKILLS)).collect()
    assert [tuple(r) for r in out] == Q2_GOLDEN


def test_q4_golden_with_unlabelled_levels(spark):
    dim, edu, wages = [], [], []
    for level, _, n, annual, hourly in Q4_GOLDEN:
        codes = codes_of(f"{level:02d}", n)
        dim += dim_rows(codes)
        for c in codes:
            edu.append((c, "2.D.1", "Required Level of Education", "RL", level, 75.0))
            edu.append((c, "2.D.1", "Required Level of Education", "RL", 99, 40.0))   # not a majority
            wages.append((c, annual, None, None, hourly, 2023))
    out = marts.q4_wage_by_education(spark.createDataFrame(dim, schemas.DIM_OCCUPATION),
                                     spark.createDataFrame(edu, schemas.FACT_EDUCATION),
                                     spark.createDataFrame(wages, schemas.FACT_WAGES)).collect()
    assert [tuple(r) for r in out] == Q4_GOLDEN


def test_q5_golden_order_of_ties(spark):
    codes = codes_of("15", 31)
    dim = dim_rows(codes) + dim_rows(codes_of("17", 3))
    rows = []
    for domain, avg, hi in Q5_GOLDEN:
        rest = (31 * avg - hi) / 30
        for c, v in zip(codes, [hi] + [rest] * 30):
            rows.append((c, "2.C.1", domain, "IM", v, None))
        rows.append(("17-1000.00", "2.C.1", domain, "IM", 7.0, None))     # other group: ignored
    out = marts.q5_tech_knowledge(spark.createDataFrame(dim, schemas.DIM_OCCUPATION),
                                  spark.createDataFrame(rows, schemas.FACT_KNOWLEDGE)).collect()
    assert [tuple(r) for r in out] == [(d, 31, a, m) for d, a, m in Q5_GOLDEN]


def test_q6_golden_profile(spark):
    dim = [(Q6_CODE, "Software Developers", "Research, design, and develop computer software.", "15")]
    wages = [(Q6_CODE, 133080.0, None, None, 63.98, 2023)]
    skills = [(Q6_CODE, "2.B.3.e", "Programming", "IM", 4.0, None),
              (Q6_CODE, "2.A.2.a", "Critical Thinking", "IM", 3.88, None),
              (Q6_CODE, "2.B.3.e", "Programming", "LV", 5.0, None)]
    knowledge = [(Q6_CODE, "2.C.3.a", name, "IM", v, None) for name, v in Q6_KNOWLEDGE]
    knowledge += [(Q6_CODE, "2.C.9", "Physics", "IM", 1.5, None), ("15-9999.00", "2.C.1", "X", "IM", 9.0, None)]
    out = marts.q6_occupation_profile(spark.createDataFrame(dim, schemas.DIM_OCCUPATION),
                                      spark.createDataFrame(wages, schemas.FACT_WAGES),
                                      spark.createDataFrame(skills, schemas.FACT_SKILLS),
                                      spark.createDataFrame(knowledge, schemas.FACT_KNOWLEDGE)).collect()
    assert [(r.top_skill, r.skill_importance, r.top_knowledge, r.knowledge_importance) for r in out] == \
        [("Programming", 4.0, name, v) for name, v in Q6_KNOWLEDGE]
    assert {(r.title, r.annual_median_wage, r.hourly_median_wage) for r in out} == \
        {("Software Developers", 133080.0, 63.98)}
