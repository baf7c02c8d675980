"""The report set over a stored warehouse.

``reports(wh)`` maps a report name to its DataFrame; the CLI prints them.
Both the published query set (Q1-Q6) and the runner's variants (R1-R5) are
available.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from laborstar.plans import marts


def reports(wh, profile_code: str = marts.PROFILE_CODE) -> dict[str, DataFrame]:
    """Report name -> DataFrame over any object with the warehouse tables."""
    dim, skills, knowledge = wh.dim_occupation, wh.fact_skills, wh.fact_knowledge
    education, wages = wh.fact_education, wh.fact_wages
    return {
        "q1_top_paying": marts.q1_top_paying(dim, wages),
        "q2_skill_by_group": marts.q2_skill_by_group(dim, skills),
        "q3_critical_thinking": marts.q3_critical_thinking(dim, skills, wages),
        "q4_wage_by_education": marts.q4_wage_by_education(dim, education, wages),
        "q5_tech_knowledge": marts.q5_tech_knowledge(dim, knowledge),
        "q6_occupation_profile": marts.q6_occupation_profile(dim, wages, skills, knowledge, code=profile_code),
        "r1_top_paying": marts.r1_top_paying(dim, wages),
        "r2_skill_by_group": marts.r2_skill_by_group(dim, skills),
        "r3_critical_thinking": marts.r3_critical_thinking(dim, skills, wages),
        "r4_wage_by_education": marts.r4_wage_by_education(dim, education, wages),
        "r5_tech_knowledge": marts.r5_tech_knowledge(dim, knowledge),
    }
