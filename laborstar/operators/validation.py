"""Data-quality checks.

Each check counts violations and never aborts; ``passed`` is
``violations == 0``. Checks are global aggregates: every task counts its
own rows and only one partial count per task reaches the final reducer.
The orphan check (V6) counts fact rows per code map-side first, so the
anti-join shuffles one row per code per task instead of every fact row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laborstar.functions import coerce_numeric
from laborstar.operators.headers import normalize_headers, rename_wage_headers

CODE = "onetsoc_code"

# Check ids, in report order.
CHECKS = (
    "v1_null_codes",
    "v2_null_titles",
    "v3_skills_range",
    "v4_knowledge_range",
    "v5_negative_wages",
    "v6_orphan_skills",
)

SCORE_LO, SCORE_HI = 0.0, 7.0


def out_of_range(c: str, lo: float = SCORE_LO, hi: float = SCORE_HI) -> Column:
    """below lo or above hi; NULL is not a violation."""
    return (F.col(c) < lo) | (F.col(c) > hi)


def _report(df: DataFrame, **violations: Column) -> DataFrame:
    """One aggregate pass over df -> rows (check, violations, passed)."""
    counts = df.agg(*[F.coalesce(v, F.lit(0)).cast("bigint").alias(name) for name, v in violations.items()])
    rows = F.explode(F.array(*[
        F.struct(F.lit(name).alias("check"), F.col(name).alias("violations")) for name in violations
    ])).alias("r")
    return (counts.select(rows).select("r.check", "r.violations")
            .withColumn("passed", F.col("violations") == 0))


def occupation_checks(dim: DataFrame) -> DataFrame:
    """V1 + V2 in a single scan of the dimension."""
    return _report(
        dim,
        v1_null_codes=F.count_if(F.col(CODE).isNull()),
        v2_null_titles=F.count_if(F.col("title").isNull() | (F.col("title") == "")),
    )


def v1_null_codes(dim: DataFrame) -> DataFrame:
    return _report(dim, v1_null_codes=F.count_if(F.col(CODE).isNull()))


def v2_null_titles(dim: DataFrame) -> DataFrame:
    return _report(dim, v2_null_titles=F.count_if(F.col("title").isNull() | (F.col("title") == "")))


def v3_skills_range(skills: DataFrame) -> DataFrame:
    return _report(skills, v3_skills_range=F.count_if(out_of_range("data_value")))


def v4_knowledge_range(knowledge: DataFrame) -> DataFrame:
    return _report(knowledge, v4_knowledge_range=F.count_if(out_of_range("data_value")))


def v5_negative_wages(wages: DataFrame) -> DataFrame:
    return _report(wages, v5_negative_wages=F.count_if(F.col("annual_median_wage") < 0))


def v6_orphan_skills(dim: DataFrame, skills: DataFrame) -> DataFrame:
    """Skill rows whose code has no occupation (NULL codes count as orphans)."""
    per_code = skills.groupBy(CODE).agg(F.count(F.lit(1)).alias("_rows"))
    orphans = per_code.join(dim.select(CODE).distinct(), CODE, "left_anti")
    return _report(orphans, v6_orphan_skills=F.sum("_rows"))


def skill_checks(dim: DataFrame, skills: DataFrame) -> DataFrame:
    """V3 + V6 from one pass over the skills fact.

    Skill rows are reduced once to (code, rows, out-of-range rows), then
    left-joined to the distinct dimension codes: the range check sums the
    out-of-range rows, the orphan check sums the rows of unmatched codes
    (a NULL code never matches, as in the reference's LEFT JOIN test).
    """
    per_code = skills.groupBy(CODE).agg(F.count(F.lit(1)).alias("_rows"),
                                        F.count_if(out_of_range("data_value")).alias("_bad"))
    known = dim.select(CODE).distinct().withColumn("_known", F.lit(True))
    joined = per_code.join(known, CODE, "left")
    return _report(joined,
                   v3_skills_range=F.sum("_bad"),
                   v6_orphan_skills=F.sum(F.when(F.col("_known").isNull(), F.col("_rows"))))


def validation_report(dim: DataFrame, skills: DataFrame, knowledge: DataFrame,
                      wages: DataFrame) -> DataFrame:
    """V7: all six checks as one DataFrame (check, violations, passed).

    One scan per table: dimension (V1, V2), skills (V3, V6), knowledge (V4),
    wages (V5).
    """
    parts = [
        occupation_checks(dim),
        skill_checks(dim, skills),
        v4_knowledge_range(knowledge),
        v5_negative_wages(wages),
    ]
    return reduce(DataFrame.unionByName, parts).orderBy("check")


# Declared keys and references ------------------------------------------------------
# The declared key of a table, or the grain its rows are documented to have.
KEYS = {
    "dim_occupation": ("onetsoc_code",),
    "dim_skill_element": ("element_id",),
    "fact_skills": ("onetsoc_code", "element_id", "scale_id"),
    "fact_knowledge": ("onetsoc_code", "element_id", "scale_id"),
    "fact_education": ("onetsoc_code", "element_id", "scale_id", "category"),
    "fact_tasks": ("onetsoc_code", "task_id"),
}


def _as_report(counts: DataFrame, names: list[str]) -> DataFrame:
    """One row of counts -> rows (check, violations, passed)."""
    rows = ", ".join(f"named_struct('check', '{n}', 'violations', coalesce(`{n}`, 0L), 'passed', coalesce(`{n}`, 0L) = 0)" for n in names)
    return counts.selectExpr(f"inline(array({rows}))")


def orphans(dim: DataFrame, facts: dict[str, DataFrame]) -> DataFrame:
    """Rows of every fact whose code has no occupation (a NULL code has none): one check per fact.

    All tables are reduced to (code, rows per table) in one grouped aggregate, combined map-side: one
    shuffle for any number of facts, a hot code is one row a task, and nothing is joined.
    """
    parts = [dim.selectExpr(CODE, "-1 AS t")] + [f.selectExpr(CODE, f"{i} AS t") for i, f in enumerate(facts.values())]
    counted = [f"count_if(t = {i}) AS n{i}" for i in range(len(facts))]
    per_code = (reduce(DataFrame.unionAll, parts).groupBy(CODE)
                .agg(F.expr(f"count_if(t = -1 AND {CODE} IS NOT NULL) AS known"), *[F.expr(c) for c in counted]))
    names = [f"orphans_{name}" for name in facts]
    lost = per_code.where("known = 0").agg(*[F.expr(f"sum(n{i}) AS `{name}`") for i, name in enumerate(names)])
    return _as_report(lost, names)


def unique_keys(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows beyond the first of their key, per table with a declared key or grain; a NULL is a key like any other.

    All tables go through one grouped aggregate of (table, key columns), combined map-side.
    """
    found = {t: df for t, df in tables.items() if t in KEYS}
    width = max(len(KEYS[t]) for t in found)
    parts = []
    for i, (t, df) in enumerate(found.items()):
        keys = [*KEYS[t], *[None] * (width - len(KEYS[t]))]
        parts.append(df.selectExpr(f"{i} AS t", *[f"CAST({f'`{k}`' if k else 'NULL'} AS STRING) AS k{j}" for j, k in enumerate(keys)]))
    per_key = reduce(DataFrame.unionAll, parts).groupBy("t", *[f"k{j}" for j in range(width)]).agg(F.expr("count(1) - 1 AS more"))
    names = [f"unique_{t}" for t in found]
    return _as_report(per_key.agg(*[F.expr(f"sum(CASE WHEN t = {i} THEN more END) AS `{name}`") for i, name in enumerate(names)]), names)


# Staging checks ------------------------------------------------------------------
# After cleaning, V1, V3 and V4 are zero by construction. The same checks run
# on *staging* frames - headers normalised and numbers coerced, nothing
# dropped, trimmed or clipped - show what the cleaning removed.

def stage_for_checks(raw: DataFrame, numeric: tuple[str, ...] = (), wages: bool = False) -> DataFrame:
    df = normalize_headers(raw)
    if wages:
        df = rename_wage_headers(df)
    return df.withColumns({c: coerce_numeric(c) for c in numeric if c in df.columns})


def staging_tables(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Logical raw file name -> staging frame used by the ``v*_raw`` checks."""
    return {
        "dim_occupation": stage_for_checks(raw["occupation_data"]),
        "fact_skills": stage_for_checks(raw["skills"], ("data_value",)),
        "fact_knowledge": stage_for_checks(raw["knowledge"], ("data_value",)),
        "fact_wages": stage_for_checks(raw["wages"], ("annual_median_wage",), wages=True),
    }
