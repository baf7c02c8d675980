"""Analytical queries over the star schema.

Plans are written for fact tables far larger than memory and for codes
that may carry a third of all rows:

* Facts are **pre-aggregated by occupation code before any join**
  (sum / count / max / min per code). Spark computes these partially on the
  map side, so what crosses the network is about one row per code per
  task, and a hot code collapses to one row before the shuffle. The joins
  then run on per-code summaries; the SQL multiplicities of the reference
  are restored exactly by weighting each code with the number of matching
  dimension / wage rows.
* Top-k queries shrink each input to a provably sufficient top-k **before**
  any fan-out join, so no many-to-many product is ever materialised.
* Broadcast only what has a proven bound: the outputs of a top-k (at most
  k or k * k rows, with k checked) are broadcast explicitly; every other join is left to AQE, which
  broadcasts a side only when its measured runtime size is under
  ``spark.sql.adaptive.autoBroadcastJoinThreshold`` and otherwise keeps a
  shuffle join with skewed partitions split.

Result order and ties: the reference sorts without tie-breaks, so every
query adds deterministic ones (SURVEY 2.9); NULL placement is explicit.
Averages are rounded through a 12-decimal snap so summation order cannot
move a value across a rounding tie.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from laborstar.functions import education_label, education_label_short, snap_round, sql_round

CODE = "onetsoc_code"
IMPORTANCE = "IM"

# Parameters of the published queries.
CRITICAL_THINKING = "Critical Thinking"
REQUIRED_EDUCATION = "Required Level of Education"
MAJORITY_SHARE = 50
TECH_GROUP = "15"
PROFILE_CODE = "15-1252.00"
TOP_K = 10
MAX_K = 1_000        # k * k rows may be broadcast


def _checked(k: int) -> int:
    if not 1 <= k <= MAX_K:
        raise ValueError(f"k must be between 1 and {MAX_K}, not {k}")
    return k


def _one() -> Column:
    return F.count(F.lit(1))


def _bounded(df: DataFrame) -> DataFrame:
    """Broadcast a frame whose size is proven small: the output of a top-k."""
    return F.broadcast(df)


def top_per_code(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first k rows of every code under ``order``.

    ``row_number() <= k`` over a code window is planned with a partial
    group limit before the shuffle, so a code holding a third of all rows
    still sends at most k rows per task.
    """
    w = Window.partitionBy(CODE).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k).drop("_rank")


def _weighted_avg(total: str, count: str, weight: Column) -> Column:
    """AVG over the expanded join = sum(w * per-code sum) / sum(w * per-code count).

    Weights are applied in double precision: the expanded row count of a hot
    code times many duplicate rows may exceed a 64-bit integer, and only the
    ratio is needed.
    """
    w = weight.cast("double")
    return F.try_divide(F.sum(F.col(total) * w), F.sum(F.col(count).cast("double") * w))


def _code_multiplicity(dim: DataFrame, *extra: str) -> DataFrame:
    """Dimension rows per code (1 for a clean dimension; kept exact anyway)."""
    return dim.groupBy(CODE, *extra).agg(_one().alias("_dim_rows"))


# J1 / J2 -----------------------------------------------------------------

def join_inner(dim: DataFrame, wages: DataFrame) -> DataFrame:
    """Occupations with their wage rows (AQE may split a skewed side)."""
    return dim.join(wages, CODE).select(CODE, "title", "annual_median_wage")


def join_left_wages(dim: DataFrame, wages: DataFrame) -> DataFrame:
    """Every occupation with its wage rows; NULL wage when it has none.

    A left outer join can only have its preserved side split for skew, so a
    code holding a third of the wage rows would be joined by one task. The
    same rows come from the inner join (splittable on either side) plus the
    occupations without any wage row: an anti-join against the distinct wage
    codes (combined map-side), padded with a NULL wage. A NULL code never
    matches, so it lands in the second part, as in the outer join.
    """
    unmatched = (dim.join(wages.select(CODE).distinct(), CODE, "left_anti")
                 .select(CODE, "title", F.lit(None).cast("double").alias("annual_median_wage")))
    return join_inner(dim, wages).unionByName(unmatched)


# Q1 / R1 -----------------------------------------------------------------

def q1_top_paying(dim: DataFrame, wages: DataFrame, k: int = TOP_K) -> DataFrame:
    """Best-paid occupations: dim x wages, top k by median annual wage.

    Each output row is one wage row times one dimension row of its code, and
    the sort keys of the wage row come first. So the top k wage rows among
    codes present in the dimension already hold every wage row of the answer.
    Wages are cut to k rows per code first (map-side), so a code with a third
    of all rows sends at most k rows per task to the semi-join. The k wage
    rows are then broadcast to the dimension: a dimension row meets at most
    k of them, and every task keeps its best k.
    """
    k = _checked(k)
    spread = (F.col("annual_90th_pct") - F.col("annual_10th_pct")).alias("wage_spread")
    keys = (F.col("annual_median_wage").desc_nulls_last(), F.col("hourly_median_wage").desc_nulls_last(),
            F.col("wage_spread").desc_nulls_last())
    wage_order = (keys[0], F.col(CODE).asc_nulls_first(), *keys[1:])
    top_wages = (top_per_code(wages.select(CODE, "annual_median_wage", "hourly_median_wage", spread), k, *keys)
                 .join(dim.select(CODE).distinct(), CODE, "left_semi")
                 .orderBy(*wage_order).limit(k))
    return (dim.select(CODE, "title", "soc_major_group").join(_bounded(top_wages), CODE)
            .select(CODE, "title", "soc_major_group", "annual_median_wage", "hourly_median_wage", "wage_spread")
            .orderBy(*wage_order, F.col("title").asc_nulls_first())
            .limit(k))


def r1_top_paying(dim: DataFrame, wages: DataFrame, k: int = TOP_K) -> DataFrame:
    return q1_top_paying(dim, wages, k).select("title", "annual_median_wage", "hourly_median_wage", "wage_spread")


# Q2 / R2 -----------------------------------------------------------------

def _score_summary(fact: DataFrame, *keys: str) -> DataFrame:
    """Per-key sum, count, max and min of data_value (partial agg map-side)."""
    v = F.col("data_value")
    return fact.groupBy(*keys).agg(
        F.sum(v).alias("_sum"), F.count(v).alias("_n"), F.max(v).alias("_max"), F.min(v).alias("_min"))


def q2_skill_by_group(dim: DataFrame, skills: DataFrame) -> DataFrame:
    """Skill importance per SOC major group."""
    per_code = _score_summary(skills.where(F.col("scale_id") == IMPORTANCE), CODE)
    joined = per_code.join(_code_multiplicity(dim, "soc_major_group"), CODE)
    w = F.col("_dim_rows")
    # (code, group) pairs are unique after the two aggregations, so a row
    # count per group is COUNT(DISTINCT code).
    return (joined.groupBy("soc_major_group")
            .agg(_one().alias("occupation_count"),
                 snap_round(_weighted_avg("_sum", "_n", w), 2).alias("avg_skill_importance"),
                 sql_round(F.max("_max"), 2).alias("max_skill_importance"),
                 sql_round(F.min("_min"), 2).alias("min_skill_importance"))
            .orderBy(F.col("avg_skill_importance").desc_nulls_last(), F.col("soc_major_group").desc_nulls_last()))


def r2_skill_by_group(dim: DataFrame, skills: DataFrame) -> DataFrame:
    return q2_skill_by_group(dim, skills).select("soc_major_group", "occupation_count", "avg_skill_importance")


# Q3 / R3 -----------------------------------------------------------------

def q3_critical_thinking(dim: DataFrame, skills: DataFrame, wages: DataFrame,
                         element: str = CRITICAL_THINKING, k: int = TOP_K) -> DataFrame:
    """Occupations where one skill matters most, with their wage (left join).

    Every output row of a (code, score) skill group shares that group's sort
    key, so the top k rows come from the first k groups, and no group needs
    more than k copies. The plan therefore aggregates the skill rows to
    (code, score) counts map-side, keeps the groups whose code is in the
    dimension (semi-join), takes the top k groups, re-expands each to
    min(count, k) rows and broadcasts them to the dimension. The wages are
    cut to their first k rows per code; the final top-k keeps k rows a task.
    """
    k = _checked(k)
    s = skills.where((F.col("element_name") == element) & (F.col("scale_id") == IMPORTANCE))
    top_groups = (s.groupBy(CODE, "data_value").agg(_one().alias("_rows"))
                  .join(dim.select(CODE).distinct(), CODE, "left_semi")
                  .orderBy(F.col("data_value").desc_nulls_last(), F.col(CODE).asc_nulls_first())
                  .limit(k)
                  .select(CODE, "data_value",
                          F.explode(F.sequence(F.lit(1), F.least(F.col("_rows"), F.lit(k)).cast("int")))
                          .alias("_copy")))
    codes = _bounded(top_groups.select(CODE))   # <= k*k rows; repeats are harmless in a semi-join
    pay = top_per_code(wages.select(CODE, "annual_median_wage").join(codes, CODE, "left_semi"),
                       k, F.col("annual_median_wage").desc_nulls_last())
    rows = dim.select(CODE, "title").join(_bounded(top_groups), CODE).join(_bounded(pay), CODE, "left")   # k codes, k wages each
    return (rows.select("title", CODE, F.lit(element).alias("element_name"),
                        F.col("data_value").alias("importance_score"), "annual_median_wage")
            .orderBy(F.col("importance_score").desc_nulls_last(), F.col(CODE).asc_nulls_first(),
                     F.col("annual_median_wage").desc_nulls_last(), F.col("title").asc_nulls_first())
            .limit(k))


def r3_critical_thinking(dim: DataFrame, skills: DataFrame, wages: DataFrame, k: int = TOP_K) -> DataFrame:
    return q3_critical_thinking(dim, skills, wages, CRITICAL_THINKING, k).select(
        "title", "importance_score", "annual_median_wage")


# Q4 / R4 -----------------------------------------------------------------

def _wage_summary(wages: DataFrame) -> DataFrame:
    a, h = F.col("annual_median_wage"), F.col("hourly_median_wage")
    return wages.groupBy(CODE).agg(F.sum(a).alias("_sa"), F.count(a).alias("_na"),
                                   F.sum(h).alias("_sh"), F.count(h).alias("_nh"))


def _education_by_wage(dim: DataFrame, education: DataFrame, wages: DataFrame,
                       min_share: float | None) -> DataFrame:
    """Per education category: joined codes and weighted wage sums.

    fact_education x dim x wages is many-to-many per code (wage rows are not
    de-duplicated); AVG weights every joined row. Each side is reduced to
    per-code counts / sums first, and a (code, category) group contributes
    education_rows x dim_rows x (wage sum, wage count).
    """
    e = education.where(F.col("element_name") == REQUIRED_EDUCATION)
    if min_share is not None:
        e = e.where(F.col("data_value") > min_share)
    per_code = e.groupBy(CODE, "category").agg(_one().alias("_edu_rows"))
    joined = per_code.join(_code_multiplicity(dim), CODE).join(_wage_summary(wages), CODE)
    w = F.col("_edu_rows").cast("double") * F.col("_dim_rows").cast("double")
    return joined.groupBy("category").agg(
        _one().alias("occupations"),     # (code, category) unique -> distinct codes
        snap_round(_weighted_avg("_sa", "_na", w), 0).alias("avg_median_wage"),
        snap_round(_weighted_avg("_sh", "_nh", w), 2).alias("avg_hourly_wage"))


def q4_wage_by_education(dim: DataFrame, education: DataFrame, wages: DataFrame,
                         min_share: float = MAJORITY_SHARE) -> DataFrame:
    g = _education_by_wage(dim, education, wages, min_share)
    return (g.select(F.col("category").alias("education_level_code"),
                     education_label("category").alias("education_label"),
                     "occupations", "avg_median_wage", "avg_hourly_wage")
            .orderBy(F.col("education_level_code").asc_nulls_first()))


def r4_wage_by_education(dim: DataFrame, education: DataFrame, wages: DataFrame) -> DataFrame:
    """Runner variant: no majority filter, short labels with 'Other', no hourly."""
    g = _education_by_wage(dim, education, wages, None)
    return (g.select(F.col("category").alias("edu_code"),
                     education_label_short("category").alias("education_label"),
                     "occupations", "avg_median_wage")
            .orderBy(F.col("edu_code").asc_nulls_first()))


# Q5 / R5 -----------------------------------------------------------------

def q5_tech_knowledge(dim: DataFrame, knowledge: DataFrame, group: str = TECH_GROUP) -> DataFrame:
    """Knowledge domains ranked for one SOC major group.

    Membership is decided by the dimension's group alone, through the join.
    """
    k = knowledge.where(F.col("scale_id") == IMPORTANCE)
    per_code = _score_summary(k, CODE, "element_name")
    joined = per_code.join(_code_multiplicity(dim.where(F.col("soc_major_group") == group)), CODE)
    w = F.col("_dim_rows")
    return (joined.groupBy("element_name")
            .agg(_one().alias("occupation_count"),  # (code, element) unique
                 snap_round(_weighted_avg("_sum", "_n", w), 2).alias("avg_importance"),
                 sql_round(F.max("_max"), 2).alias("max_importance"))
            .select(F.col("element_name").alias("knowledge_domain"), "occupation_count",
                    "avg_importance", "max_importance")
            .orderBy(F.col("avg_importance").desc_nulls_last(), F.col("knowledge_domain").desc_nulls_last()))


def r5_tech_knowledge(dim: DataFrame, knowledge: DataFrame, group: str = TECH_GROUP) -> DataFrame:
    return q5_tech_knowledge(dim, knowledge, group).select(
        "knowledge_domain", F.col("occupation_count").alias("occ_count"), "avg_importance")


# Q6 ----------------------------------------------------------------------

def q6_occupation_profile(dim: DataFrame, wages: DataFrame, skills: DataFrame, knowledge: DataFrame,
                          code: str = PROFILE_CODE, k: int = TOP_K) -> DataFrame:
    """Profile of one occupation: its top skill x knowledge pairs.

    The reference joins every skill row with every knowledge row of the
    code and then keeps k. Every sort key belongs to exactly one side, so a
    row whose skill is outside that side's own top k is preceded by at least
    k rows that differ only in the skill - the same holds for knowledge,
    wages and dimension rows. Each of the four sides is therefore cut to its
    own top k first (a distributed top-k over a code filter). The sides are
    joined one after the other in the order of their sort keys and cut to k
    after every join, so no join sees more than k * k rows.
    """
    k = _checked(k)

    def top(df: DataFrame, *order: Column) -> DataFrame:
        return df.orderBy(*order).limit(k)

    s = top(skills.where((F.col(CODE) == code) & (F.col("scale_id") == IMPORTANCE))
            .select(CODE, F.col("element_name").alias("top_skill"),
                    F.col("data_value").alias("skill_importance")),
            F.col("skill_importance").desc_nulls_last(), F.col("top_skill").asc_nulls_first())
    kn = top(knowledge.where((F.col(CODE) == code) & (F.col("scale_id") == IMPORTANCE))
             .select(CODE, F.col("element_name").alias("top_knowledge"),
                     F.col("data_value").alias("knowledge_importance")),
             F.col("knowledge_importance").desc_nulls_last(), F.col("top_knowledge").asc_nulls_first())
    o = top(dim.where(F.col(CODE) == code).select(CODE, "title", "description"),
            F.col("title").asc_nulls_first(), F.col("description").asc_nulls_first())
    w = top(wages.where(F.col(CODE) == code).select(CODE, "annual_median_wage", "hourly_median_wage"),
            F.col("annual_median_wage").desc_nulls_last(), F.col("hourly_median_wage").desc_nulls_last())
    by_skill = (F.col("skill_importance").desc_nulls_last(), F.col("knowledge_importance").desc_nulls_last(),
                F.col("top_skill").asc_nulls_first(), F.col("top_knowledge").asc_nulls_first())
    by_wage = (*by_skill, F.col("annual_median_wage").desc_nulls_last(), F.col("hourly_median_wage").desc_nulls_last())
    found = top(s.join(_bounded(kn), CODE), *by_skill)
    found = top(found.join(_bounded(w), CODE), *by_wage)
    return top(found.join(_bounded(o), CODE), *by_wage, F.col("title").asc_nulls_first(), F.col("description").asc_nulls_first()).select(
        "title", "description", "annual_median_wage", "hourly_median_wage",
        "top_skill", "skill_importance", "top_knowledge", "knowledge_importance")
