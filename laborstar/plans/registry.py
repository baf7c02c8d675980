"""Registered queries: key -> (spark, sf_dir) -> DataFrame.

Every callable reads the driver tables under ``sf_dir``, derives the raw
occupational inputs from them (``sources.fixtures``), cleans them and runs
one operator or query. Nothing is sampled, capped or filtered by id.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laborstar import functions as fn
from laborstar.operators import cleaning, dimensions, headers, history, releases
from laborstar.operators import transforms as T
from laborstar.operators import validation as V
from laborstar.operators.audit import load_audit, load_losses
from laborstar.plans import marts
from laborstar.sources import fixtures as fx
from laborstar.sources.fixtures import Warehouse
from laborstar.sources.warehouse import (StoredWarehouse, changed_shelves, publish, replace_shelves, shared_folder, write_table)

# Occupation code of the profile query (Q6) that exists in the fixtures at
# every scale (FIXTURES.md section 3); the published default is not there.
FIXTURE_PROFILE_CODE = "15-1002.00"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A raw fixture table (defined once per session and folder)."""
    return Warehouse.of(spark, sf_dir).raw[name]


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


# Analytical queries ------------------------------------------------------------

@register("q1_top_paying")
def q1(spark, sf_dir):
    w = Warehouse.of(spark, sf_dir)
    return marts.q1_top_paying(w.dim_occupation, w.fact_wages)


@register("q2_skill_by_group")
def q2(spark, sf_dir):
    w = Warehouse.of(spark, sf_dir)
    return marts.q2_skill_by_group(w.dim_occupation, w.fact_skills)


@register("q3_critical_thinking")
def q3(spark, sf_dir):
    w = Warehouse.of(spark, sf_dir)
    return marts.q3_critical_thinking(w.dim_occupation, w.fact_skills, w.fact_wages)


@register("q4_wage_by_education")
def q4(spark, sf_dir):
    w = Warehouse.of(spark, sf_dir)
    return marts.q4_wage_by_education(w.dim_occupation, w.fact_education, w.fact_wages)


@register("q5_tech_knowledge")
def q5(spark, sf_dir):
    w = Warehouse.of(spark, sf_dir)
    return marts.q5_tech_knowledge(w.dim_occupation, w.fact_knowledge)


@register("q6_occupation_profile")
def q6(spark, sf_dir):
    w = Warehouse.of(spark, sf_dir)
    return marts.q6_occupation_profile(w.dim_occupation, w.fact_wages, w.fact_skills, w.fact_knowledge,
                                       code=FIXTURE_PROFILE_CODE)


@register("r1_top_paying")
def r1(spark, sf_dir):
    w = Warehouse.of(spark, sf_dir)
    return marts.r1_top_paying(w.dim_occupation, w.fact_wages)


@register("r2_skill_by_group")
def r2(spark, sf_dir):
    w = Warehouse.of(spark, sf_dir)
    return marts.r2_skill_by_group(w.dim_occupation, w.fact_skills)


@register("r3_critical_thinking")
def r3(spark, sf_dir):
    w = Warehouse.of(spark, sf_dir)
    return marts.r3_critical_thinking(w.dim_occupation, w.fact_skills, w.fact_wages)


@register("r4_wage_by_education")
def r4(spark, sf_dir):
    w = Warehouse.of(spark, sf_dir)
    return marts.r4_wage_by_education(w.dim_occupation, w.fact_education, w.fact_wages)


@register("r5_tech_knowledge")
def r5(spark, sf_dir):
    w = Warehouse.of(spark, sf_dir)
    return marts.r5_tech_knowledge(w.dim_occupation, w.fact_knowledge)


# Whole cleaned tables (T1-T7) ----------------------------------------------------
# Dates are emitted as DATE so that engines agree on the value (the stored
# column stays a timestamp).

def _dated(df: DataFrame) -> DataFrame:
    return df.withColumn("date_updated", F.to_date("date_updated"))


@register("transform_occupations")
def k_transform_occupations(spark, sf_dir):
    return Warehouse.of(spark, sf_dir).dim_occupation


@register("transform_skills")
def k_transform_skills(spark, sf_dir):
    return _dated(Warehouse.of(spark, sf_dir).fact_skills)


@register("transform_knowledge")
def k_transform_knowledge(spark, sf_dir):
    return _dated(Warehouse.of(spark, sf_dir).fact_knowledge)


@register("transform_education")
def k_transform_education(spark, sf_dir):
    return Warehouse.of(spark, sf_dir).fact_education


@register("transform_tasks")
def k_transform_tasks(spark, sf_dir):
    return Warehouse.of(spark, sf_dir).fact_tasks


@register("transform_wages")
def k_transform_wages(spark, sf_dir):
    return Warehouse.of(spark, sf_dir).fact_wages


@register("dim_skill_element")
def k_dim_skill_element(spark, sf_dir):
    return T.dim_skill_element(Warehouse.of(spark, sf_dir).fact_skills)


# Sources, headers, filters, scalar functions ---------------------------------

@register("null_tokens")
def k_null_tokens(spark, sf_dir):
    raw = _raw(spark, sf_dir, "task_statements").select(
        F.col("Task ID").alias("task_id"), F.col("Incumbents Responding").alias("incumbents_responding"))
    return cleaning.null_tokens(raw, ["incumbents_responding"])


@register("normalize_headers")
def k_normalize_headers(spark, sf_dir):
    return headers.normalize_headers(_raw(spark, sf_dir, "skills"))


@register("drop_null_keys")
def k_drop_null_keys(spark, sf_dir):
    df = headers.normalize_headers(_raw(spark, sf_dir, "occupation_data"))
    return cleaning.drop_null_keys(df, ["onetsoc_code", "title"]).select("onetsoc_code", "title")


@register("drop_null_keys_skills")
def k_drop_null_keys_skills(spark, sf_dir):
    df = headers.normalize_headers(_raw(spark, sf_dir, "skills"))
    keys = ["onetsoc_code", "element_id", "element_name"]
    return cleaning.drop_null_keys(df, keys).select(*keys)


@register("optional_defaults")
def k_optional_defaults(spark, sf_dir):
    raw = _raw(spark, sf_dir, "task_statements").drop("Task Type", "Incumbents Responding")
    return T.transform_tasks(raw).select("task_id", "task_type", "incumbents_responding")


@register("optional_defaults_education")
def k_optional_defaults_education(spark, sf_dir):
    raw = _raw(spark, sf_dir, "education_training_experience").drop("Category")
    return T.transform_education(raw).select("onetsoc_code", "element_name", "category", "data_value")


@register("optional_defaults_date")
def k_optional_defaults_date(spark, sf_dir):
    raw = _raw(spark, sf_dir, "skills").drop("Date")
    return _dated(T.transform_skills(raw, as_of="2024-01-01")).select(
        "onetsoc_code", "element_id", "date_updated")


@register("fill_defaults")
def k_fill_defaults(spark, sf_dir):
    return _raw(spark, sf_dir, "occupation_data").select(
        F.col(fx.CODE_HEADER).alias("onetsoc_code"),
        fn.fill_default("Description", "").alias("description"))


@register("fill_defaults_tasks")
def k_fill_defaults_tasks(spark, sf_dir):
    return _raw(spark, sf_dir, "task_statements").select(
        F.col("Task ID").alias("task_id"),
        fn.fill_default("Task Type", T.DEFAULT_TASK_TYPE).alias("task_type"))


@register("strip_text")
def k_strip_text(spark, sf_dir):
    return _raw(spark, sf_dir, "occupation_data").select(
        F.col(fx.CODE_HEADER).alias("onetsoc_code"), fn.strip_text("Title").alias("title"))


@register("title_case")
def k_title_case(spark, sf_dir):
    return _raw(spark, sf_dir, "occupation_data").select(
        F.col(fx.CODE_HEADER).alias("onetsoc_code"),
        fn.title_case(fn.strip_text("Title")).alias("title"))


@register("normalize_soc")
def k_normalize_soc(spark, sf_dir):
    return _raw(spark, sf_dir, "occupation_data").select(
        F.col(fx.CODE_HEADER).alias("raw_code"), fn.normalize_soc(fx.CODE_HEADER).alias("onetsoc_code"))


@register("soc_group")
def k_soc_group(spark, sf_dir):
    code = fn.normalize_soc(fx.CODE_HEADER)
    return _raw(spark, sf_dir, "occupation_data").select(
        code.alias("onetsoc_code"), fn.soc_group(code).alias("soc_major_group"))


@register("normalize_scale")
def k_normalize_scale(spark, sf_dir):
    return (_raw(spark, sf_dir, "skills")
            .groupBy(F.upper(fn.strip_text("Scale ID")).alias("scale_id"))
            .agg(F.count(F.lit(1)).alias("rows")))


@register("coerce_numeric")
def k_coerce_numeric(spark, sf_dir):
    return _raw(spark, sf_dir, "skills").select(
        F.col("Data Value").alias("value_text"), fn.coerce_numeric("Data Value").alias("data_value"))


@register("clip_scale")
def k_clip_scale(spark, sf_dir):
    return _raw(spark, sf_dir, "skills").select(
        F.col("Data Value").alias("value_text"),
        fn.clip(fn.coerce_numeric("Data Value"), *T.SCORE_RANGE).alias("data_value"))


@register("clip_scale_education")
def k_clip_scale_education(spark, sf_dir):
    return _raw(spark, sf_dir, "education_training_experience").select(
        F.col("Data Value").alias("value_text"),
        fn.clip(fn.coerce_numeric("Data Value"), *T.EDUCATION_RANGE).alias("data_value"))


@register("round_value")
def k_round_value(spark, sf_dir):
    return _raw(spark, sf_dir, "education_training_experience").select(
        F.col("Data Value").alias("value_text"),
        fn.round_value(fn.clip(fn.coerce_numeric("Data Value"), *T.EDUCATION_RANGE), 2).alias("data_value"))


@register("coerce_date")
def k_coerce_date(spark, sf_dir):
    return (_raw(spark, sf_dir, "skills")
            .groupBy(F.to_date(fn.coerce_date("Date")).alias("date_updated"))
            .agg(F.count(F.lit(1)).alias("rows")))


@register("coerce_int")
def k_coerce_int(spark, sf_dir):
    return _raw(spark, sf_dir, "education_training_experience").select(
        F.col("Category").alias("category_text"), fn.coerce_int("Category").alias("category"),
        F.col("Data Value").alias("value_text"), fn.coerce_int("Data Value").alias("value_int"))


def _wage_stage(spark, sf_dir) -> DataFrame:
    return headers.rename_wage_headers(headers.normalize_headers(_raw(spark, sf_dir, "wages")))


@register("filter_national")
def k_filter_national(spark, sf_dir):
    return cleaning.filter_national(_wage_stage(spark, sf_dir)).select("onetsoc_code", "area_type")


@register("filter_detailed")
def k_filter_detailed(spark, sf_dir):
    df = _wage_stage(spark, sf_dir).where(F.col("onetsoc_code").isNotNull())
    df = df.select(fn.normalize_soc("onetsoc_code").alias("onetsoc_code"))
    return cleaning.filter_detailed(df)


@register("wage_code_suffix")
def k_wage_code_suffix(spark, sf_dir):
    df = _wage_stage(spark, sf_dir).where(F.col("onetsoc_code").isNotNull())
    return df.select(fn.wage_code_suffix(fn.normalize_soc("onetsoc_code")).alias("onetsoc_code"))


# Joins ----------------------------------------------------------------------------

@register("join_inner")
def k_join_inner(spark, sf_dir):
    w = Warehouse.of(spark, sf_dir)
    return marts.join_inner(w.dim_occupation, w.fact_wages)


@register("join_left_wages")
def k_join_left_wages(spark, sf_dir):
    w = Warehouse.of(spark, sf_dir)
    return marts.join_left_wages(w.dim_occupation, w.fact_wages)


# Validation (V1-V7) on cleaned tables and on staging frames ------------------------

def _checks(wh) -> dict[str, Callable[[], DataFrame]]:
    return {
        "v1_null_codes": lambda: V.v1_null_codes(wh["dim_occupation"]),
        "v2_null_titles": lambda: V.v2_null_titles(wh["dim_occupation"]),
        "v3_skills_range": lambda: V.v3_skills_range(wh["fact_skills"]),
        "v4_knowledge_range": lambda: V.v4_knowledge_range(wh["fact_knowledge"]),
        "v5_negative_wages": lambda: V.v5_negative_wages(wh["fact_wages"]),
        "v6_orphan_skills": lambda: V.v6_orphan_skills(wh["dim_occupation"], wh["fact_skills"]),
        "validation_report": lambda: V.validation_report(
            wh["dim_occupation"], wh["fact_skills"], wh["fact_knowledge"], wh["fact_wages"]),
    }


class _Tables(dict):
    """Lazy table lookup: builds a table plan only when a check asks for it."""

    def __init__(self, build):
        super().__init__()
        self._build = build

    def __missing__(self, key):
        return self._build(key)


def _clean_tables(spark, sf_dir):
    w = Warehouse.of(spark, sf_dir)
    return _Tables(lambda name: getattr(w, name))


def _staging_tables(spark, sf_dir):
    return V.staging_tables(Warehouse.of(spark, sf_dir).raw)


def _register_checks():
    for name in _checks({}):
        def clean_fn(spark, sf_dir, _n=name):
            return _checks(_clean_tables(spark, sf_dir))[_n]()

        def raw_fn(spark, sf_dir, _n=name):
            return _checks(_staging_tables(spark, sf_dir))[_n]()

        register(name)(clean_fn)
        raw_key = "validation_report_raw" if name == "validation_report" else name.split("_")[0] + "_raw"
        register(raw_key)(raw_fn)


_register_checks()


@register("load_audit")
def k_load_audit(spark, sf_dir):
    return load_audit(Warehouse.of(spark, sf_dir).raw, as_of="2024-01-01")


@register("load_losses")
def k_load_losses(spark, sf_dir):
    return load_losses(Warehouse.of(spark, sf_dir).raw, as_of="2024-01-01")


# Releases and dimensions over all facts ---------------------------

@register("snapshot_diff")
def k_snapshot_diff(spark, sf_dir):
    """What cleaning changed: the raw occupations (renamed only) against the dimension, by code."""
    w = Warehouse.of(spark, sf_dir)
    raw = headers.normalize_headers(w.raw["occupation_data"])
    return releases.snapshot_diff(raw.select("onetsoc_code", "title", "description"),
                                  w.dim_occupation.select("onetsoc_code", "title", "description"), ["onetsoc_code"])


@register("dim_scale")
def k_dim_scale(spark, sf_dir):
    w = Warehouse.of(spark, sf_dir)
    return releases.dim_scale(w.fact_skills, w.fact_knowledge, w.fact_education)


@register("dim_element")
def k_dim_element(spark, sf_dir):
    w = Warehouse.of(spark, sf_dir)
    return releases.dim_element(skills=w.fact_skills, knowledge=w.fact_knowledge, education=w.fact_education)


def _release(spark, sf_dir, n: int) -> DataFrame:
    """The cleaned occupations of one release."""
    return T.transform_occupations(fx.occupation_release(spark, sf_dir, n))


@register("release_diff")
def k_release_diff(spark, sf_dir):
    return releases.snapshot_diff(_release(spark, sf_dir, 1), _release(spark, sf_dir, 2), ["onetsoc_code"])


@register("change_load")
def k_change_load(spark, sf_dir):
    """The stored occupations after a load of release 2 that rewrote only the shelves whose codes changed since release 1."""
    root = shared_folder(spark, "change-load")

    def staged(n: int) -> DataFrame:
        """A release, cleaned once: shelves, ranges and comparisons read the staged rows, as in the load."""
        release, path = _release(spark, sf_dir, n), f"{root}/staging/release-{n}"
        release.write.parquet(path)
        return spark.read.schema(release.schema).parquet(path)

    first = write_table(staged(1), root, "dim_occupation", rows_per_shelf=2_000)
    old, new = StoredWarehouse(spark, root).dim_occupation, staged(2)
    hit = changed_shelves(first, releases.snapshot_diff(old, new, ["onetsoc_code"]))
    publish(spark, root, {"dim_occupation": replace_shelves(new, root, first, hit)})
    return StoredWarehouse(spark, root).dim_occupation


def _history(spark, sf_dir) -> DataFrame:
    return history.history({day: _release(spark, sf_dir, n) for day, n in fx.RELEASES.items()})


@register("history_occupations")
def k_history(spark, sf_dir):
    return _history(spark, sf_dir)


@register("as_of_occupations")
def k_as_of(spark, sf_dir):
    return history.as_of(_history(spark, sf_dir), "2022-06-30")


@register("history_changes")
def k_history_changes(spark, sf_dir):
    return history.changes(_history(spark, sf_dir), "onetsoc_code")


# Elements and scales as dimensions with keys -------------------------------------

def _dimensions(spark, sf_dir) -> tuple[dict[str, DataFrame], DataFrame, DataFrame]:
    w = Warehouse.of(spark, sf_dir)
    facts = {t: getattr(w, t) for t in dimensions.SCORED}

    def store(df: DataFrame) -> DataFrame:
        path = shared_folder(spark, "keys")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    return facts, *dimensions.dimensions(list(facts.values()), store)


@register("element_keys")
def k_element_keys(spark, sf_dir):
    return _dimensions(spark, sf_dir)[1]


@register("knowledge_by_key")
def k_knowledge_by_key(spark, sf_dir):
    facts, elements, scales = _dimensions(spark, sf_dir)
    return _dated(dimensions.by_key(facts["fact_knowledge"], elements, scales))


# Declared keys and references over all tables ---------------------------------------

FACTS = ("fact_skills", "fact_knowledge", "fact_education", "fact_tasks", "fact_wages")


@register("v_orphans_all")
def k_orphans(spark, sf_dir):
    w = Warehouse.of(spark, sf_dir)
    return V.orphans(w.dim_occupation, {f: getattr(w, f) for f in FACTS})


@register("v_unique_keys")
def k_unique_keys(spark, sf_dir):
    w = Warehouse.of(spark, sf_dir)
    return V.unique_keys({t: getattr(w, t) for t in V.KEYS if t != "dim_skill_element"} | {"dim_skill_element": T.dim_skill_element(w.fact_skills)})
