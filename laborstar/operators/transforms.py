"""Table transforms raw -> warehouse.

Each transform is split in two so the load audit can count kept and dropped
rows, and values that coercion loses, in the same pass that produces them:

* ``stage_*``: header normalisation plus every cleaned column, a boolean
  ``_keep`` that is the table's row filter evaluated on the *raw* values (the
  reference drops NULL keys before it trims anything), and a struct ``_lost``
  that says, for every column with a coercion, whether a text was there and whether
  no value came of it;
* ``finish``: ``where(_keep)`` + the contract projection, which prunes ``_lost``.

The rules are SQL texts, two projections per table: the first parses numbers, the second uses a
parsed number as often as it likes, so each text is tested and cast once. All steps are
map-only - one narrow stage per table, no shuffle, no Python on the executors -
so a table of any size is cleaned at scan speed, and the filters reach the scan
when the source supports it.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructType, TimestampNTZType, TimestampType

from laborstar import schemas
from laborstar.functions.dates import date_sql, load_date_sql
from laborstar.functions.numeric import clip_sql, finite_sql, int_sql, parsed_sql, text_of
from laborstar.functions.text import soc_sql, strip_sql, title_sql
from laborstar.operators.headers import MALFORMED, normalize_headers, rename_wage_headers

KEEP = "_keep"
LOST = "_lost"

# Score ranges and defaults of the cleaning rules.
SCORE_RANGE = (0.0, 7.0)          # skills, knowledge
EDUCATION_RANGE = (0.0, 100.0)    # education percentages
DEFAULT_TASK_TYPE = "Core"
DEFAULT_WAGE_YEAR = 2023
DETAILED_SUFFIX = ".00"
RULES = "3"                       # raised when a rule changes: a load then reads unchanged files again


def _staged(df: DataFrame, required: list[str], keep: str, values: dict[str, str],
            numbers: dict[str, str] | None = None, losses: dict[str, str] | None = None) -> DataFrame:
    """``values`` by output column over the columns of ``df`` and the parsed ``numbers`` (name -> raw column).

    ``losses``: output column -> the raw column whose text it should have a value for. A value that has a default is
    judged by the number behind it.
    """
    columns = df.columns
    missing = [c for c in required if c not in columns]
    if missing:
        raise schemas.ContractError(f"missing required column(s) {missing}; have {columns}")
    if numbers:
        df = df.selectExpr("*", *[f"{parsed_sql(text_of(c))} AS `{name}`" for name, c in numbers.items()])
    parsed = {c: numbers_value(name) for name, c in (numbers or {}).items()}
    lost = ", ".join(f"'{out}', named_struct('texts', `{raw}` IS NOT NULL, 'lost', `{raw}` IS NOT NULL AND ({parsed.get(raw, values[out])}) IS NULL)"
                     for out, raw in (losses or {}).items())
    return df.selectExpr(f"({keep}) AS {KEEP}", *[f"{text} AS `{out}`" for out, text in values.items()], f"named_struct({lost}) AS {LOST}",
                         f"{MALFORMED if MALFORMED in columns else 'false'} AS {MALFORMED}")


def numbers_value(name: str) -> str:
    """A parsed number, or NULL where it overflowed."""
    return finite_sql(f"`{name}`")


def _present(*columns: str) -> str:
    return " AND ".join(f"`{c}` IS NOT NULL" for c in columns)


def finish(staged: DataFrame, schema: StructType) -> DataFrame:
    """Apply the row filter and the contract projection."""
    return staged.where(KEEP).selectExpr(*[f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields])


def _score(name: str, lo: float, hi: float) -> str:
    """Parsed -> clipped -> rounded half-even to 2 places."""
    return f"CASE WHEN abs(`{name}`) < double('Infinity') THEN bround({clip_sql(f'`{name}`', lo, hi)}, 2) END"


# T1 ----------------------------------------------------------------------

def stage_occupations(raw: DataFrame) -> DataFrame:
    code, title = soc_sql(text_of("onetsoc_code")), strip_sql(text_of("title"))
    return _staged(normalize_headers(raw), ["onetsoc_code", "title", "description"], _present("onetsoc_code", "title"), {
        "onetsoc_code": code,
        "title": title_sql(title),
        "description": strip_sql(f"coalesce({text_of('description')}, '')"),
        "soc_major_group": f"substring({code}, 1, 2)",
    })


def transform_occupations(raw: DataFrame) -> DataFrame:
    return finish(stage_occupations(raw), schemas.DIM_OCCUPATION)


# T2 / T3 ------------------------------------------------------------------

ELEMENT_COLUMNS = ["onetsoc_code", "element_id", "element_name", "scale_id", "data_value"]


def _element(lo: float, hi: float) -> dict[str, str]:
    return {
        "onetsoc_code": soc_sql(text_of("onetsoc_code")),
        "element_id": text_of("element_id"),
        "element_name": text_of("element_name"),
        "scale_id": soc_sql(text_of("scale_id")),
        "data_value": _score("data_number", lo, hi),
    }


def stage_element_scores(raw: DataFrame, as_of=None) -> DataFrame:
    df = normalize_headers(raw)
    losses = {"data_value": "data_value"}
    if "date_updated" not in df.columns:
        date = load_date_sql(as_of)
    elif isinstance(df.schema["date_updated"].dataType, (DateType, TimestampType, TimestampNTZType)):
        date = "CAST(date_updated AS TIMESTAMP)"                # already typed
    else:
        date = date_sql(text_of("date_updated"))
        losses["date_updated"] = "date_updated"
    return _staged(df, ELEMENT_COLUMNS, _present("onetsoc_code", "element_id", "element_name"),
                   {**_element(*SCORE_RANGE), "date_updated": date}, {"data_number": "data_value"}, losses)


def transform_skills(raw: DataFrame, as_of=None) -> DataFrame:
    return finish(stage_element_scores(raw, as_of), schemas.FACT_SKILLS)


def transform_knowledge(raw: DataFrame, as_of=None) -> DataFrame:
    return finish(stage_element_scores(raw, as_of), schemas.FACT_KNOWLEDGE)


# T4 ----------------------------------------------------------------------

def stage_education(raw: DataFrame) -> DataFrame:
    df = normalize_headers(raw)
    if "category" not in df.columns:
        df = df.selectExpr("*", "CAST(NULL AS STRING) AS category")
    values = _element(*EDUCATION_RANGE)
    values = {c: values[c] for c in ELEMENT_COLUMNS[:4]} | {"category": int_sql(numbers_value("category_number"), 0), "data_value": values["data_value"]}
    return _staged(df, ELEMENT_COLUMNS, _present("onetsoc_code", "element_id"), values,
                   {"data_number": "data_value", "category_number": "category"}, {"category": "category", "data_value": "data_value"})


def transform_education(raw: DataFrame) -> DataFrame:
    return finish(stage_education(raw), schemas.FACT_EDUCATION)


# T5 ----------------------------------------------------------------------

def stage_tasks(raw: DataFrame) -> DataFrame:
    df = normalize_headers(raw)
    absent = [c for c in ("task_type", "incumbents_responding") if c not in df.columns]
    if absent:
        df = df.selectExpr("*", *[f"CAST(NULL AS STRING) AS {c}" for c in absent])
    return _staged(df, ["onetsoc_code", "task_id", "task"], _present("onetsoc_code", "task_id", "task"), {
        "onetsoc_code": soc_sql(text_of("onetsoc_code")),
        "task_id": text_of("task_id"),                         # kept as read: an id need not be a number
        "task": strip_sql(text_of("task")),
        "task_type": f"coalesce({text_of('task_type')}, '{DEFAULT_TASK_TYPE}')",
        "incumbents_responding": int_sql(numbers_value("incumbents_number"), 0),
    }, {"incumbents_number": "incumbents_responding"}, {"incumbents_responding": "incumbents_responding"})


def transform_tasks(raw: DataFrame) -> DataFrame:
    return finish(stage_tasks(raw), schemas.FACT_TASKS)


# T6 ----------------------------------------------------------------------

WAGE_COLUMNS = ("annual_median_wage", "annual_10th_pct", "annual_90th_pct", "hourly_median_wage")


def stage_wages(raw: DataFrame, wage_year: int = DEFAULT_WAGE_YEAR) -> DataFrame:
    df = rename_wage_headers(normalize_headers(raw))
    code = soc_sql(text_of("onetsoc_code"))
    national = f"coalesce({finite_sql(parsed_sql(text_of('area_type')))} = 1, false)" if "area_type" in df.columns else "true"
    keep = f"{national} AND onetsoc_code IS NOT NULL AND coalesce(right({code}, 2) <> '00', false)"
    return _staged(df, ["onetsoc_code", *WAGE_COLUMNS], keep, {
        "onetsoc_code": f"concat({code}, '{DETAILED_SUFFIX}')",
        **{c: numbers_value(f"{c}_number") for c in WAGE_COLUMNS},
        "wage_year": f"{int(wage_year)}",
    }, {f"{c}_number": c for c in WAGE_COLUMNS}, {c: c for c in WAGE_COLUMNS})


def transform_wages(raw: DataFrame, wage_year: int = DEFAULT_WAGE_YEAR) -> DataFrame:
    return finish(stage_wages(raw, wage_year), schemas.FACT_WAGES)


# T7 ----------------------------------------------------------------------

def dim_skill_element(fact_skills: DataFrame) -> DataFrame:
    """One row per element id (its smallest name), so the declared key holds.

    A grouped aggregate with map-side partial aggregation: the shuffle
    carries at most one row per element per task.
    """
    return (fact_skills.groupBy("element_id")
            .agg(F.min("element_name").alias("element_name"))
            .select(*schemas.DIM_SKILL_ELEMENT.fieldNames()))


# Registry ------------------------------------------------------------------

@dataclass(frozen=True)
class TableSpec:
    table: str                                   # warehouse table
    source: str                                  # logical raw file name
    stage: Callable[..., DataFrame]              # raw -> staged (with _keep)
    schema: StructType

    def staged(self, raw: DataFrame, as_of=None, wage_year: int = DEFAULT_WAGE_YEAR) -> DataFrame:
        if self.stage is stage_element_scores:
            return self.stage(raw, as_of)
        if self.stage is stage_wages:
            return self.stage(raw, wage_year)
        return self.stage(raw)

    def clean(self, raw: DataFrame, as_of=None, wage_year: int = DEFAULT_WAGE_YEAR) -> DataFrame:
        return finish(self.staged(raw, as_of, wage_year), self.schema)


TABLE_SPECS = (
    TableSpec("dim_occupation", "occupation_data", stage_occupations, schemas.DIM_OCCUPATION),
    TableSpec("fact_skills", "skills", stage_element_scores, schemas.FACT_SKILLS),
    TableSpec("fact_knowledge", "knowledge", stage_element_scores, schemas.FACT_KNOWLEDGE),
    TableSpec("fact_education", "education_training_experience", stage_education, schemas.FACT_EDUCATION),
    TableSpec("fact_tasks", "task_statements", stage_tasks, schemas.FACT_TASKS),
    TableSpec("fact_wages", "wages", stage_wages, schemas.FACT_WAGES),
)
