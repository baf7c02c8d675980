"""Warehouse table contracts.

One ``StructType`` per table. ``conform`` is the contract projection: a
fixed, ordered column list with fixed types, failing on a missing column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


# Names, order and types of the columns are the contract.

def _schema(*fields) -> StructType:
    return StructType([StructField(name, typ, True) for name, typ in fields])


DIM_OCCUPATION = _schema(
    ("onetsoc_code", StringType()),
    ("title", StringType()),
    ("description", StringType()),
    ("soc_major_group", StringType()),
)

_ELEMENT_FACT = (
    ("onetsoc_code", StringType()),
    ("element_id", StringType()),
    ("element_name", StringType()),
    ("scale_id", StringType()),
    ("data_value", DoubleType()),
    ("date_updated", TimestampType()),
)

FACT_SKILLS = _schema(*_ELEMENT_FACT)
FACT_KNOWLEDGE = _schema(*_ELEMENT_FACT)

FACT_EDUCATION = _schema(
    ("onetsoc_code", StringType()),
    ("element_id", StringType()),
    ("element_name", StringType()),
    ("scale_id", StringType()),
    ("category", IntegerType()),
    ("data_value", DoubleType()),
)

FACT_TASKS = _schema(
    ("onetsoc_code", StringType()),
    ("task_id", StringType()),
    ("task", StringType()),
    ("task_type", StringType()),
    ("incumbents_responding", IntegerType()),
)

FACT_WAGES = _schema(
    ("onetsoc_code", StringType()),
    ("annual_median_wage", DoubleType()),
    ("annual_10th_pct", DoubleType()),
    ("annual_90th_pct", DoubleType()),
    ("hourly_median_wage", DoubleType()),
    ("wage_year", IntegerType()),
)

DIM_SKILL_ELEMENT = _schema(
    ("element_id", StringType()),
    ("element_name", StringType()),
)

TABLES = {
    "dim_occupation": DIM_OCCUPATION,
    "fact_skills": FACT_SKILLS,
    "fact_knowledge": FACT_KNOWLEDGE,
    "fact_education": FACT_EDUCATION,
    "fact_tasks": FACT_TASKS,
    "fact_wages": FACT_WAGES,
    "dim_skill_element": DIM_SKILL_ELEMENT,
}


# The scored facts by keys, and the dimensions they refer to; optional tables of a warehouse.
DIM_ELEMENT = _schema(("element_key", LongType()), ("element_id", StringType()), ("element_name", StringType()))
DIM_SCALE = _schema(("scale_key", LongType()), ("scale_id", StringType()))
_KEYS = (("onetsoc_code", StringType()), ("element_key", LongType()), ("scale_key", LongType()))
_KEYED_ELEMENT = _schema(*_KEYS, ("data_value", DoubleType()), ("date_updated", TimestampType()))
TABLES |= {
    "dim_element": DIM_ELEMENT, "dim_scale": DIM_SCALE, "fact_skills_keyed": _KEYED_ELEMENT, "fact_knowledge_keyed": _KEYED_ELEMENT,
    "fact_education_keyed": _schema(*_KEYS, ("category", IntegerType()), ("data_value", DoubleType())),
}


class ContractError(ValueError):
    pass


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select the contract columns in order, typed; fail if one is missing."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ContractError(f"missing required column(s) {missing}; have {df.columns}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
