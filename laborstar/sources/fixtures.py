"""Raw look-alike inputs built from the driver's Parquet tables.

The reference ships no data. These builders derive raw occupation, skill,
knowledge, education, task and wage files from the TPC-H-like tables with
row-wise expressions only (``FIXTURES.md`` section 3 defines them), so the
raw tables grow with the input and every build is a narrow, column-pruned
scan. Column names are the raw header spellings; the transforms normalise
them.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from laborstar.operators import transforms as T

CODE_HEADER = "O*NET-SOC Code"

# Element names of the first three skill lines.
SKILL_NAMES = {1: "Critical Thinking", 2: "Programming", 3: "Writing"}


# The columns of the driver's tables that the builders use. Declared, so a read
# starts no job for the file footers.
COLUMNS = {
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, l_returnflag string, "
                "l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
              "o_orderpriority string",
    "events": "event_id bigint, user_id bigint, event_type string, value double",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "customer": "c_custkey bigint, c_nationkey int, c_acctbal double",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table."""
    return spark.read.schema(COLUMNS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _base_code(key: str) -> str:
    """'GG-DDDD': 22 major groups 11..53 (odd), four digits 1000..9999."""
    return f"concat(CAST(11 + 2 * ({key} % 22) AS STRING), '-', CAST(1000 + {key} % 9000 AS STRING))"


def _code(key: str) -> str:
    """Base code plus the '.01' suffix on every tenth key, else '.00'."""
    return f"concat({_base_code(key)}, CASE WHEN {key} % 10 = 8 THEN '.01' ELSE '.00' END)"


def _month_year(day: str) -> str:
    return f"concat(lpad(CAST(month({day}) AS STRING), 2, '0'), '/', CAST(year({day}) AS STRING))"


def _cents(key: str) -> str:
    """'.' followed by key % 100 as two digits."""
    return f"'.', lpad(CAST({key} % 100 AS STRING), 2, '0')"


def _whole(x: str) -> str:
    return f"CAST(CAST(floor({x}) AS BIGINT) AS STRING)"


# Logical raw file name -> driver table and its raw columns, as SQL texts (one call into Spark per table).
RAW_COLUMNS = {
    "occupation_data": ("part", {
        CODE_HEADER: f"CASE WHEN p_partkey % 50 = 49 THEN NULL WHEN p_partkey % 7 = 0 THEN concat('  ', {_code('p_partkey')}, ' ') ELSE {_code('p_partkey')} END",
        "Title": "CASE WHEN p_partkey % 41 = 40 THEN NULL ELSE concat(' ', p_name, '-', p_type, ' (', lower(p_brand), ') ') END",
        "Description": "CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE concat(' size ', CAST(p_size AS STRING), ' ') END",
    }),
    "skills": ("lineitem", {
        CODE_HEADER: _code("l_partkey"),
        "Element ID": "CASE WHEN l_orderkey % 101 = 100 THEN NULL ELSE concat('2.A.', CAST(l_linenumber AS STRING)) END",
        "Element Name": " ".join(["CASE l_linenumber", *[f"WHEN {n} THEN '{name}'" for n, name in SKILL_NAMES.items()],
                                  "ELSE concat('Skill ', CAST(l_linenumber AS STRING)) END"]),
        "Scale ID": "CASE l_returnflag WHEN 'A' THEN ' im' WHEN 'N' THEN 'IM' ELSE 'Lv ' END",
        "Data Value": "CASE WHEN l_orderkey % 97 = 0 THEN 'n/a' WHEN l_orderkey % 89 = 0 THEN '9.50' WHEN l_orderkey % 83 = 0 THEN '-1.00' "
                      f"ELSE concat(CAST(CAST(l_quantity AS INT) % 7 AS STRING), {_cents('l_orderkey')}) END",
        "Date": f"CASE WHEN l_orderkey % 61 = 0 THEN 'unknown' ELSE {_month_year('l_shipdate')} END",
    }),
    "knowledge": ("orders", {
        CODE_HEADER: _code("o_custkey"),
        "Element ID": "concat('2.C.', substring(o_orderpriority, 1, 1))",
        "Element Name": "substring(o_orderpriority, 3, 20)",
        "Scale ID": "CASE o_orderstatus WHEN 'P' THEN 'lv' ELSE 'IM' END",
        "Data Value": f"concat(CAST(CAST(floor(o_totalprice) AS BIGINT) % 9 AS STRING), {_cents('o_orderkey')})",
        "Date": _month_year("o_orderdate"),
    }),
    "education_training_experience": ("events", {
        CODE_HEADER: _code("user_id"),
        "Element ID": "'2.D.1'",
        "Element Name": "CASE WHEN event_type = 'view' THEN 'On-Site Training' ELSE 'Required Level of Education' END",
        "Scale ID": "' rl'",
        "Category": "CASE WHEN event_id % 29 = 0 THEN 'n/a' ELSE CAST(event_id % 13 AS STRING) END",
        "Data Value": f"concat({_whole('value')}, {_cents('event_id')})",
    }),
    "task_statements": ("conversations", {
        CODE_HEADER: _code("conv_id"),
        "Task ID": "conv_id * 100 + turn",
        "Task": "CASE WHEN conv_id % 23 = 22 THEN NULL ELSE concat('  ', text, ' ') END",
        "Task Type": "CASE role WHEN 'user' THEN 'Core' WHEN 'assistant' THEN 'Supplemental' END",
        "Incumbents Responding": "CASE WHEN turn % 3 = 2 THEN 'n/a' ELSE CAST(conv_id + turn AS STRING) END",
    }),
    "wages": ("customer", {
        "OCC_CODE": f"CASE WHEN c_custkey % 67 = 66 THEN NULL ELSE {_base_code('c_custkey')} END",
        "AREA_TYPE": "CASE WHEN c_nationkey % 5 = 4 THEN 2 ELSE 1 END",
        "A_MEDIAN": f"CASE WHEN c_custkey % 37 = 0 THEN '#' WHEN c_custkey % 31 = 0 THEN '*' ELSE {_whole('c_acctbal * 20')} END",
        "A_PCT10": f"CASE WHEN c_custkey % 11 = 0 THEN '*' ELSE {_whole('c_acctbal * 10')} END",
        "A_PCT90": f"CASE WHEN c_acctbal > 8000 THEN '#' ELSE {_whole('c_acctbal * 40')} END",
        "H_MEDIAN": f"CASE WHEN c_custkey % 37 = 0 THEN '#' ELSE concat(CAST(CAST(floor(c_acctbal) AS BIGINT) % 120 AS STRING), {_cents('c_custkey')}) END",
    }),
}


def raw_frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One raw table over the driver's table."""
    source, columns = RAW_COLUMNS[name]
    return read_table(spark, sf_dir, source).selectExpr(*[f"{text} AS `{c}`" for c, text in columns.items()])


# Releases of the occupations, for what compares releases: day -> number.
RELEASES = {"2021-01-01": 1, "2022-01-01": 2, "2023-01-01": 3}


def occupation_release(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    """The raw occupations of release n: some are missing, some titles change for good, some descriptions for one release only."""
    source, columns = RAW_COLUMNS["occupation_data"]
    title, description = columns["Title"], columns["Description"]
    return read_table(spark, sf_dir, source).where(f"p_partkey % 13 <> {n}").selectExpr(
        f"{columns[CODE_HEADER]} AS `{CODE_HEADER}`",
        f"CASE WHEN p_partkey % 17 = 3 AND {n} >= 2 THEN concat({title}, ' ii') ELSE {title} END AS `Title`",
        f"CASE WHEN p_partkey % 19 = 5 AND {n} = 2 THEN 'under review' WHEN p_partkey % 23 < {n} THEN 'edition {n}' ELSE {description} END AS `Description`")


class _LazyRaw(dict):
    """Logical raw file name -> raw DataFrame, each defined on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self._spark, self._sf_dir = spark, sf_dir

    def __missing__(self, name: str) -> DataFrame:
        df = self[name] = raw_frame(self._spark, self._sf_dir, name)
        return df


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Logical raw file name -> raw DataFrame (lazy)."""
    return _LazyRaw(spark, sf_dir)


class Warehouse:
    """The six cleaned tables, built lazily from the raw fixtures.

    Each attribute is an independent lazy plan (raw scan -> clean); nothing
    is cached in memory, so each query scans only the columns it needs.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, as_of: str = "2024-01-01"):
        self.spark, self.sf_dir, self.as_of = spark, sf_dir, as_of

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str, as_of: str = "2024-01-01") -> "Warehouse":
        return cls(spark, sf_dir, as_of)

    @cached_property
    def raw(self) -> dict[str, DataFrame]:
        return raw_tables(self.spark, self.sf_dir)

    @cached_property
    def dim_occupation(self) -> DataFrame:
        return T.transform_occupations(self.raw["occupation_data"])

    @cached_property
    def fact_skills(self) -> DataFrame:
        return T.transform_skills(self.raw["skills"], self.as_of)

    @cached_property
    def fact_knowledge(self) -> DataFrame:
        return T.transform_knowledge(self.raw["knowledge"], self.as_of)

    @cached_property
    def fact_education(self) -> DataFrame:
        return T.transform_education(self.raw["education_training_experience"])

    @cached_property
    def fact_tasks(self) -> DataFrame:
        return T.transform_tasks(self.raw["task_statements"])

    @cached_property
    def fact_wages(self) -> DataFrame:
        return T.transform_wages(self.raw["wages"])
