"""Warehouse storage: Parquet tables under one root.

A load writes folders of its own and then appends one row to ``versions``,
which names the folders of *all* tables. Readers look that row up once, so
they see all tables of one load or all of another, never a mixture, and a load
that fails leaves everything as it was. Superseded folders stay until their
owner deletes them; one load at a time may publish.

Tables are cut into *shelves*, disjoint ranges of occupation codes with about
equal numbers of rows, one folder each, and the rows of a shelf are
range-partitioned and sorted by the code and a second column. So every file
and row group covers a narrow range: single-code and code-prefix reads skip the
others, a code with a third of all rows is spread over several files, and a
change load rewrites only the shelves that hold a changed code.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from dataclasses import dataclass, field, replace
from functools import cached_property

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from laborstar import schemas

CLUSTER_COLUMN = "onetsoc_code"
# The column that splits a large code.
SECOND_COLUMN = {
    "dim_occupation": "title", "fact_skills": "element_id", "fact_knowledge": "element_id",
    "fact_education": "element_id", "fact_tasks": "task_id", "fact_wages": "annual_median_wage",
    "fact_skills_keyed": "element_key", "fact_knowledge_keyed": "element_key", "fact_education_keyed": "element_key",
}
ROWS_PER_SHELF = 1_000_000
MAX_SHELVES = 32            # folders that a reader lists without a job of its own
VERSION_SCHEMA = ("load string, loaded_at timestamp, tables array<struct<table:string,source:string,audit:string,"
                  "bounds:array<bigint>,shelves:array<struct<shelf:int,path:string>>>>")


@dataclass(frozen=True)
class Entry:
    """One stored table: what it was loaded from, its audit (a JSON text), the lowest codes of shelves 1, 2, ... (as numbers), and the shelves' folders."""
    table: str
    bounds: tuple[int, ...] = ()
    shelves: dict[int, str] = field(default_factory=dict)
    source: str = ""
    audit: str = ""


def manifest(spark: SparkSession, warehouse_dir: str) -> dict[str, Entry]:
    """The current version: table -> entry; empty before the first load."""
    try:
        rows = spark.read.schema(VERSION_SCHEMA).parquet(f"{warehouse_dir.rstrip('/')}/versions")
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc.getCondition() or ""):
            return {}
        raise
    last = rows.agg(F.max_by("tables", F.struct("loaded_at", "load")).alias("tables")).first()["tables"] or []
    return {t["table"]: Entry(t["table"], tuple(t["bounds"]), {s["shelf"]: s["path"] for s in t["shelves"]}, t["source"], t["audit"]) for t in last}


def publish(spark: SparkSession, warehouse_dir: str, entries: dict[str, Entry]) -> None:
    """Make these entries, and those of all other tables as they are, the current version."""
    whole = manifest(spark, warehouse_dir) | entries
    tables = [(e.table, e.source, e.audit, list(e.bounds), sorted(e.shelves.items())) for e in whole.values()]
    row = spark.createDataFrame([(uuid.uuid4().hex, None, tables)], VERSION_SCHEMA).coalesce(1)
    row.withColumn("loaded_at", F.current_timestamp()).write.mode("append").parquet(f"{warehouse_dir.rstrip('/')}/versions")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder that all executors see: under ``spark.checkpoint.dir``; a local one only where Spark is local too."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="laborstar-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def code_number(code: str = CLUSTER_COLUMN) -> str:
    """SQL text: a number that orders codes by their first seven bytes; -1 for NULL."""
    return f"coalesce(CAST(conv(rpad(hex(substring(CAST(`{code}` AS BINARY), 1, 7)), 14, '0'), 16, 10) AS BIGINT), -1L)"


def shelf_of(bounds: tuple[int, ...]) -> Column:
    """The shelf of a row: how many bounds are at or below its code. The code's number is made once a row, not once a bound."""
    counted = f"CAST(size(filter(array({', '.join(f'{b}L' for b in bounds)}), b -> b <= n)) AS INT)"
    return F.expr(f"transform(array({code_number()}), n -> {counted})[0]" if bounds else "0")


def shelf_bounds(df: DataFrame, rows: int, rows_per_shelf: int) -> tuple[int, ...]:
    """Codes (as numbers) that cut the table into about equal shelves of ``rows_per_shelf`` rows, at most MAX_SHELVES."""
    n = min(MAX_SHELVES, -(-rows // rows_per_shelf))
    if n < 2:
        return ()
    steps = ", ".join(f"{i / n}D" for i in range(1, n))
    cuts = df.selectExpr(f"approx_percentile({code_number()}, array({steps}), 10000) AS cuts").first()["cuts"] or []
    return tuple(sorted(set(cuts)))


def write_shelves(df: DataFrame, warehouse_dir: str, table: str, bounds: tuple[int, ...] = ()) -> dict[int, str]:
    """Write the rows into a new folder, one sub-folder per shelf; readers do not see it before ``publish``."""
    path = f"{table}/v-{uuid.uuid4().hex}"
    if table in SECOND_COLUMN:
        keys = [CLUSTER_COLUMN, SECOND_COLUMN[table]]
        # After the exchange: the pass that samples the ranges needs no shelves, and a table in few files has few tasks before it.
        df = df.repartitionByRange(*keys).withColumn("shelf", shelf_of(bounds)).sortWithinPartitions("shelf", *keys)
    else:
        df = df.withColumn("shelf", F.lit(0))
    folder = f"{warehouse_dir.rstrip('/')}/{path}"
    df.write.mode("errorifexists").partitionBy("shelf").parquet(folder)
    # A table without rows has no shelf and so no file to list.
    found = df.sparkSession.read.schema("shelf int").parquet(folder).inputFiles()
    return {n: f"{path}/shelf={n}" for n in {int(m[1]) for m in (re.search(r"/shelf=(\d+)/", f) for f in found) if m}}


def write_table(df: DataFrame, warehouse_dir: str, table: str, rows_per_shelf: int = ROWS_PER_SHELF) -> Entry:
    """Replace one warehouse table."""
    bounds = shelf_bounds(df, df.count(), rows_per_shelf) if table in SECOND_COLUMN else ()
    entry = Entry(table, bounds, write_shelves(df, warehouse_dir, table, bounds))
    publish(df.sparkSession, warehouse_dir, {table: entry})
    return entry


def table_paths(warehouse_dir: str, entry: Entry) -> list[str]:
    """Folders of a stored table, in code order."""
    return [f"{warehouse_dir.rstrip('/')}/{path}" for _, path in sorted(entry.shelves.items())]


def read_entry(spark: SparkSession, warehouse_dir: str, entry: Entry) -> DataFrame:
    """One stored table, with its contract schema."""
    schema = schemas.TABLES[entry.table]
    paths = table_paths(warehouse_dir, entry)
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def changed_shelves(old: Entry, changes: DataFrame) -> set[int]:
    """Shelves that hold a changed code (at most MAX_SHELVES)."""
    return {r["s"] for r in changes.select(shelf_of(old.bounds).alias("s")).distinct().collect()}


def replace_shelves(new: DataFrame, warehouse_dir: str, old: Entry, hit: set[int]) -> Entry:
    """The entry after rewriting the hit shelves from the new rows; the other shelves keep their files."""
    kept = {s: p for s, p in old.shelves.items() if s not in hit}
    if hit:
        rows = new if len(hit) > len(old.bounds) else new.where(shelf_of(old.bounds).isin(*hit))
        kept |= write_shelves(rows, warehouse_dir, old.table, old.bounds)
    return replace(old, shelves=kept)


class StoredWarehouse:
    """The stored tables under a warehouse root (same attributes as the fixture one), all of one version."""

    def __init__(self, spark: SparkSession, warehouse_dir: str):
        self.spark, self.root = spark, warehouse_dir

    @cached_property
    def entries(self) -> dict[str, Entry]:
        """The version this object reads, looked up once."""
        return manifest(self.spark, self.root)

    def __getattr__(self, table: str) -> DataFrame:
        if table in schemas.TABLES:
            if table not in self.entries:
                raise LookupError(f"{table} is not stored under {self.root}")
            return read_entry(self.spark, self.root, self.entries[table])
        raise AttributeError(table)

    def register_views(self, tables=None) -> list[str]:
        """Expose the stored tables to ``spark.sql`` under their table names.

        Tables not present under the root are skipped; the registered names
        are returned.
        """
        registered = [t for t in tables or schemas.TABLES if t in self.entries]
        for table in registered:
            getattr(self, table).createOrReplaceTempView(table)
        return registered
