"""End-to-end load: extract -> clean -> load, then validate.

For each of the six raw files: resolve and read it (all STRING), clean it
with the table's transform into a staging folder, which counts it for the
audit in the same pass, and store the table from there. So a raw file is read
and cleaned once; shelves, ranges and comparisons read the staged Parquet.
Malformed rows stop the load before anything is published, and all tables are
published together.

Three kinds of load:

* full: every table is replaced;
* restart: a raw file whose path, length and modification time are those of
  the stored table, loaded with the same parameters, is not read again;
* changes: a table is compared with the stored one by code, and only the
  shelves that hold a changed code are rewritten.

The element dimension is derived from the *stored* skills table, and the
checks run on the stored tables, so every later step starts from Parquet
rather than re-running the cleaning lineage (a lost executor only recomputes
from files).
"""

from __future__ import annotations

import json
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from laborstar.operators import transforms as T
from laborstar.operators.audit import AUDIT_SCHEMA, LOSS_SCHEMA, Watched, audit_rows, loss_rows
from laborstar.operators.releases import snapshot_diff
from laborstar.operators.validation import validation_report
from laborstar.session import configure
from laborstar.sources import files
from laborstar.sources.warehouse import (ROWS_PER_SHELF, Entry, StoredWarehouse, changed_shelves, manifest, publish, read_entry,
                                         replace_shelves, shelf_bounds, write_shelves)


@dataclass
class EtlResult:
    warehouse: StoredWarehouse
    audit: DataFrame        # AUDIT_SCHEMA
    losses: DataFrame       # LOSS_SCHEMA
    report: DataFrame       # check, violations, passed
    written: dict[str, list[int]]       # table -> shelves that this load wrote


class _Load:
    """What the loads of one run share."""

    def __init__(self, spark: SparkSession, warehouse_dir: str, as_of, wage_year: int, rows_per_shelf: int, changes: bool):
        self.spark, self.root, self.as_of, self.wage_year = spark, warehouse_dir.rstrip("/"), as_of, wage_year
        self.rows_per_shelf, self.changes = rows_per_shelf, changes
        self.old = manifest(spark, warehouse_dir)

    def parameters(self) -> str:
        return f"{T.RULES}|{self.as_of or date.today()}|{self.wage_year}"

    def stage(self, spec: T.TableSpec, raw: DataFrame) -> tuple[DataFrame, dict[str, int]]:
        """The cleaned rows, stored, and their audit."""
        watched = Watched(spec, raw, self.as_of, self.wage_year)
        path = f"{self.root}/staging/{spec.table}-{uuid.uuid4().hex}"
        T.finish(watched.rows, spec.schema).write.parquet(path)
        audit = watched.audit()
        if audit["rows_malformed"]:
            raise files.MalformedFile(f"{spec.source}: {audit['rows_malformed']} of {audit['rows_in']} rows have more fields than the header; nothing was loaded")
        return self.spark.read.schema(spec.schema).parquet(path), audit

    def table(self, spec: T.TableSpec, raw: DataFrame, source: str) -> tuple[Entry, list[int]]:
        """The entry of one table after its load, and the shelves that were written."""
        old = self.old.get(spec.table)
        if old and source and old.source == source:
            return old, []
        rows, audit = self.stage(spec, raw)
        if old and self.changes:
            hit = changed_shelves(old, snapshot_diff(read_entry(self.spark, self.root, old), rows, ["onetsoc_code"]))
            entry = replace_shelves(rows, self.root, old, hit)
        else:
            bounds = shelf_bounds(rows, audit["rows_out"], self.rows_per_shelf)
            entry = Entry(spec.table, bounds, write_shelves(rows, self.root, spec.table, bounds))
            hit = set(entry.shelves)
        return replace(entry, source=source, audit=json.dumps(audit)), sorted(hit)


def load_entries(spark: SparkSession, raw: dict[str, DataFrame], warehouse_dir: str, as_of=None,
                 wage_year: int = T.DEFAULT_WAGE_YEAR, sources: dict[str, str] | None = None,
                 changes: bool = False, rows_per_shelf: int = ROWS_PER_SHELF) -> tuple[dict[str, Entry], dict[str, list[int]]]:
    """Clean and store the raw frames and publish all tables together.

    The loads are independent jobs (no table reads another), so they are
    submitted together from a small thread pool and share the cluster; a
    small table does not wait for the largest fact to finish.
    """
    run = _Load(spark, warehouse_dir, as_of, wage_year, rows_per_shelf, changes)
    known = {name: f"{text}|{run.parameters()}" for name, text in (sources or {}).items()}
    with ThreadPoolExecutor(max_workers=len(T.TABLE_SPECS)) as pool:
        futures = [pool.submit(run.table, spec, raw[spec.source], known.get(spec.source, "")) for spec in T.TABLE_SPECS]
        loads = {spec.table: f.result() for spec, f in zip(T.TABLE_SPECS, futures)}
    entries, written = {t: e for t, (e, _) in loads.items()}, {t: w for t, (_, w) in loads.items()}
    if written["fact_skills"] or "dim_skill_element" not in run.old:
        elements = T.dim_skill_element(read_entry(spark, run.root, entries["fact_skills"]))
        entries["dim_skill_element"] = Entry("dim_skill_element", (), write_shelves(elements, run.root, "dim_skill_element"))
        written["dim_skill_element"] = [0]
    else:
        entries["dim_skill_element"], written["dim_skill_element"] = run.old["dim_skill_element"], []
    if any(written.values()):
        publish(spark, run.root, entries)                       # only after all were written
    return entries, written


def _audits(entries: dict[str, Entry]) -> dict[str, dict[str, int]]:
    return {spec.table: json.loads(entries[spec.table].audit) for spec in T.TABLE_SPECS}


def load_tables(spark: SparkSession, raw: dict[str, DataFrame], warehouse_dir: str,
                as_of=None, wage_year: int = T.DEFAULT_WAGE_YEAR) -> DataFrame:
    """Full load of raw frames; returns the load audit."""
    entries, _ = load_entries(spark, raw, warehouse_dir, as_of, wage_year)
    return spark.createDataFrame(audit_rows(_audits(entries)), AUDIT_SCHEMA)


def run_etl(spark: SparkSession, raw_dir: str, warehouse_dir: str, as_of=None, wage_year: int = T.DEFAULT_WAGE_YEAR,
            mode: str = "blocks", changes: bool = False, rows_per_shelf: int = ROWS_PER_SHELF) -> EtlResult:
    """Load the warehouse from the raw files in ``raw_dir``.

    Files that have not changed since they were loaded, with the same
    parameters, are not read again. ``changes`` rewrites only the shelves whose
    codes changed; without it the tables of changed files are replaced.
    """
    configure(spark)
    raw = {spec.source: files.extract(spark, raw_dir, spec.source, mode) for spec in T.TABLE_SPECS}
    sources = {spec.source: files.fingerprint(spark, files.resolve(spark, raw_dir, spec.source)) for spec in T.TABLE_SPECS}
    entries, written = load_entries(spark, raw, warehouse_dir, as_of, wage_year, sources, changes, rows_per_shelf)
    wh = StoredWarehouse(spark, warehouse_dir)
    report = validation_report(wh.dim_occupation, wh.fact_skills, wh.fact_knowledge, wh.fact_wages)
    audits = _audits(entries)
    return EtlResult(wh, spark.createDataFrame(audit_rows(audits), AUDIT_SCHEMA), spark.createDataFrame(loss_rows(audits), LOSS_SCHEMA), report, written)
