"""Load audit: columns and rows read, rows dropped, malformed and loaded per table, and values lost to coercion.

A value is lost where a row that is loaded had a text for a column and no
value came of it (``#`` for a wage, ``unknown`` for a date). Two forms:
``load_audit`` and ``load_losses``, tables of aggregates over the staged
frames, and ``watched``, which counts the same while a load writes.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from laborstar.operators.headers import MALFORMED
from laborstar.operators.transforms import DEFAULT_WAGE_YEAR, KEEP, LOST, TABLE_SPECS, TableSpec

AUDIT_SCHEMA = ("table string, columns_in int, rows_in bigint, rows_malformed bigint, rows_dropped bigint, rows_out bigint, "
                "values_lost bigint")
LOSS_SCHEMA = "table string, column string, texts bigint, lost bigint"


def columns(raw: DataFrame) -> list[str]:
    """The columns of a raw file, without the reader's flag."""
    return [c for c in raw.columns if c != MALFORMED]


def counters(staged: DataFrame) -> dict[str, str]:
    """Aggregates of the staged rows as SQL texts: rows, and per coerced column the texts and the losses of loaded rows."""
    found = {"rows_in": "count(1)", "rows_out": f"count_if({KEEP})", "rows_malformed": f"count_if({MALFORMED})"}
    lost = staged.schema[LOST].dataType
    for column in lost.fieldNames():
        for what in ("texts", "lost"):
            found[f"{what}_{column}"] = f"count_if({KEEP} AND {LOST}.`{column}`.{what})"
    return found


def _counted(spec: TableSpec, raw: DataFrame, as_of=None) -> DataFrame:
    """One row of counters of a raw frame, from one pass."""
    staged = spec.staged(raw, as_of)
    counted = staged.selectExpr(*[f"{text} AS `{name}`" for name, text in counters(staged).items()])
    return counted.selectExpr(f"'{spec.table}' AS table", f"{len(columns(raw))} AS columns_in", "*")


def load_audit(raw: dict[str, DataFrame], as_of=None) -> DataFrame:
    """(table, columns_in, rows_in, rows_malformed, rows_dropped, rows_out, values_lost) for the six warehouse tables."""
    parts = []
    for spec in TABLE_SPECS:
        one = _counted(spec, raw[spec.source], as_of)
        lost = " + ".join(["0L", *[f"`{c}`" for c in one.columns if c.startswith("lost_")]])
        parts.append(one.selectExpr("table", "columns_in", "rows_in", "rows_malformed", "rows_in - rows_out AS rows_dropped", "rows_out", f"{lost} AS values_lost"))
    return reduce(DataFrame.unionByName, parts)


def load_losses(raw: dict[str, DataFrame], as_of=None) -> DataFrame:
    """(table, column, texts, lost) for every coerced column of the warehouse tables: texts of loaded rows, and those without a value."""
    parts = []
    for spec in TABLE_SPECS:
        one = _counted(spec, raw[spec.source], as_of)
        rows = ", ".join(f"named_struct('column', '{c[6:]}', 'texts', `{c}`, 'lost', `lost_{c[6:]}`)" for c in one.columns if c.startswith("texts_"))
        if rows:
            parts.append(one.selectExpr("table", f"inline(array({rows}))"))
    return reduce(DataFrame.unionByName, parts)


class Watched:
    """The staged frame of one load, and its counters once an action has run over it.

    Rows are counted where they are written, so a raw file is read once.
    """

    def __init__(self, spec: TableSpec, raw: DataFrame, as_of=None, wage_year: int = DEFAULT_WAGE_YEAR):
        self._columns, self._made = len(columns(raw)), Observation(f"load_{uuid.uuid4().hex[:12]}")    # unique: loads run side by side
        staged = spec.staged(raw, as_of, wage_year)
        self.rows = staged.observe(self._made, *[F.expr(text).alias(n) for n, text in counters(staged).items()])

    def audit(self) -> dict[str, int]:
        return {"columns_in": self._columns, **{k: int(v) for k, v in self._made.get.items()}}


def audit_rows(audits: dict[str, dict[str, int]]) -> list[tuple]:
    """Rows of AUDIT_SCHEMA from counters by table."""
    return [(t, a["columns_in"], a["rows_in"], a["rows_malformed"], a["rows_in"] - a["rows_out"], a["rows_out"],
             sum(v for k, v in a.items() if k.startswith("lost_"))) for t, a in audits.items()]


def loss_rows(audits: dict[str, dict[str, int]]) -> list[tuple]:
    """Rows of LOSS_SCHEMA from counters by table."""
    return [(t, k[6:], v, a[f"lost_{k[6:]}"]) for t, a in audits.items() for k, v in a.items() if k.startswith("texts_")]
