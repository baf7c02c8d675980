"""Date coercion."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted date layouts (month before day, as the reference's
# reader assumes).
MONTH_YEAR, US_DATE, SLASH_DATE = "M/yyyy", "M/d/yyyy", "yyyy/M/d"
ISO_DATE, ISO_TIME, YEAR_MONTH = "yyyy-M-d[ HH:mm:ss]", "yyyy-M-d'T'HH:mm:ss", "yyyy-M"
DATE_PATTERNS = (MONTH_YEAR, ISO_DATE, US_DATE, ISO_TIME, SLASH_DATE, YEAR_MONTH)


def date_sql(x: str) -> str:
    """C12 over SQL text.

    'MM/yyyy' (month precision) becomes the first of that month. The
    separators tell which layout a text can have, so every value is parsed
    at most once, and a text without separators not at all.
    """
    def parsed(pattern: str) -> str:
        quoted = pattern.replace("'", "''")
        return f"try_to_timestamp({x}, '{quoted}')"

    def count(sign: str) -> str:
        return f"length({x}) - length(replace({x}, '{sign}', ''))"

    return f"""CASE {count('/')} WHEN 1 THEN {parsed(MONTH_YEAR)}
        WHEN 2 THEN CASE WHEN length(substring_index({x}, '/', 1)) >= 4 THEN {parsed(SLASH_DATE)} ELSE {parsed(US_DATE)} END
        ELSE CASE WHEN {count('-')} = 1 THEN {parsed(YEAR_MONTH)}
                  WHEN {count('-')} >= 2 THEN CASE WHEN contains({x}, 'T') THEN {parsed(ISO_TIME)} ELSE {parsed(ISO_DATE)} END END END"""


def coerce_date(name: str) -> Column:
    """Text -> timestamp at midnight; unparsable -> NULL."""
    return F.expr(date_sql(f"CAST(`{name}` AS STRING)"))


def load_date_sql(as_of: dt.date | str | None = None) -> str:
    """C17 as SQL text."""
    return "CAST(current_date() AS TIMESTAMP)" if as_of is None else f"CAST(DATE '{as_of}' AS TIMESTAMP)"


def load_date(as_of: dt.date | str | None = None) -> Column:
    """C17: the load date used when a file has no date column.

    ``as_of`` pins it (tests, re-runs); otherwise the current date.
    """
    return F.expr(load_date_sql(as_of))
