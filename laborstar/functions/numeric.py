"""Numeric scalar functions and the AVG snap.

ANSI mode is on in Spark 4, so a plain ``cast`` of a bad string throws; all
coercions here use ``try_cast`` behind a number-shape test.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from laborstar.functions._util import as_col

# Decimal number with optional sign, fraction and exponent, blanks allowed
# around it. Rejects what Spark's cast would accept but a missing-value rule
# must not: 'NaN', 'Infinity', '1d', '1f'.
_NUMBER_SHAPE = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

# Precision used to snap a floating average before SQL rounding, so that
# the summation order (which differs between engines and partitionings)
# cannot move a value across a rounding tie.
_SNAP = "decimal(38,12)"


# Decimal exponent limit of the reference reader: text whose written
# exponent, less its fraction digits, exceeds it is out of range (missing),
# as is any text whose value overflows to infinity.
_MAX_DECIMAL_EXPONENT = 308


def parsed_sql(x: str) -> str:
    """First half of C9 as SQL text over the SQL text ``x``: number-shaped text -> double, not yet known to be finite."""
    scale = (f"TRY_CAST(regexp_extract({x}, r'[eE]([+-]?\\d+)', 1) AS DOUBLE) - length(regexp_extract({x}, r'\\.(\\d*)', 1))")
    return (f"CASE WHEN {x} RLIKE r'{_NUMBER_SHAPE}' AND (NOT (contains({x}, 'e') OR contains({x}, 'E')) "
            f"OR coalesce({scale} <= {_MAX_DECIMAL_EXPONENT}, false)) THEN TRY_CAST({x} AS DOUBLE) END")


def finite_sql(v: str) -> str:
    """Second half of C9: an overflow is missing."""
    return f"CASE WHEN abs({v}) < double('Infinity') THEN {v} END"


def text_of(name: str) -> str:
    """SQL text of a column as a string."""
    return f"CAST(`{name}` AS STRING)"


def coerce_numeric(name: str) -> Column:
    """Text -> double; anything not shaped like a number -> NULL.

    Out-of-range text (an overflowing value, or an exponent beyond the
    reader's decimal range) is missing as well, never +/-Infinity.
    """
    return F.expr(finite_sql(parsed_sql(text_of(name))))


def clip_sql(x: str, lo: float, hi: float) -> str:
    """C10 over SQL text. ``least``/``greatest`` skip NULLs, so the guard is required."""
    return f"CASE WHEN {x} IS NOT NULL THEN least(greatest({x}, {float(lo)}D), {float(hi)}D) END"


def clip(x, lo: float, hi: float) -> Column:
    """Clamp to [lo, hi]; a missing value stays missing."""
    x = as_col(x)
    return F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(float(lo))), F.lit(float(hi))))


def round_value(x, digits: int = 2) -> Column:
    """C11: round half to even (load-time rounding)."""
    return F.bround(as_col(x), digits)


def int_sql(v: str, default: int | None = None) -> str:
    """C13 over the SQL text of a number."""
    return f"TRY_CAST({v if default is None else f'coalesce({v}, {float(default)}D)'} AS INT)"


def coerce_int(name: str, default: int | None = None) -> Column:
    """Number -> int, truncating toward zero; bad -> ``default`` (NULL); too large -> NULL."""
    return F.expr(int_sql(finite_sql(parsed_sql(text_of(name))), default))


def sql_round(x, digits: int) -> Column:
    """C14: SQL ROUND, half away from zero."""
    return F.round(as_col(x), digits)


def snap_round(x, digits: int) -> Column:
    """ROUND(value, n) applied to an average: snap to 12 decimals first.

    A value too large for the snap (1e26 and more, or infinite) has no such
    decimals; it is rounded as it is.
    """
    x = as_col(x)
    return F.coalesce(F.round(x.try_cast(_SNAP), digits).cast("double"), F.round(x, digits))
