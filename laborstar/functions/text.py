"""Text scalar functions.

All are Column -> Column built from ``pyspark.sql.functions``, so they stay
inside whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from laborstar.functions._util import as_col

# Characters removed by strip: the set Python's str.strip() removes (every
# code point with str.isspace(); all of them lie in the Basic Multilingual
# Plane). Derived by rule rather than listed.
BLANKS = "".join(ch for ch in map(chr, range(0x10000)) if ch.isspace())

# One token = a run of cased characters or a run of anything else. "Cased"
# is what Python's str.title() tests: the Lowercase, Uppercase or Titlecase
# property (so CJK ideographs and combining marks separate words, while
# circled letters and Roman numerals belong to them).
_CASED = r"\p{IsLowercase}\p{IsUppercase}\p{IsTitlecase}"
_CASED_RUNS = rf"([{_CASED}]+|[^{_CASED}]+)"


def strip_sql(x: str) -> str:
    """C1 over SQL text."""
    return f"trim(BOTH '{BLANKS}' FROM {x})"


def title_sql(x: str) -> str:
    """C4 over SQL text."""
    return f"array_join(transform(regexp_extract_all({x}, r'{_CASED_RUNS}', 1), w -> initcap(w)), '')"


def soc_sql(x: str) -> str:
    """C3 over SQL text."""
    return f"upper({strip_sql(x)})"


def strip_text(c) -> Column:
    """Remove leading and trailing whitespace of any kind.

    Plain ``F.trim`` only removes U+0020, which leaves tabs, newlines and
    NBSP; ``trim`` with an explicit character set is a byte-level scan (no
    regular expression), so it is cheap enough for every fact row.
    """
    return F.trim(as_col(c), F.lit(BLANKS))


def normalize_soc(c) -> Column:
    """Occupation code = strip + upper case (no format check)."""
    return F.upper(strip_text(c))


def title_case(c) -> Column:
    """C4: title-case the first character of every cased run, lower the rest.

    A new word starts after any uncased character (hyphen, apostrophe,
    bracket, digit, ideograph), unlike ``F.initcap`` which only starts words
    after a space.
    """
    runs = F.regexp_extract_all(as_col(c), F.lit(_CASED_RUNS), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def soc_group(c) -> Column:
    """First two characters of the code."""
    return F.substring(as_col(c), 1, 2)


def last_two(c) -> Column:
    """Last two characters (the whole string when shorter)."""
    return F.right(as_col(c), F.lit(2))


def wage_code_suffix(c, suffix: str = ".00") -> Column:
    """Append the detailed-occupation suffix."""
    return F.concat(as_col(c), F.lit(suffix))


def fill_default(c, default) -> Column:
    """Replace a missing value by a default."""
    return F.coalesce(as_col(c), F.lit(default))
