"""Header operators: metadata only, no pass over the data."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

# Header spellings that differ from the warehouse name after
# normalisation. Every other header is kept as normalised.
CANONICAL_NAMES = {
    "o_net_soc_code": "onetsoc_code",
    "date": "date_updated",
}

# Wage-survey headers -> warehouse names.
WAGE_NAMES = {
    "occ_code": "onetsoc_code",
    "a_median": "annual_median_wage",
    "a_pct10": "annual_10th_pct",
    "a_pct90": "annual_90th_pct",
    "h_median": "hourly_median_wage",
}

# Raw frames of delimited files carry this flag: the row has more fields
# than the header, so a reader that drops the surplus would damage it. It is
# not a column of the file, and the header rules leave it as it is.
MALFORMED = "_malformed"

_NON_ALNUM = re.compile(r"[^a-z0-9]+")


def normalize_name(name: str) -> str:
    """Trim, lower case, runs of non [a-z0-9] -> '_', no outer '_'."""
    return _NON_ALNUM.sub("_", name.strip().lower()).strip("_")


def _rename_all(df: DataFrame, new_names: list[str]) -> DataFrame:
    seen: dict[str, str] = {}
    for old, new in zip(df.columns, new_names):
        if new in seen:
            raise ValueError(f"headers {seen[new]!r} and {old!r} both map to {new!r}")
        seen[new] = old
    return df.toDF(*new_names)


def normalize_headers(df: DataFrame) -> DataFrame:
    """P1 + P2: normalised, canonical column names; fails on a collision."""
    names = [c if c == MALFORMED else normalize_name(c) for c in df.columns]
    names = [CANONICAL_NAMES.get(n, n) for n in names]
    return _rename_all(df, names)


def rename_wage_headers(df: DataFrame) -> DataFrame:
    """Wage-survey names -> warehouse names (absent names are ignored)."""
    return _rename_all(df, [WAGE_NAMES.get(c, c) for c in df.columns])
