"""Column functions: everything here maps a Column to a Column."""

from laborstar.functions.dates import coerce_date, load_date
from laborstar.functions.labels import education_label, education_label_short
from laborstar.functions.numeric import (
    clip,
    coerce_int,
    coerce_numeric,
    round_value,
    snap_round,
    sql_round,
)
from laborstar.functions.text import (
    fill_default,
    last_two,
    normalize_soc,
    soc_group,
    strip_text,
    title_case,
    wage_code_suffix,
)

__all__ = [
    "clip", "coerce_date", "coerce_int", "coerce_numeric",
    "education_label", "education_label_short", "fill_default", "last_two",
    "load_date", "normalize_soc", "round_value", "snap_round",
    "soc_group", "sql_round", "strip_text", "title_case", "wage_code_suffix",
]
