"""Education level labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Category code -> label of the education-by-wage report.
# Code 10 has no label; any code without a label yields NULL.
EDUCATION_LABELS = {
    1: "No HS Diploma",
    2: "HS Diploma / GED",
    3: "Some College / Assoc.",
    4: "Bachelor's Degree",
    5: "Graduate Degree",
    6: "Post-Baccalaureate",
    7: "Master's Degree",
    8: "Post-Master's",
    9: "First Professional Degree",
    11: "Doctoral Degree",
    12: "Post-Doctoral",
}

# The short label set of the runner variant; others -> 'Other'.
EDUCATION_LABELS_SHORT = {
    1: "No HS Diploma",
    2: "HS Diploma / GED",
    3: "Some College / Assoc.",
    4: "Bachelor Degree",
    5: "Graduate Degree",
}


def case_label(name: str, labels: dict[int, str], otherwise: str | None = None) -> Column:
    """Simple CASE name WHEN k THEN v ... [ELSE otherwise] END."""
    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    whens = " ".join(f"WHEN {code} THEN {quoted(label)}" for code, label in labels.items())
    return F.expr(f"CASE `{name}` {whens}{f' ELSE {quoted(otherwise)}' if otherwise is not None else ''} END")


def education_label(name: str) -> Column:
    """Full label set, no ELSE (NULL for unlisted codes)."""
    return case_label(name, EDUCATION_LABELS)


def education_label_short(name: str) -> Column:
    """Five labels, everything else 'Other'."""
    return case_label(name, EDUCATION_LABELS_SHORT, "Other")
