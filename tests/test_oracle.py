"""Every registered key against its independent DuckDB SQL (the driver's gate)."""
from __future__ import annotations

import pytest

import __spark_entry__ as E
from laborstar.plans.registry import QUERIES
from tests.conftest import SF_SMALL
from tools.compare import compare

KEYS = sorted(QUERIES)


def test_every_key_has_an_oracle():
    assert set(KEYS) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def results(spark):
    return compare(spark, SF_SMALL, KEYS, verbose=False)


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(results, key):
    assert results[key]["match"], results[key]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["onetsoc_code", "title", "soc_major_group", "annual_median_wage",
                          "hourly_median_wage", "wage_spread"]
    assert 0 < df.count() <= 10


def test_checks_have_teeth(spark):
    """Staging checks see the dirt the cleaning removes; cleaned V1/V3/V4 are zero."""
    q = E.queries()
    raw = {r.check: r.violations for r in q["validation_report_raw"](spark, SF_SMALL).collect()}
    clean = {r.check: r.violations for r in q["validation_report"](spark, SF_SMALL).collect()}
    assert raw["v1_null_codes"] > 0 and raw["v3_skills_range"] > 0 and raw["v4_knowledge_range"] > 0
    assert clean["v1_null_codes"] == clean["v3_skills_range"] == clean["v4_knowledge_range"] == 0
    assert clean["v5_negative_wages"] > 0 and clean["v6_orphan_skills"] > 0


def test_counts_recorded_in_fixtures_doc(spark):
    """The counts FIXTURES.md section 4 records for sf0.01."""
    from tests.conftest import SF_MID
    q = E.queries()
    clean = {r.check: r.violations for r in q["validation_report"](spark, SF_MID).collect()}
    raw = {r.check: r.violations for r in q["validation_report_raw"](spark, SF_MID).collect()}
    assert (clean["v5_negative_wages"], clean["v6_orphan_skills"]) == (94, 2560)
    assert (raw["v1_null_codes"], raw["v2_null_titles"], raw["v3_skills_range"], raw["v4_knowledge_range"]) == \
        (40, 48, 1313, 3438)
    audit = {r.table: r.rows_out for r in q["load_audit"](spark, SF_MID).collect()}
    assert (audit["dim_occupation"], audit["fact_skills"], audit["fact_wages"]) == (1912, 59376, 1174)


def test_schemas_are_stable_across_calls(spark):
    q = E.queries()
    for key, fn in q.items():
        assert fn(spark, SF_SMALL).schema == fn(spark, SF_SMALL).schema, key
    assert E.entry(spark).schema == E.entry(spark).schema
