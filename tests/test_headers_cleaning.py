"""Header operators (P1-P3) and row filters."""
from __future__ import annotations

import pytest

from laborstar.operators import cleaning, headers


@pytest.mark.parametrize("raw,norm", [
    ("O*NET-SOC Code", "o_net_soc_code"), ("  Element ID ", "element_id"), ("Data Value", "data_value"),
    ("__A__B__", "a_b"), ("OCC_CODE", "occ_code"), ("h_median", "h_median"), ("Date", "date"),
])
def test_normalize_name(raw, norm):
    assert headers.normalize_name(raw) == norm


def test_normalize_headers_canonical(spark):
    df = spark.createDataFrame([("a", "b", "c")], ["O*NET-SOC Code", "Date", "Scale ID"])
    assert headers.normalize_headers(df).columns == ["onetsoc_code", "date_updated", "scale_id"]


def test_header_collision_raises(spark):
    df = spark.createDataFrame([("a", "b")], ["Data Value", "data-value"])
    with pytest.raises(ValueError):
        headers.normalize_headers(df)


def test_wage_headers(spark):
    df = spark.createDataFrame([("a",) * 6], ["OCC_CODE", "A_MEDIAN", "A_PCT10", "A_PCT90", "H_MEDIAN", "AREA_TYPE"])
    out = headers.rename_wage_headers(headers.normalize_headers(df)).columns
    assert out == ["onetsoc_code", "annual_median_wage", "annual_10th_pct", "annual_90th_pct",
                   "hourly_median_wage", "area_type"]


def test_null_tokens_exact_match(spark):
    df = spark.createDataFrame([("n/a",), ("NA",), ("  ",), ("",), ("None",), ("x",), (None,), (" NA",)], "v string")
    assert [r[0] for r in cleaning.null_tokens(df).collect()] == [None, None, "  ", None, None, "x", None, " NA"]


def test_drop_null_keys_keeps_blank(spark):
    df = spark.createDataFrame([("a", "t"), (None, "t"), ("b", None), ("  ", "t")], "k string, t string")
    assert cleaning.drop_null_keys(df, ["k", "t"]).count() == 2


def test_filter_national_and_detailed(spark):
    df = spark.createDataFrame([("11-1011", "1"), ("11-1000", "1"), ("11-1012", "2"), ("11-1013", "1.0"),
                                ("11-1014", "x"), ("11-1015", None)], "onetsoc_code string, area_type string")
    nat = cleaning.filter_national(df)
    assert sorted(r[0] for r in nat.collect()) == ["11-1000", "11-1011", "11-1013"]
    assert sorted(r[0] for r in cleaning.filter_detailed(nat).collect()) == ["11-1011", "11-1013"]
    # no area column: no filter
    assert cleaning.filter_national(df.drop("area_type")).count() == 6


def test_optional_column(spark):
    df = spark.createDataFrame([("a",)], "x string")
    assert df.select(cleaning.optional(df, "x", "d"), cleaning.optional(df, "y", "d")).first() == ("a", "d")
