"""Scalar functions (C1-C17) on hand-written edge rows."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from laborstar import functions as fn


def one_col(spark, values, dtype="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {dtype}")


def run(spark, values, expr, dtype="string"):
    return [r[0] for r in one_col(spark, values, dtype).select(expr.alias("y")).collect()]


def test_strip_removes_all_unicode_blanks(spark):
    values = ["  a b  ", "\ta\n", " a　", "\x1ca\x1f", " x ", "", None, "   "]
    assert run(spark, values, fn.strip_text("x")) == [
        v.strip() if v is not None else None for v in values]


def test_strip_matches_python_on_every_blank(spark):
    from laborstar.functions.text import BLANKS
    values = [ch + "q" + ch for ch in BLANKS] + ["q​q"]   # ZWSP is not a blank
    assert run(spark, values, fn.strip_text("x")) == [v.strip() for v in values]


def test_title_case_like_python(spark):
    values = ["kindergarten-THROUGH o'brien (ai)", "ceo", "1st line", "a-b-c", "ÉCOLE élan", "", None,
              "x2y", "mcdonald's"]
    assert run(spark, values, fn.title_case("x")) == [v.title() if v is not None else None for v in values]


def test_normalize_soc_and_group(spark):
    df = one_col(spark, ["  15-1252.00 ", "ab-1234.01", None, "1"])
    rows = df.select(fn.normalize_soc("x").alias("c"), fn.soc_group(fn.normalize_soc("x")).alias("g")).collect()
    assert [tuple(r) for r in rows] == [("15-1252.00", "15"), ("AB-1234.01", "AB"), (None, None), ("1", "1")]


def test_last_two_and_suffix(spark):
    assert run(spark, ["11-1000", "0", "", None], fn.last_two("x")) == ["00", "0", "", None]
    assert run(spark, ["11-1011", None], fn.wage_code_suffix("x")) == ["11-1011.00", None]


AWKWARD = {
    "12": 12.0, " 12 ": 12.0, "-1.5": -1.5, "+3.": 3.0, ".5": 0.5, "1e3": 1000.0, "2E-2": 0.02,
    "NaN": None, "nan": None, "inf": None, "Infinity": None, "-inf": None, "1d": None, "1f": None,
    "1,234": None, "#": None, "*": None, "n/a": None, "": None, "0x1p3": None, "abc": None,
    "1e309": None, "0e310": None, "1.7e308": 1.7e308, "0.5e309": None, "1e-330": 0.0, "1e-99999999999": 0.0,
}


def test_coerce_numeric(spark):
    keys = list(AWKWARD) + [None]
    assert run(spark, keys, fn.coerce_numeric("x")) == list(AWKWARD.values()) + [None]


def test_coerce_numeric_never_nan(spark):
    out = run(spark, [1.0, float("nan"), float("inf"), None], fn.coerce_numeric("x"), "double")
    assert out[0] == 1.0 and out[1:] == [None, None, None]


def test_clip_keeps_missing(spark):
    vals = [-1.0, 0.0, 3.5, 7.0, 9.5, None]
    assert run(spark, vals, fn.clip("x", 0, 7), "double") == [0.0, 0.0, 3.5, 7.0, 7.0, None]


def test_round_value_half_even_on_decimal_view(spark):
    # two-decimal rounding of three-decimal ties: half to even
    vals = ["0.125", "0.135", "2.675", "1.005", "-0.125"]
    out = run(spark, vals, fn.round_value(fn.coerce_numeric("x"), 2))
    assert out == [0.12, 0.14, 2.68, 1.0, -0.12]


def test_sql_round_half_away_from_zero(spark):
    assert run(spark, [2.5, -2.5, 0.125, 1.005], fn.sql_round("x", 2), "double")[2:] == [0.13, 1.01]
    assert run(spark, [2.5, -2.5], fn.sql_round("x", 0), "double") == [3.0, -3.0]


def test_snap_round_absorbs_float_noise(spark):
    # 48.695 computed as a float average sits just below the tie
    df = spark.createDataFrame([(48.69,), (48.70,)], "x double")
    assert df.agg(fn.snap_round(F.avg("x"), 2)).first()[0] == 48.70


def test_snap_round_of_large_values(spark):
    got = run(spark, [1e30, -3e26, float("inf"), 2.345, None], fn.snap_round("x", 2), "double")
    assert got == [1e30, -3e26, float("inf"), 2.35, None]


def test_coerce_int_truncates(spark):
    assert run(spark, ["3.7", "-3.7", "12", "n/a", "1e20", None], fn.coerce_int("x")) == [3, -3, 12, None, None, None]
    assert run(spark, ["3.7", "n/a", "1e20", None], fn.coerce_int("x", 0)) == [3, 0, None, 0]


def test_coerce_date_more_layouts_like_pandas(spark):
    import pandas as pd
    vals = ["2023-08-15T10:11:12", "2023/8/15", "2023-08", "12/31/2023"]
    want = [pd.to_datetime(v).to_pydatetime() for v in vals]
    assert run(spark, vals, fn.coerce_date("x")) == want


def test_coerce_date_patterns(spark):
    vals = ["08/2023", "8/2023", "2023-08-15", "2023-08-15 10:11:12", "8/15/2023", "unknown", "13/2023", None]
    out = run(spark, vals, fn.coerce_date("x"))
    assert out[:5] == [dt.datetime(2023, 8, 1), dt.datetime(2023, 8, 1), dt.datetime(2023, 8, 15),
                       dt.datetime(2023, 8, 15, 10, 11, 12), dt.datetime(2023, 8, 15)]
    assert out[5:] == [None, None, None]


def test_load_date(spark):
    df = spark.range(1)
    assert df.select(fn.load_date("2024-02-03")).first()[0] == dt.datetime(2024, 2, 3)
    assert df.select(fn.load_date()).first()[0].date() == df.select(F.current_date()).first()[0]


def test_education_labels(spark):
    codes = [0, 1, 4, 7, 10, 11, 12, 13]
    assert run(spark, codes, fn.education_label("x"), "int") == [
        None, "No HS Diploma", "Bachelor's Degree", "Master's Degree", None, "Doctoral Degree", "Post-Doctoral", None]
    assert run(spark, codes, fn.education_label_short("x"), "int") == [
        "Other", "No HS Diploma", "Bachelor Degree", "Other", "Other", "Other", "Other", "Other"]


def test_fill_default(spark):
    assert run(spark, ["a", None], fn.fill_default("x", "Core")) == ["a", "Core"]


def test_dates_equal_all_layouts_tried_in_turn(spark):
    """One parse per value gives what trying every layout in turn gives."""
    import random

    from laborstar.functions.dates import DATE_PATTERNS
    rng = random.Random(5)
    texts = ["03/2021", "3/2021", "13/2021", "2021-03-04", "2021-3-4 01:02:03", "3/4/2021", "13/4/2021", "2021-03-04T05:06:07",
             "2021/3/4", "2021-03", "unknown", "", " ", None, "1/2/3/4", "--", "-", "/", "T", "2021-03-04T", "2021", "03-2021", "03-04-2021"]
    texts += ["".join(rng.choice("0123/-T :2") for _ in range(rng.randint(4, 11))) for _ in range(3000)]
    x = spark.createDataFrame([(t,) for t in texts], "x string")
    old = F.coalesce(*[F.try_to_timestamp("x", F.lit(p)) for p in DATE_PATTERNS])
    assert x.where(~old.eqNullSafe(fn.coerce_date("x"))).collect() == []
    assert x.where(fn.coerce_date("x").isNotNull()).count() >= 9
