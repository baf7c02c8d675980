"""Snapshot diff and the dimensions over all facts."""
from __future__ import annotations

import pytest

from laborstar.operators.releases import dim_element, dim_scale, snapshot_diff


def test_snapshot_diff(spark):
    schema = "code string, x int, y string"
    old = spark.createDataFrame([("a", 1, "p"), ("a", 1, "p"), ("b", 2, None), ("c", 3, "r"), (None, 4, "s"), ("d", 5, "t"), ("d", 6, "u"), ("e", None, "v")], schema)
    new = spark.createDataFrame([("a", 1, "p"), ("b", 2, "q"), ("f", 7, "w"), (None, 4, "s"), ("d", 6, "u"), ("d", 5, "t"), ("e", None, "v")], schema)
    got = {r["code"]: (r["change"], r["rows_old"], r["rows_new"]) for r in snapshot_diff(old, new.select("y", "code", "x"), ["code"]).collect()}
    assert got == {"a": ("changed", 2, 1), "b": ("changed", 1, 1), "c": ("removed", 1, 0), "f": ("added", 0, 1)}
    assert snapshot_diff(old, old, ["code"]).count() == 0
    assert snapshot_diff(old.limit(0), old.where("code is null"), ["code"]).collect()[0]["change"] == "added"
    assert {r["change"] for r in snapshot_diff(old, old.limit(0), ["code", "x"]).collect()} == {"removed"}
    with pytest.raises(ValueError, match="columns differ"):
        snapshot_diff(old, old.drop("y"), ["code"])


def test_null_and_empty_values_are_different(spark):
    a = spark.createDataFrame([("k", None, "x")], "code string, p string, q string")
    b = spark.createDataFrame([("k", "x", None)], "code string, p string, q string")
    assert snapshot_diff(a, b, ["code"]).collect()[0]["change"] == "changed"


def test_dimensions(spark):
    s = spark.createDataFrame([("IM", "1", "b", 2.0), ("IM", "1", "a", 5.0), ("LV", "2", "c", None)], "scale_id string, element_id string, element_name string, data_value double")
    k = spark.createDataFrame([("IM", "1", "z", 1.0)], s.schema)
    assert sorted(map(tuple, dim_scale(s, k).collect())) == [("IM", 3, 1.0, 5.0), ("LV", 1, None, None)]
    assert sorted(map(tuple, dim_element(skills=s, knowledge=k).collect())) == [("knowledge", "1", "z"), ("skills", "1", "a"), ("skills", "2", "c")]
