"""Type-2 history across releases, and the checks of keys and references."""
from __future__ import annotations

import random
from collections import Counter

import pytest

from laborstar.operators import history as H
from laborstar.operators import validation as V
from tests.test_plans import explain as plan_text

SCHEMA = "code string, x int, y string"
DAYS = ["2020-01-01", "2020-06-01", "2021-01-01", "2022-01-01"]


def releases(seed=1, n=120):
    """Rows come, go, come back and repeat; code 'hot' has a third of them."""
    rng = random.Random(seed)
    out = {}
    for day in DAYS:
        rows = [(rng.choice(["hot", None, *"abcdefghij"] if rng.random() < 0.7 else ["hot"]), rng.choice([1, 2, None]), rng.choice(["p", None, ""])) for _ in range(n)]
        out[day] = rows if day != "2021-01-01" else rows + out["2020-06-01"][:60]
    return out


def brute(found):
    """(content, copies, from, to) by walking the releases of every content."""
    counts = {d: Counter(rows) for d, rows in found.items()}
    out = Counter()
    for content in set().union(*counts.values()):
        open_since = None
        for i, d in enumerate(DAYS):
            n = counts[d][content]
            if open_since and n != open_since[0]:
                out[(*content, open_since[0], open_since[1], d)] += 1
                open_since = None
            if n and not open_since:
                open_since = (n, d)
        if open_since:
            out[(*content, open_since[0], open_since[1], None)] += 1
    return out


def frames(spark, found):
    return {d: spark.createDataFrame(rows, SCHEMA).repartition(3) for d, rows in found.items()}


def collected(df):
    return Counter((r["code"], r["x"], r["y"], r["copies"], str(r["valid_from"]), str(r["valid_to"]) if r["valid_to"] else None) for r in df.collect())


def test_history_equals_a_walk(spark):
    found = releases()
    whole = H.history(frames(spark, found))
    assert collected(whole) == brute(found)
    for day, at in [("2020-01-01", 0), ("2020-05-31", 0), ("2020-06-01", 1), ("2021-12-31", 2), ("2030-01-01", 3)]:
        assert Counter(map(tuple, H.as_of(whole, day).collect())) == Counter(found[DAYS[at]])
    assert H.as_of(whole, "2019-12-31").count() == 0


def test_releases_may_be_appended_one_by_one(spark):
    found = releases(2)
    df = frames(spark, found)
    grown = H.history({DAYS[0]: df[DAYS[0]]})
    for day in DAYS[1:]:
        grown = H.append_release(grown, df[day], day)
    assert collected(grown) == brute(found)
    assert collected(H.append_release(H.history({DAYS[0]: df[DAYS[0]].limit(0)}), df[DAYS[1]], DAYS[1])) == collected(H.history({DAYS[1]: df[DAYS[1]]}))
    moved = {(r["code"], str(r["day"])): (r["rows_ended"], r["rows_begun"]) for r in H.changes(grown, "code").collect()}
    assert moved[("hot", DAYS[0])] == (0, sum(r[0] == "hot" for r in found[DAYS[0]]))


def test_history_refuses_other_columns(spark):
    a = spark.createDataFrame([("a", 1, "b")], SCHEMA)
    with pytest.raises(ValueError, match="differ"):
        H.history({"2020-01-01": a, "2021-01-01": a.drop("y")})
    with pytest.raises(ValueError, match="names of the history"):
        H.history({"2020-01-01": a.withColumnRenamed("y", "copies")})


def test_a_hot_code_is_combined_before_the_shuffle(spark):
    """A code with all rows reaches the shuffle as one row per content and task."""
    df = spark.range(40_000).selectExpr("'hot' AS code", "CAST(id % 5 AS INT) AS x", "'p' AS y").repartition(4)
    text = explain(H.history({"2020-01-01": df, "2021-01-01": df}))
    assert text.count("HashAggregate") >= 2 or text.count("ObjectHashAggregate") >= 2


def report(df):
    return {r["check"]: (r["violations"], r["passed"]) for r in df.collect()}


def test_orphans_of_all_facts(spark):
    dim = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "onetsoc_code string")
    f = spark.createDataFrame([("a",), ("b",), ("z",), ("z",), (None,)], "onetsoc_code string")
    g = spark.createDataFrame([("a",)], "onetsoc_code string")
    assert report(V.orphans(dim, {"f": f, "g": g, "h": g.limit(0)})) == {"orphans_f": (3, False), "orphans_g": (0, True), "orphans_h": (0, True)}
    assert report(V.orphans(dim.limit(0), {"f": f})) == {"orphans_f": (5, False)}
    assert explain(V.orphans(dim, {"f": f, "g": g})).count("Exchange hashpartitioning") == 1


def test_unique_keys(spark):
    dim = spark.createDataFrame([("a",), ("b",), ("b",), (None,), (None,)], "onetsoc_code string")
    tasks = spark.createDataFrame([("a", "1"), ("a", "2"), ("a", "1"), ("b", "1")], "onetsoc_code string, task_id string")
    assert report(V.unique_keys({"dim_occupation": dim, "fact_tasks": tasks, "fact_wages": dim})) == {"unique_dim_occupation": (2, False), "unique_fact_tasks": (1, False)}
    assert report(V.unique_keys({"dim_occupation": dim.limit(0)})) == {"unique_dim_occupation": (0, True)}


def explain(df):
    return plan_text(df, "simple")
