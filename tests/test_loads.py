"""Change loads, restarts, one publish for all tables, and values lost to coercion."""
from __future__ import annotations

import os

import pytest

from laborstar.operators import transforms as T
from laborstar.operators.releases import snapshot_diff
from laborstar.plans import pipeline, registry
from laborstar.plans.pipeline import load_entries, run_etl
from laborstar.sources import fixtures as fx
from laborstar.sources import warehouse as W
from tests.conftest import SF_SMALL
from tests.test_pipeline import rows, write_raw


def files_of(wh_dir, entry):
    return {s: sorted(f for f in os.listdir(os.path.join(wh_dir, p)) if f.endswith(".parquet")) for s, p in entry.shelves.items()}


def release(spark, n):
    raw = dict(fx.raw_tables(spark, SF_SMALL))
    frames = {spec.source: fx.raw_frame(spark, SF_SMALL, spec.source) for spec in T.TABLE_SPECS}
    return raw | frames | {"occupation_data": fx.occupation_release(spark, SF_SMALL, n)}


def test_a_change_load_rewrites_only_the_shelves_that_changed(spark, scratch):
    wh = os.path.join(scratch, "wh")
    first, _ = load_entries(spark, release(spark, 1), wh, "2024-01-01", rows_per_shelf=20)
    before = {t: files_of(wh, e) for t, e in first.items()}
    assert len(first["dim_occupation"].shelves) > 5 and len(first["fact_skills"].shelves) > 5
    # One occupation changes, one goes, one comes.
    raw = release(spark, 1)
    dim = T.transform_occupations(raw["occupation_data"])
    codes = sorted(r[0] for r in dim.select("onetsoc_code").distinct().collect())
    changed, gone = codes[3], codes[-1]
    new = raw["occupation_data"].selectExpr("`O*NET-SOC Code`", f"CASE WHEN trim(`O*NET-SOC Code`) = '{changed}' THEN 'New Title' ELSE Title END AS Title", "Description")
    new = new.where(f"`O*NET-SOC Code` IS NULL OR trim(`O*NET-SOC Code`) <> '{gone}'").unionAll(spark.createDataFrame([("99-9999.00", "Last", None)], new.schema))
    raw["occupation_data"] = new
    second, written = load_entries(spark, raw, wh, "2024-01-01", changes=True)
    assert written.pop("dim_occupation") and not any(written.values())
    after = {t: files_of(wh, e) for t, e in second.items()}
    hit = {s for s in before["dim_occupation"] if after["dim_occupation"].get(s) != before["dim_occupation"][s]}
    assert 1 <= len(hit) <= 3
    for t in before:
        assert {s: f for s, f in before[t].items() if t != "dim_occupation" or s not in hit} == {s: f for s, f in after[t].items() if t != "dim_occupation" or s not in hit}
    stored = W.StoredWarehouse(spark, wh)
    assert rows(stored.dim_occupation) == rows(T.transform_occupations(new))
    assert rows(stored.fact_skills) == rows(T.transform_skills(raw["skills"], "2024-01-01"))


def test_a_change_load_from_and_to_nothing(spark, scratch):
    wh = os.path.join(scratch, "wh")
    dim = T.transform_occupations(fx.raw_frame(spark, SF_SMALL, "occupation_data"))
    empty = W.write_table(dim.limit(0), wh, "dim_occupation")
    assert empty.shelves == {} and W.StoredWarehouse(spark, wh).dim_occupation.count() == 0
    hit = W.changed_shelves(empty, snapshot_diff(W.StoredWarehouse(spark, wh).dim_occupation, dim, ["onetsoc_code"]))
    full = W.replace_shelves(dim, wh, empty, hit)
    W.publish(spark, wh, {"dim_occupation": full})
    old = W.StoredWarehouse(spark, wh).dim_occupation
    assert rows(old) == rows(dim)
    hit = W.changed_shelves(full, snapshot_diff(old, dim.limit(0), ["onetsoc_code"]))
    W.publish(spark, wh, {"dim_occupation": W.replace_shelves(dim.limit(0), wh, full, hit)})
    assert W.StoredWarehouse(spark, wh).dim_occupation.count() == 0


def test_shelves_are_disjoint_ranges_of_codes(spark, scratch):
    facts = T.transform_skills(fx.raw_frame(spark, SF_SMALL, "skills"), "2024-01-01")
    entry = W.write_table(facts, os.path.join(scratch, "wh"), "fact_skills", rows_per_shelf=500)
    assert len(entry.shelves) >= 8
    spans = []
    for path in W.table_paths(os.path.join(scratch, "wh"), entry):
        low, high = spark.read.parquet(path).selectExpr("min(onetsoc_code)", "max(onetsoc_code)").first()
        spans.append((low[:7], high[:7]))
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_the_shelf_of_a_code_takes_its_number_once(spark):
    """The number is an argument of the count over the bounds, not made again for each bound."""
    codes = ["11-1011.00", "11-1012.00", "", None, "53-7000.00", "11-1011"]
    df = spark.createDataFrame([(c,) for c in codes], "onetsoc_code string")
    number = {r[0]: r[1] for r in df.selectExpr("onetsoc_code", W.code_number()).collect()}
    bounds = tuple(sorted({number["11-1012.00"], number["53-7000.00"], 0}))
    found = df.select("onetsoc_code", W.shelf_of(bounds).alias("s"))
    assert {r[0]: r[1] for r in found.collect()} == {c: sum(b <= number[c] for b in bounds) for c in codes}
    plan = found._jdf.queryExecution().analyzed().toString()
    assert plan.count("conv(") == 1 and plan.index("conv(") < plan.index("lambdafunction(")


def test_a_change_load_cleans_every_release_once(spark, monkeypatch):
    cleaned = spark.sparkContext.accumulator(0)

    def counted(session, sf_dir, n, release=registry._release):
        def count(batches):
            for batch in batches:
                cleaned.add(len(batch))
                yield batch
        df = release(session, sf_dir, n)
        return df.mapInArrow(count, df.schema)

    want = [registry._release(spark, SF_SMALL, n) for n in (1, 2)]
    monkeypatch.setattr(registry, "_release", counted)
    assert rows(registry.QUERIES["change_load"](spark, SF_SMALL)) == rows(want[1])
    assert cleaned.value == sum(df.count() for df in want)


def test_a_second_load_reads_only_the_file_that_changed(spark, scratch, monkeypatch):
    raw_dir, wh = os.path.join(scratch, "raw"), os.path.join(scratch, "wh")
    os.makedirs(raw_dir)
    write_raw(spark, raw_dir)
    first = run_etl(spark, raw_dir, wh, as_of="2024-01-01")
    again = run_etl(spark, raw_dir, wh, as_of="2024-01-01")
    assert not any(again.written.values()) and rows(again.audit) == rows(first.audit) and rows(again.losses) == rows(first.losses)
    with open(os.path.join(raw_dir, "wages.csv"), "a") as f:
        f.write("11-1011,1,100,50,200,10.5\n")
    changed = run_etl(spark, raw_dir, wh, as_of="2024-01-01")
    assert [t for t, w in changed.written.items() if w] == ["fact_wages"]
    assert changed.warehouse.fact_wages.count() == first.warehouse.fact_wages.count() + 1
    other = run_etl(spark, raw_dir, wh, as_of="2024-01-01", wage_year=2024)                 # other parameters, another load
    assert all(other.written.values()) and {r[0] for r in other.warehouse.fact_wages.select("wage_year").distinct().collect()} == {2024}


def test_all_tables_are_published_together(spark, scratch, monkeypatch):
    """A load that dies before its one publish leaves all old tables; a reader keeps the version it looked up."""
    wh = os.path.join(scratch, "wh")
    load_entries(spark, release(spark, 1), wh, "2024-01-01")
    reader = W.StoredWarehouse(spark, wh)
    want = {t: rows(getattr(reader, t)) for t in ("dim_occupation", "fact_wages", "dim_skill_element")}
    raw = release(spark, 2) | {"wages": fx.raw_frame(spark, SF_SMALL, "wages").limit(5)}
    with monkeypatch.context() as m:
        m.setattr(pipeline, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError, match="killed"):
            load_entries(spark, raw, wh, "2024-01-01")
    assert {t: rows(getattr(W.StoredWarehouse(spark, wh), t)) for t in want} == want
    load_entries(spark, raw, wh, "2024-01-01")
    assert {t: rows(getattr(reader, t)) for t in want} == want
    assert rows(W.StoredWarehouse(spark, wh).dim_occupation) == rows(T.transform_occupations(raw["occupation_data"]))


def test_the_version_is_looked_up_once(spark, scratch, monkeypatch):
    wh = os.path.join(scratch, "wh")
    load_entries(spark, release(spark, 1), wh, "2024-01-01")
    calls = []
    monkeypatch.setattr(W, "manifest", lambda *a, f=W.manifest: calls.append(1) or f(*a))
    stored = W.StoredWarehouse(spark, wh)
    assert stored.dim_occupation.columns and stored.fact_wages.columns and stored.register_views() and len(calls) == 1
    with pytest.raises(LookupError, match="not stored"):
        W.StoredWarehouse(spark, os.path.join(scratch, "none")).dim_occupation


def test_lost_values_are_counted_where_rows_are_loaded(spark, scratch):
    raw_dir, wh = os.path.join(scratch, "raw"), os.path.join(scratch, "wh")
    os.makedirs(raw_dir)
    write_raw(spark, raw_dir)
    with open(os.path.join(raw_dir, "wages.csv"), "w") as f:
        f.write("OCC_CODE,AREA_TYPE,A_MEDIAN,A_PCT10,A_PCT90,H_MEDIAN\n11-1011,1,#,*,5,n/a\n11-1012,1,1e400,2,,3\n11-1013,2,#,#,#,#\n")
    with open(os.path.join(raw_dir, "skills.csv"), "w") as f:
        f.write("O*NET-SOC Code,Element ID,Element Name,Scale ID,Data Value,Date\n11-1011.00,1,a,IM,unknown,unknown\n11-1011.00,2,b,IM,9,2020-01-01\n,3,c,IM,x,x\n")
    found = run_etl(spark, raw_dir, wh, as_of="2024-01-01")
    losses = {(r["table"], r["column"]): (r["texts"], r["lost"]) for r in found.losses.collect()}
    assert losses[("fact_wages", "annual_median_wage")] == (2, 2) and losses[("fact_wages", "annual_10th_pct")] == (2, 1)
    assert losses[("fact_wages", "annual_90th_pct")] == (1, 0) and losses[("fact_wages", "hourly_median_wage")] == (1, 0)      # n/a is a missing-value token
    assert losses[("fact_skills", "data_value")] == (2, 1) and losses[("fact_skills", "date_updated")] == (2, 1)
    audit = {r["table"]: r for r in found.audit.collect()}
    assert audit["fact_wages"]["values_lost"] == 3 and audit["fact_skills"]["values_lost"] == 2 and audit["dim_occupation"]["values_lost"] == 0
    assert found.warehouse.fact_wages.where("annual_median_wage is null").count() == 2
