"""File sources (S1-S5, S7) and the end-to-end pipeline."""
from __future__ import annotations

import os

import pytest

from laborstar.operators import transforms as T
from laborstar.plans import marts
from laborstar.plans.pipeline import run_etl
from laborstar.sources import files
from laborstar.sources.fixtures import Warehouse
from laborstar.sources.warehouse import StoredWarehouse
from tests.conftest import SF_SMALL


def write_raw(spark, raw_dir, sep=","):
    """Write the six raw fixture tables as single delimited files with a header."""
    w = Warehouse.of(spark, SF_SMALL)
    for spec in T.TABLE_SPECS:
        pdf = w.raw[spec.source].toPandas()
        ext = ".txt" if spec.source == "task_statements" else ".csv"   # exercise the fallback
        pdf.to_csv(os.path.join(raw_dir, spec.source + ext), sep=sep, index=False)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_resolve_order_and_errors(spark, scratch):
    for name in ("a.csv", "a.txt", "b.txt", "c.parquet"):
        with open(os.path.join(scratch, name), "w") as f:
            f.write("x\n1\n")
    assert files.resolve(spark, scratch, "a").endswith("a.csv")
    assert files.resolve(spark, scratch, "b.csv").endswith("b.txt")
    open(os.path.join(scratch, "d.xlsx"), "w").close()
    with pytest.raises(files.RawFileNotFound, match="spreadsheet"):
        files.resolve(spark, scratch, "d")
    open(os.path.join(scratch, "d.txt"), "w").close()      # the spreadsheet is still preferred
    with pytest.raises(files.RawFileNotFound, match="spreadsheet"):
        files.resolve(spark, scratch, "d")
    open(os.path.join(scratch, "d.csv"), "w").close()      # csv wins over both
    assert files.resolve(spark, scratch, "d").endswith("d.csv")
    with pytest.raises(files.RawFileNotFound):
        files.resolve(spark, scratch, "missing")


def test_csv_and_tsv_give_equal_frames(spark, scratch):
    text = 'code{s}title{s}value\n11-1011{s}"Chief, Exec"{s}n/a\n15-1252{s}Dev{s}\n'
    for name, sep in (("c.csv", ","), ("t.txt", "\t")):
        with open(os.path.join(scratch, name), "w") as f:
            f.write(text.format(s=sep))
    c = files.extract(spark, scratch, "c")
    t = files.extract(spark, scratch, "t")
    assert c.schema == t.schema and all(f.dataType.simpleString() == "string" for f in c.schema if f.name != files.MALFORMED)
    assert rows(c) == rows(t) == [("11-1011", "Chief, Exec", None, False), ("15-1252", "Dev", None, False)]


def test_invalid_utf8_is_replaced(spark, scratch):
    with open(os.path.join(scratch, "u.csv"), "wb") as f:
        f.write(b"title\nabc\xff\xfedef\n")
    got = files.extract(spark, scratch, "u").first()[0]
    assert got.startswith("abc") and got.endswith("def") and "�" in got


def test_etl_end_to_end_twice(spark, scratch):
    raw_dir = os.path.join(scratch, "raw")
    os.makedirs(raw_dir)
    write_raw(spark, raw_dir)
    wh_dir = os.path.join(scratch, "wh")
    first = run_etl(spark, raw_dir, wh_dir, as_of="2024-01-01")
    audit1, report1 = rows(first.audit), rows(first.report)
    tables1 = {t: rows(getattr(first.warehouse, t)) for t in
               ("dim_occupation", "fact_skills", "fact_wages", "fact_tasks", "dim_skill_element")}
    second = run_etl(spark, raw_dir, wh_dir, as_of="2024-01-01")
    assert rows(second.audit) == audit1 and rows(second.report) == report1
    for t, r in tables1.items():
        assert rows(getattr(second.warehouse, t)) == r, t
    # The file path gives the same warehouse as the in-memory fixture path.
    w = Warehouse.of(spark, SF_SMALL)
    assert rows(first.warehouse.dim_occupation) == rows(w.dim_occupation)
    assert rows(first.warehouse.fact_tasks) == rows(w.fact_tasks)
    for r in first.audit.collect():
        assert r.rows_in == r.rows_out + r.rows_dropped
    # Reports run on the stored tables.
    q1 = marts.q1_top_paying(first.warehouse.dim_occupation, first.warehouse.fact_wages)
    assert rows(q1) == rows(marts.q1_top_paying(w.dim_occupation, w.fact_wages))


def test_tsv_pipeline_equals_csv(spark, scratch):
    a, b = os.path.join(scratch, "a"), os.path.join(scratch, "b")
    os.makedirs(a), os.makedirs(b)
    write_raw(spark, a, ","), write_raw(spark, b, "\t")
    ra = run_etl(spark, a, os.path.join(scratch, "wa"), as_of="2024-01-01")
    rb = run_etl(spark, b, os.path.join(scratch, "wb"), as_of="2024-01-01")
    assert rows(ra.warehouse.fact_skills) == rows(rb.warehouse.fact_skills)
    assert rows(ra.report) == rows(rb.report)


def test_repartitioned_input_same_result(spark):
    w = Warehouse.of(spark, SF_SMALL)
    a = marts.q2_skill_by_group(w.dim_occupation, w.fact_skills)
    b = marts.q2_skill_by_group(w.dim_occupation.repartition(3), w.fact_skills.repartition(7, "scale_id"))
    assert rows(a) == rows(b)


def test_default_load_equals_the_fixtures(spark, scratch):
    """Task texts contain quoted newlines; the default read keeps them whole, in all six tables."""
    raw_dir = os.path.join(scratch, "raw")
    os.makedirs(raw_dir)
    write_raw(spark, raw_dir)
    res = run_etl(spark, raw_dir, os.path.join(scratch, "wh"), as_of="2024-01-01")
    w = Warehouse.of(spark, SF_SMALL)
    for spec in T.TABLE_SPECS:
        assert rows(getattr(res.warehouse, spec.table)) == rows(getattr(w, spec.table)), spec.table
    assert {r.rows_malformed for r in res.audit.collect()} == {0}
    with pytest.raises(files.MalformedFile, match="task_statements.*unclosed quote"):
        run_etl(spark, raw_dir, os.path.join(scratch, "wh"), as_of="2024-01-01", mode="lines")


def csv_file(scratch, name, text):
    with open(os.path.join(scratch, name), "w") as f:
        f.write(text)


def test_quoted_newlines_short_and_surplus_rows(spark, scratch):
    csv_file(scratch, "a.csv", 'x,y,z\n1,"two\nlines, ""quoted""",3\n4,5\n6,7,8,9\n"a,b",c,d\n')
    got = files.extract(spark, scratch, "a")
    assert got.columns == ["x", "y", "z", files.MALFORMED]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([
        ("1", 'two\nlines, "quoted"', "3", False), ("4", "5", None, False), ("6", "7", "8", True), ("a,b", "c", "d", False)], key=repr)
    with pytest.raises(files.MalformedFile, match="a.csv: 2 lines"):
        files.extract(spark, scratch, "a", mode="lines")
    csv_file(scratch, "b.csv", 'x,y\n"1, one",2\n3,4,5\n')
    flagged = {r["x"]: r[files.MALFORMED] for r in files.extract(spark, scratch, "b", mode="lines").collect()}
    assert flagged == {"1, one": False, "3": True}


def test_surplus_field_stops_the_load_and_keeps_the_old_tables(spark, scratch):
    raw_dir, wh_dir = os.path.join(scratch, "raw"), os.path.join(scratch, "wh")
    os.makedirs(raw_dir)
    write_raw(spark, raw_dir)
    before = run_etl(spark, raw_dir, wh_dir, as_of="2024-01-01")
    want = {t: rows(getattr(before.warehouse, t)) for t in ("dim_occupation", "fact_wages")}
    with open(os.path.join(raw_dir, "wages.csv"), "a") as f:
        f.write("11-1011,1,2,3,4,5,6,7\n")
    with open(os.path.join(raw_dir, "occupation_data.csv"), "a") as f:
        f.write("99-9999.00,New,New\n")
    with pytest.raises(files.MalformedFile, match="wages: 1 of"):
        run_etl(spark, raw_dir, wh_dir, as_of="2024-01-01")
    after = StoredWarehouse(spark, wh_dir)
    for t, r in want.items():
        assert rows(getattr(after, t)) == r


def test_task_ids_are_kept_as_read(spark):
    raw = spark.createDataFrame([("15-1252.00", "A-7", "t"), ("15-1252.00", "12", "u")], ["O*NET-SOC Code", "Task ID", "Task"])
    assert {r["task_id"] for r in T.transform_tasks(raw).collect()} == {"A-7", "12"}


def test_parquet_raw_files_load_like_the_fixtures(spark, scratch):
    """Raw files may also be Parquet (typed columns); the warehouse is the same."""
    raw_dir = os.path.join(scratch, "raw")
    w = Warehouse.of(spark, SF_SMALL)
    for spec in T.TABLE_SPECS:
        w.raw[spec.source].write.parquet(os.path.join(raw_dir, spec.source + ".parquet"))
    res = run_etl(spark, raw_dir, os.path.join(scratch, "wh"), as_of="2024-01-01")
    for table in ("dim_occupation", "fact_skills", "fact_knowledge", "fact_education", "fact_tasks", "fact_wages"):
        assert rows(getattr(res.warehouse, table)) == rows(getattr(w, table)), table


def test_cli_etl_report_and_sql(spark, scratch, capsys):
    from laborstar.__main__ import main
    raw_dir, wh_dir = os.path.join(scratch, "raw"), os.path.join(scratch, "wh")
    os.makedirs(raw_dir)
    write_raw(spark, raw_dir)
    main(["etl", raw_dir, wh_dir, "--as-of", "2024-01-01"])
    out = capsys.readouterr().out
    assert "rows_dropped" in out and ("All checks passed" in out or "Some checks FAILED" in out)
    main(["report", wh_dir, "q2_skill_by_group"])
    assert "avg_skill_importance" in capsys.readouterr().out
    main(["sql", wh_dir, "SELECT id FROM range(60)"])
    assert len(capsys.readouterr().out.split()) == 61             # every row
    main(["sql", wh_dir, "SELECT id FROM range(60)", "--rows", "5"])
    assert len(capsys.readouterr().out.split()) == 6
    main(["report", wh_dir, "q1_top_paying", "--output", os.path.join(scratch, "out")])
    assert spark.read.parquet(os.path.join(scratch, "out", "q1_top_paying")).count() == 10
    capsys.readouterr()
    main(["sql", wh_dir, "SELECT COUNT(*) AS n FROM fact_wages"])
    assert str(Warehouse.of(spark, SF_SMALL).fact_wages.count()) in capsys.readouterr().out


def test_byte_order_mark_in_header(spark, scratch):
    """A UTF-8 BOM before the first header does not hide the code column."""
    with open(os.path.join(scratch, "occupation_data.csv"), "w", encoding="utf-8-sig") as f:
        f.write("O*NET-SOC Code,Title,Description\n 15-1252.00 ,software developers,Writes code\n")
    dim = T.transform_occupations(files.extract(spark, scratch, "occupation_data"))
    assert rows(dim) == [("15-1252.00", "Software Developers", "Writes code", "15")]
