"""Delimited files read by blocks: equal to the whole read, in several tasks."""
from __future__ import annotations

import csv
import os
import random

import pytest

from laborstar.plans.pipeline import run_etl
from laborstar.sources import files
from tests.test_pipeline import write_raw


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture()
def small_splits(spark):
    """Splits of about 2 kB, one per task."""
    conf = {"spark.sql.files.maxPartitionBytes": "2048", "spark.sql.files.openCostInBytes": "2048", "spark.sql.files.minPartitionNum": "1"}
    saved = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in saved.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def awkward(rng, n):
    """Rows with quoted breaks of many lengths: some longer than a split, most lines without any quote."""
    word = lambda: "".join(rng.choice("abc é漢") for _ in range(rng.randint(1, 9)))
    for i in range(n):
        kind = rng.random()
        body = word()
        if kind < 0.3:
            body = "\n".join(word() for _ in range(rng.randint(2, 6)))
        elif kind < 0.35:
            body = "\n".join(word() for _ in range(rng.randint(300, 900)))
        elif kind < 0.5:
            body = f'say "{word()}", then\n"{word()}"' if kind < 0.42 else f'"{word()}"'
        elif kind < 0.55:
            body = rng.choice(["", "n/a", "\n", '"', '""', ",", '\n"\n', "a\r\nb", " x "])
        yield [str(i), body, word()]


@pytest.mark.parametrize("seed,ending", [(1, "\n"), (2, "\n"), (3, "\r\n"), (4, "\n")])
def test_blocks_equal_the_whole_read(spark, scratch, small_splits, seed, ending):
    path = os.path.join(scratch, "a.csv")
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f, lineterminator=ending, quoting=csv.QUOTE_ALL if seed == 4 else csv.QUOTE_MINIMAL)
        out.writerow(["id", "body", "word"])
        out.writerows(awkward(random.Random(seed), 400))
    got, want = files.read_delimited(spark, path), files.read_delimited(spark, path, mode="whole")
    assert got.columns == want.columns and rows(got) == rows(want) and got.count() == 400
    lines = spark.read.option("lineSep", "\n").text(path)
    assert lines.rdd.getNumPartitions() > 8                      # the file is read by several tasks
    assert got.where(files.MALFORMED).count() == 0


def test_files_of_a_folder_have_a_header_each(spark, scratch, small_splits):
    folder = os.path.join(scratch, "a.csv")
    os.makedirs(folder)
    rng = random.Random(7)
    for k in range(3):
        with open(os.path.join(folder, f"part-{k}.csv"), "w", newline="", encoding="utf-8") as f:
            out = csv.writer(f)
            out.writerow(["id", "body", "word"])
            out.writerows(awkward(rng, 60))
    got = files.read_delimited(spark, folder)
    assert rows(got) == rows(files.read_delimited(spark, folder, mode="whole")) and got.count() == 180


def test_quotes_out_of_place_are_flagged_and_not_swallowed(spark, scratch):
    """A quote inside an unquoted field opens nothing in the whole read; by blocks such a row stops the load."""
    def write(name, text):
        with open(os.path.join(scratch, name), "w") as f:
            f.write(text)
        return os.path.join(scratch, name)

    inches = write("a.csv", 'x,y\n1,5" pipe\n2,plain\n3,6" pipe\n4,end\n')
    assert files.read_delimited(spark, inches).where(files.MALFORMED).count() == 1
    assert files.read_delimited(spark, inches, mode="whole").count() == 4
    unclosed = write("b.csv", 'x,y\n1,"open\n2,b\n')
    assert files.read_delimited(spark, unclosed).where(files.MALFORMED).count() == 1
    surplus = write("c.csv", 'x,y\n1,"a,b",c\n2,"d,\ne"\n')
    assert rows(files.read_delimited(spark, surplus).select("x", files.MALFORMED)) == [("1", True), ("2", False)]
    empty = write("d.csv", "x,y\n\n\n")
    assert files.read_delimited(spark, empty).count() == 0 == files.read_delimited(spark, write("e.csv", "x,y")).count()
    with pytest.raises(ValueError, match="mode"):
        files.read_delimited(spark, empty, mode="fast")


def test_a_load_by_blocks_equals_a_whole_load(spark, scratch, small_splits):
    raw_dir = os.path.join(scratch, "raw")
    os.makedirs(raw_dir)
    write_raw(spark, raw_dir)
    a = run_etl(spark, raw_dir, os.path.join(scratch, "a"), as_of="2024-01-01")
    b = run_etl(spark, raw_dir, os.path.join(scratch, "b"), as_of="2024-01-01", mode="whole")
    for table in ("fact_tasks", "dim_occupation", "fact_wages"):
        assert rows(getattr(a.warehouse, table)) == rows(getattr(b.warehouse, table)), table
    assert rows(a.audit) == rows(b.audit)
