"""History of a table across releases: type-2 rows and reads as of a day.

A row of the history is a content (all columns of the table), how many copies
of it there were, and the days from which and up to which (exclusive) that was
so; an open row has no end. Releases replace each other: a release holds from its day
to the next one's.

Every release is reduced to counts per content before releases meet, combined
map-side, and a content's counts are put in order inside one row. So a code
with a third of all rows is as many groups as it has contents, and none grows
with the number of its rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COPIES, FROM, TO = "copies", "valid_from", "valid_to"
_OWN = (COPIES, FROM, TO)


def _columns(df: DataFrame) -> list[str]:
    clash = [c for c in df.columns if c in _OWN]
    if clash:
        raise ValueError(f"column(s) {clash} are names of the history itself")
    return df.columns


def _quoted(columns: list[str]) -> list[Column]:
    return [F.col(f"`{c}`") for c in columns]


def history(releases: dict[str, DataFrame]) -> DataFrame:
    """The history of releases given by day (YYYY-MM-DD): the columns, copies, valid_from, valid_to.

    The number of releases is the caller's list; a content has one count for each.
    """
    days = sorted(releases)
    columns = _columns(releases[days[0]])
    counted = []
    for i, day in enumerate(days):
        if sorted(releases[day].columns) != sorted(columns):
            raise ValueError(f"columns of {day} differ: {releases[day].columns}")
        counted.append(releases[day].select(*_quoted(columns), F.lit(i).alias("__release")))
    counts = [F.count_if(F.col("__release") == i) for i in range(len(days))]
    rows = (reduce(DataFrame.unionByName, counted).groupBy(*_quoted(columns)).agg(F.array(*counts).alias("__n")))
    last = len(days) - 1
    day_of = F.array(*[F.lit(d).cast("date") for d in days])

    def n(i: Column) -> Column:
        return F.get("__n", i)

    starts = F.filter(F.sequence(F.lit(0), F.lit(last)), lambda i: (n(i) > 0) & ((i == 0) | (n(i - 1) != n(i))))

    def span(i: Column) -> Column:
        ends = F.filter(F.sequence(F.lit(0), F.lit(last)), lambda j: (j > i) & (n(j) != n(i)))
        return F.struct(n(i).alias(COPIES), F.get(day_of, i).alias(FROM), F.get(day_of, F.get(ends, F.lit(0))).alias(TO))

    return rows.select(*_quoted(columns), F.inline(F.transform(starts, span)))


def append_release(old: DataFrame, release: DataFrame, day: str) -> DataFrame:
    """The history after one more release, from one grouping of the open rows and the release; closed rows pass through."""
    columns = _columns(release)
    if sorted(c for c in old.columns if c not in _OWN) != sorted(columns):
        raise ValueError(f"columns differ: {old.columns} and {columns}")
    now = F.lit(day).cast("date")
    is_open = F.col(TO).isNull()
    both = (old.where(is_open).select(*_quoted(columns), F.col(COPIES).alias("__old"), F.col(FROM).alias("__from"), F.lit(0).cast("long").alias("__new"))
            .unionByName(release.select(*_quoted(columns), F.lit(0).cast("long").alias("__old"), F.lit(None).cast("date").alias("__from"),
                                        F.lit(1).cast("long").alias("__new"))))
    met = both.groupBy(*_quoted(columns)).agg(F.sum("__old").alias("__old"), F.max("__from").alias("__from"), F.sum("__new").alias("__new"))
    none = F.lit(None).cast("date")
    same = F.col("__old") == F.col("__new")
    spans = F.array(
        F.when(F.col("__old") > 0, F.struct(F.col("__old").alias(COPIES), F.col("__from").alias(FROM), F.when(~same, now).alias(TO))),
        F.when(~same & (F.col("__new") > 0), F.struct(F.col("__new").alias(COPIES), now.alias(FROM), none.alias(TO))))
    return (old.where(~is_open).select(*_quoted(columns), *_OWN)
            .unionByName(met.select(*_quoted(columns), F.inline(F.array_compact(spans)))))


def as_of(found: DataFrame, day: str) -> DataFrame:
    """The table as it was on a day: every row as often as it was there."""
    columns = [c for c in found.columns if c not in _OWN]
    at = F.lit(day).cast("date")
    live = found.where((F.col(FROM) <= at) & (F.col(TO).isNull() | (F.col(TO) > at)))
    return live.select(*_quoted(columns), F.explode(F.sequence(F.lit(1).cast("long"), F.col(COPIES))).alias("__copy")).drop("__copy")


def changes(found: DataFrame, key: str) -> DataFrame:
    """What each day changed, per key: key, day, rows_ended, rows_begun."""
    begun = found.select(F.col(f"`{key}`").alias(key), F.col(FROM).alias("day"), F.lit(0).cast("long").alias("e"), F.col(COPIES).alias("b"))
    ended = found.where(F.col(TO).isNotNull()).select(F.col(f"`{key}`").alias(key), F.col(TO).alias("day"), F.col(COPIES).alias("e"), F.lit(0).cast("long").alias("b"))
    return begun.unionByName(ended).groupBy(key, "day").agg(F.sum("e").alias("rows_ended"), F.sum("b").alias("rows_begun"))
