"""Line dedup: levelled sorted runs of line hashes.

A line's key is the line without ASCII white space at its ends, A-Z lower-cased. A key of at least
``MIN_CHARS`` code points that is in at least ``MIN_DOCS`` documents is repeated; its lines go, except
in the largest doc_id that holds it.

Batches of documents come in descending doc_id order. Each batch reduces its lines to one row per key
(hash, documents, largest doc_id), merge-anti-joins the runs written before it, where a key that a run
already counts in ``MIN_DOCS`` documents is settled and needs no more rows, and adds the rest as a
new sorted run. A run is a table bucketed and sorted by key, so the joins read it without a shuffle.
``FANOUT`` runs of one level are compacted into one run of the next. Because batches descend, the
first run that holds a key has its largest doc_id.

A key is 96 bits of hash (xxhash64 and murmur3). A line in a third of all documents is one row per
task before it is shuffled, and the join that finds its rows is an inner join that AQE may split.

Edge cases: a null or empty text is one empty line; a document is a doc_id, so rows that repeat an id count
once (and all keep the line if theirs is the largest), and rows without an id are one document, smaller than any other;
a text whose lines all go becomes empty and its row stays; other columns pass through untouched.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laborstar.llm._columns import BLANKS, ascii_lower, like
from laborstar.llm._store import fresh_path, stored

MIN_CHARS = 20
MIN_DOCS = 3
BATCHES = 4
FANOUT = 2
KEY = ["k1", "k2"]


def lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return ascii_lower(F.trim(line, F.lit(BLANKS)))


def line_rows(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per line that is long enough: id, text hash, position, key hashes."""
    rows = docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("h"), F.posexplode(lines(F.col("text"))).alias("pos", "line"))
    key = line_key(F.col("line"))
    return (rows.select("id", "h", "pos", key.alias("key")).where(F.char_length("key") >= min_chars)
            .select("id", "h", "pos", F.xxhash64("key").alias("k1"), F.hash("key").alias("k2")))


def batch_bounds(rows: DataFrame, batches: int) -> list[int]:
    """doc_id values that cut the rows into ``batches`` parts of about the same size."""
    at = [i / batches for i in range(1, batches)]
    found = rows.agg(F.percentile_approx("id", at, 1000).alias("at")).first()["at"]
    return sorted(set(found or []))


class Runs:
    """Sorted runs of (key, documents, largest doc_id) in levels."""

    def __init__(self, spark, min_docs: int = MIN_DOCS, fanout: int = FANOUT):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = [[]]

    def tables(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def _write(self, run: DataFrame, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        name = f"line_run_{uuid.uuid4().hex}"
        (run.repartition(self.buckets, *KEY).write.bucketBy(self.buckets, *KEY).sortBy(*KEY)
         .option("path", fresh_path(self.spark, "line-run")).saveAsTable(name))
        self.levels[level].append(name)
        if len(self.levels[level]) == self.fanout:
            merged = self.merged(level)
            old, self.levels[level] = self.levels[level], []
            self._write(merged, level + 1)
            self._forget(old)

    def merged(self, level: int | None = None) -> DataFrame:
        """All runs, or those of a level, merged to one row per key.

        Merge joins of the sorted buckets; a union would not keep equal buckets together.
        """
        names = [n for i, names in enumerate(self.levels) for n in names if level in (None, i)]
        runs = self.spark.table(names[0])
        for name in names[1:]:
            more = self.spark.table(name).withColumnsRenamed({"n": "more_n", "holder": "more_holder"})
            runs = runs.join(more, KEY, "full_outer").select(
                *KEY, (F.coalesce("n", F.lit(0)) + F.coalesce("more_n", F.lit(0))).alias("n"), F.greatest("holder", "more_holder").alias("holder"))
        return runs

    def add(self, batch: DataFrame) -> None:
        """Anti-join a batch of (key, n, holder) with the keys that are settled, and add the rest."""
        for run in self.tables():
            batch = batch.join(run.where(F.col("n") >= self.min_docs).select(*KEY), KEY, "left_anti")
        self._write(batch, 0)

    def _forget(self, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def close(self) -> None:
        self._forget([n for level in self.levels for n in level])


def repeated_lines(rows: DataFrame, min_docs: int = MIN_DOCS, batches: int = BATCHES) -> DataFrame:
    """Keys in at least ``min_docs`` documents with the largest doc_id that holds them."""
    bounds = batch_bounds(rows, batches)
    runs = Runs(rows.sparkSession, min_docs)
    for i in range(len(bounds), -1, -1):                       # the largest ids first
        part = rows
        if i < len(bounds):
            part = part.where((F.col("id") <= bounds[i]) | F.col("id").isNull() if i == 0 else F.col("id") <= bounds[i])
        if i > 0:
            part = part.where(F.col("id") > bounds[i - 1])
        runs.add(part.groupBy(*KEY, "id").agg(F.lit(1).alias("one"))
                 .groupBy(*KEY).agg(F.count("one").alias("n"), F.max("id").alias("holder")))
    found = stored(runs.merged().where(F.col("n") >= min_docs).select(*KEY, "holder"), "repeated-lines")
    runs.close()
    return found


def dropped_positions(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                      batches: int = BATCHES) -> DataFrame:
    """Per document (id, text hash) the positions of the lines that go."""
    rows = stored(line_rows(docs, min_chars), "lines")
    hits = rows.join(repeated_lines(rows, min_docs, batches), KEY).where(~F.col("id").eqNullSafe(F.col("holder")))
    return hits.groupBy("id", "h").agg(F.collect_set("pos").alias("gone"))


def dedup_lines(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with ``__n_lines``, ``__n_dropped`` and ``__kept`` (the text that stays) added.

    Texts are split before the join, so that the lines are a column there and are not split again for each.
    """
    gone = dropped_positions(docs, **options).select(F.col("id").alias("__id"), F.col("h").alias("__h"), F.col("gone").alias("__gone"))
    split = docs.withColumns({"__lines": lines(F.col("text")), "__none": F.col("text").isNull(), "__hash": F.xxhash64("text")}).drop("text")
    joined = split.join(gone, split["doc_id"].eqNullSafe(gone["__id"]) & (split["__hash"] == gone["__h"]), "left")
    whole = F.array_join("__lines", "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__gone"))
    kept = F.when(F.col("__gone").isNull(), whole).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get(F.col("__lines"), i)), "\n"))
    added = {"text": F.when(~F.col("__none"), whole), "__kept": kept, "__n_lines": F.size("__lines"),
             "__n_dropped": F.coalesce(F.size("__gone"), F.lit(0))}
    return joined.withColumns(added).select(*[F.col(f"`{c}`") for c in docs.columns], "__kept", "__n_lines", "__n_dropped")


def dedup(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without the repeated lines; n_chars, if there, follows the text. Null texts stay null."""
    new = {"text": F.when(F.col("text").isNotNull(), F.col("__kept"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("__n_dropped") > 0, F.char_length("__kept")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return like(dedup_lines(docs, **options).withColumns(new), docs)


def report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_lines, n_dropped, kept_sha256."""
    return dedup_lines(docs.select("doc_id", "text")).select(
        "doc_id", F.col("__n_lines").cast("long").alias("n_lines"), F.col("__n_dropped").cast("long").alias("n_dropped"),
        F.sha2("__kept", 256).alias("kept_sha256"))
