"""Raw file sources.

Files are read as text, every column a STRING (no schema inference: one
pass, and types are decided by the cleaning rules, not by sampling). Quoted
fields are read whole, also across line breaks, and a file of any size is read by
many tasks (``mode``):

* ``blocks`` (the default): every split of a file counts the quotes before
  each of its lines; whether a split begins inside a quoted field is the parity
  of all quotes before it. Lines that continue a record are joined to it, also
  across splits, and each record is parsed on its own.
* ``lines``: line by line, after checking in one scan that every line closes
  its quotes; no shuffle.
* ``whole``: one task per file, for files whose quotes are not balanced.

Paths may live on any file system Spark can read.
"""

from __future__ import annotations

import csv

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from laborstar.operators.cleaning import null_tokens
from laborstar.operators.headers import MALFORMED

# Extensions tried for a logical file name, in order of
# preference. A spreadsheet is recognised but not read.
EXTENSIONS = (".csv", ".xlsx", ".txt", ".parquet")
UNSUPPORTED = (".xlsx",)
_RECORD = "_record"


class RawFileNotFound(FileNotFoundError):
    pass


class MalformedFile(ValueError):
    pass


def _path_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.format("binaryFile").load(path).schema  # resolves the path only
        return True
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc.getCondition() or "") or "Path does not exist" in str(exc):
            return False
        raise


def resolve(spark: SparkSession, raw_dir: str, name: str) -> str:
    """First existing of name.csv, name.xlsx, name.txt, name.parquet.

    When the preferred existing file is a spreadsheet the load fails with a
    message to convert it, rather than silently reading a lower-preference
    file with possibly different contents.
    """
    base = name[:-4] if name.endswith(".csv") else name
    root = raw_dir.rstrip("/")
    tried = []
    for ext in EXTENSIONS:
        path = f"{root}/{base}{ext}"
        tried.append(path)
        if _path_exists(spark, path):
            if ext in UNSUPPORTED:
                raise RawFileNotFound(
                    f"{path} exists but spreadsheets are not read; convert it to csv, txt or parquet")
            return path
    raise RawFileNotFound(f"could not find {base} ({', '.join(EXTENSIONS)}) in {root}; tried {tried}")


def fingerprint(spark: SparkSession, path: str) -> str:
    """What tells a raw file (or folder of files) from a changed one: names, lengths and modification times, not contents."""
    listed = spark.read.format("binaryFile").load(path).select("path", "length", "modificationTime")
    found = listed.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")).alias("h")).first()
    return f"{path}|{found['n']}|{found['h']}"


def first_line(spark: SparkSession, path: str) -> str:
    """The header line of a file, without a byte-order mark."""
    first = spark.read.text(path).limit(1).collect()
    return first[0][0].lstrip("\ufeff") if first else ""


def separator_of(line: str) -> str:
    """Tab if the first line has a tab, else comma."""
    return "\t" if "\t" in line else ","


def header_names(line: str, sep: str) -> list[str]:
    """Column names of a header line; an empty or repeated name gets its position."""
    names: list[str] = []
    for i, name in enumerate(next(csv.reader([line], delimiter=sep), [])):
        names.append(name if name and name not in names else f"{name or 'column'}.{i}")
    return names


MODES = ("blocks", "lines", "whole")
QUOTES = "length(value) - length(replace(value, '\"', ''))"


def _pattern(sep: str) -> str:
    return sep.replace("\t", r"\t")


def _bare(record: str, sep: str) -> str:
    """SQL text: a record without its quoted fields (doubled quotes first), so every quote left is out of place."""
    return f"""regexp_replace(replace({record}, '""', ''), r'(?<=^|{_pattern(sep)}|[\n])"[^"]*+"(?=$|{_pattern(sep)}|[\r\n])', '')"""


def _surplus(record: str, sep: str, fields: int) -> str:
    """SQL text: the record has more fields than the header (separators inside quotes do not count)."""
    bare = f"""regexp_replace({record}, '"[^"]*+"', '')"""
    return f"({record} IS NOT NULL AND length({bare}) - length(replace({bare}, '{sep}', '')) >= {fields})"


def require_whole_lines(spark: SparkSession, path: str) -> None:
    """Fail if a line has an unclosed quote: its record goes on in the next line."""
    n = spark.read.text(path).selectExpr(f"count_if(({QUOTES}) % 2 = 1) AS n").first()["n"]
    if n:
        raise MalformedFile(f"{path}: {n} lines have an unclosed quote; read it by blocks")


def records(spark: SparkSession, path: str) -> DataFrame:
    """(file, record, header): the records of files whose quoted fields may span lines, every split of a file in a task of its own.

    A line starts a record if the number of quotes before it in its file is even. The lines of a split are counted where they are,
    in one pass with a running sum; one row per split tells the parity at its start and where a record that is open there began.
    Only lines of records with several lines are grouped.
    """
    lines = (spark.read.option("lineSep", "\n").text(path)
             .selectExpr("_metadata.file_path AS file", "_metadata.file_block_start AS block", "value", f"({QUOTES}) % 2 AS odd")
             .withColumn("seq", F.monotonically_increasing_id()))
    upto = Window.partitionBy("file", "block").orderBy("seq")
    lines = lines.withColumn("before", F.expr("sum(odd)").over(upto) - F.col("odd"))
    # One row per split: quotes in it, and how many of its lines start a record if it begins outside or inside a field.
    splits = lines.groupBy("file", "block").agg(F.sum("odd").alias("odd"), F.count_if(F.col("before") % 2 == 0).alias("outside"),
                                               F.count_if(F.col("before") % 2 == 1).alias("inside"))
    earlier = Window.partitionBy("file").orderBy("block")
    splits = splits.withColumn("open", (F.sum("odd").over(earlier) - F.col("odd")) % 2)
    splits = splits.withColumn("starts", F.when(F.col("open") == 0, F.col("outside")).otherwise(F.col("inside")))
    owner = F.last(F.when(F.col("starts") > 0, F.struct(F.col("block").alias("block"), F.col("starts").alias("nth"))), ignorenulls=True)
    splits = splits.withColumn("owner", owner.over(earlier.rowsBetween(Window.unboundedPreceding, -1)))
    splits = splits.withColumn("unclosed", F.sum("odd").over(Window.partitionBy("file")) % 2)
    rows = lines.join(splits.select("file", "block", "open", "owner", "unclosed"), ["file", "block"])
    rows = rows.withColumn("start", ((F.col("before") + F.col("open")) % 2 == 0).cast("int"))
    rows = rows.withColumn("nth", F.sum("start").over(upto))
    own = F.struct("block", "nth")
    rows = rows.withColumn("key", F.when(F.col("nth") > 0, own).otherwise(F.col("owner")))
    first = (F.col("key.block") == 0) & (F.col("key.nth") == 1)
    rows = rows.withColumn("header", first)
    single = rows.where("start = 1 AND odd = 0").selectExpr("file", "value AS record", "header", "unclosed")
    several = rows.where("start = 0 OR odd = 1").groupBy("file", "key", "header", "unclosed").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "seq", "value"))), lambda x: x["value"]), "\n").alias("record"))
    return single.unionByName(several.select("file", "record", "header", "unclosed"))


def _read_blocks(spark: SparkSession, path: str, sep: str, names: list[str]) -> DataFrame:
    """All columns as text, with the flag of records that have surplus fields or a quote out of place."""
    found = records(spark, path).where("NOT header")
    head = spark.read.option("lineSep", "\n").text(path).limit(1).collect()
    if head and head[0][0].endswith("\r"):                   # lines end in two characters, also inside fields
        found = found.withColumn("record", F.replace("record", F.lit("\r\n"), F.lit("\n")))
    found = found.withColumn("record", F.regexp_replace("record", "\r$", "")).where("record <> ''")       # empty lines are no records
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    options = {"sep": sep, "quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE"}
    fields = F.from_csv("record", schema, options)
    bad = F.expr(f"unclosed = 1 OR {_surplus('record', sep, len(names))} OR contains({_bare('record', sep)}, '\"')")
    return found.select(fields.alias("fields"), bad.alias(MALFORMED)).select("fields.*", MALFORMED)


def read_delimited(spark: SparkSession, path: str, sep: str | None = None, mode: str = "blocks") -> DataFrame:
    """Header row, all columns STRING, missing-value tokens -> NULL.

    Invalid UTF-8 bytes are replaced by U+FFFD by the reader. Short rows are
    filled with NULL; rows with surplus fields, and by blocks also rows with a quote out of place, are flagged in ``_malformed``
    and stop the load.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    line = first_line(spark, path)
    sep = sep or separator_of(line)
    names = header_names(line, sep)
    if mode == "blocks":
        return null_tokens(_read_blocks(spark, path, sep, names), names)
    if mode == "lines":
        require_whole_lines(spark, path)
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in [*names, _RECORD])
    df = (spark.read.schema(schema).option("header", True).option("sep", sep).option("quote", '"')
          .option("escape", '"').option("multiLine", mode == "whole").option("columnPruning", False)
          .option("enforceSchema", True).option("columnNameOfCorruptRecord", _RECORD)
          .option("mode", "PERMISSIVE").option("encoding", "UTF-8").csv(path))
    flagged = df.withColumn(MALFORMED, F.expr(_surplus(_RECORD, sep, len(names)))).drop(_RECORD)
    return null_tokens(flagged, names)


def extract(spark: SparkSession, raw_dir: str, name: str, mode: str = "blocks") -> DataFrame:
    """Resolve a logical raw file name and read it."""
    path = resolve(spark, raw_dir, name)
    if path.endswith(".parquet"):
        return null_tokens(spark.read.parquet(path))
    return read_delimited(spark, path, mode=mode)
