"""Document fingerprints by winnowing.

A text's tokens (lower case) are hashed; every ``GRAM`` consecutive tokens have a rolling
polynomial hash modulo a prime, H(i) = x(i) B + x(i+1). Of every ``WINDOW``
consecutive gram hashes the least is chosen, the rightmost of equal ones; the chosen hashes with their positions are
the fingerprint. Two texts that share WINDOW + GRAM - 1 = 3 tokens in a row share a chosen hash.

Tokens are the words between white space, by one rule for all texts: code points from U+0800 on (scripts without blanks between
words, as Chinese) are tokens of their own, and another word of more than ``LONG`` code points (a URL) is cut into
pieces of ``PIECE``. So any two fingerprints can be compared, and likeness is always that of the returned hashes.

Hash and position are packed into one long, so a window's choice is a minimum, and the minima of all windows
come from repeated halving: least of neighbours 1, 2, 4, ... apart. All of it runs on arrays inside the
row; nothing is exploded. The fingerprint reads ``hash@position`` for every choice; likeness is the
Jaccard index of the chosen hashes (both empty: 1).

The query also needs the next document in descending doc_id order. Rows are dealt to ranges of doc_id
(approximate quantiles, ``RANGES`` per shuffle partition); a range also gets a copy of the first row of the range
that follows. So one shuffle carries each text once and no task sees more than a range.

Edge cases: null text is empty, with 0 characters and an empty fingerprint; fewer than GRAM tokens are one gram,
fewer than WINDOW grams one window; null ids come last, equal ids are ordered by text hash and text; a single
document follows itself; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from laborstar.llm._columns import BLANKS

GRAM = 2
WINDOW = 2
LONG = 16
PIECE = 4
# One code point from U+0800 on, and one below.
WIDE, NARROW = r"[^\x00-\x{7FF}]", r"[\x00-\x{7FF}]"
PRIME = (1 << 31) - 1
BASE = 1_103_515_245 % PRIME
LAST = (1 << 31) - 1        # positions are stored as LAST - position, so that the least packed value is the rightmost
RANGES = 4


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often ``use`` names it and wherever the plan moves it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _halves(values: Column, apart: int, join) -> Column:
    """join(v[i], v[i + apart]) for all i that have both."""
    def pairs(v: Column) -> Column:
        n = F.greatest(F.size(v) - apart, F.lit(0))
        return F.zip_with(F.slice(v, 1, n), F.slice(v, apart + 1, n), join)

    return let(values, pairs)


def _roll(factor: int):
    return lambda a, b: (a * F.lit(factor) + b) % F.lit(PRIME)


def _grams(x: Column, gram: int) -> Column:
    """Rolling hashes of ``gram`` consecutive hashes; of all of them if they are fewer."""
    whole = F.array(_hash(F.xxhash64(x)))
    rolled, power = x, 1
    while power < gram:                                     # hashes of 1, 2, 4, ... words
        rolled = _halves(rolled, power, _roll(pow(BASE, power, PRIME)))
        power *= 2
    return F.when(F.size(x) >= gram, rolled).when(F.size(x) > 0, whole).otherwise(x)


def _choices(v: Column) -> Column:
    """Distinct minima of all windows of packed values, in text order."""
    least, apart = v, 1
    while apart < WINDOW:
        least = _halves(least, apart, lambda a, b: F.least(a, b))
        apart *= 2
    return F.when(F.size(v) >= WINDOW, F.array_distinct(least)).when(F.size(v) > 0, F.array(F.array_min(v))).otherwise(v)


def _hash(x: Column) -> Column:
    """31 bits of a hash, modulo the prime."""
    return F.pmod(x, F.lit(PRIME))


def _pieces(word: Column) -> Column:
    """The tokens of one word."""
    def cut(run: Column) -> Column:
        n = F.char_length(run)
        at = F.sequence(F.lit(1), F.greatest(n, F.lit(1)), F.lit(PIECE))
        return F.when(n > LONG, F.transform(at, lambda i: F.substring(run, i, F.lit(PIECE)))).otherwise(F.array(run))

    runs = F.regexp_extract_all(word, F.lit(rf"({WIDE}|{NARROW}+)"), F.lit(1))
    return F.when(word.rlike(WIDE), F.flatten(F.transform(runs, cut))).otherwise(cut(word))


def tokens(text: Column) -> Column:
    """The tokens of a text; null has none."""
    text = F.lower(F.trim(F.coalesce(text, F.lit("")), F.lit(BLANKS)))
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    # Most texts have no word to cut.
    return F.when(text.rlike(rf"{WIDE}|[^\x20\x09-\x0D]{{{LONG + 1}}}"), F.flatten(F.transform(words, _pieces))).otherwise(words)


def packed(text: Column) -> Column:
    """The packed choices of a text, in text order."""
    x = F.transform(tokens(text), lambda w: _hash(F.xxhash64(w)))
    v = F.transform(let(x, lambda y: _grams(y, GRAM)), lambda h, i: h * F.lit(1 << 31) + (F.lit(LAST) - i))
    return let(v, _choices)


def hashes(choices: Column) -> Column:
    return F.transform(choices, lambda v: F.shiftright(v, 31))


def readable(choices: Column) -> Column:
    return F.array_join(F.transform(choices, lambda v: F.concat(
        F.lower(F.hex(F.shiftright(v, 31))), F.lit("@"), (F.lit(LAST) - v.bitwiseAND(F.lit(LAST))).cast("string"))), " ")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard index of two arrays of hashes."""
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(
        F.size(F.array_intersect(a, b)) / F.greatest(F.size(F.array_union(a, b)), F.lit(1)).cast("double"))


def with_next(docs: DataFrame, build) -> DataFrame:
    """Rows (doc_id, text, ...) with ``next``: the struct of the columns that ``build`` made for the next document."""
    n = RANGES * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at = docs.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 10 * n).alias("at")).first()["at"] or []
    bounds = F.array(*[F.lit(b) for b in sorted(set(at))]).cast("array<long>")
    part = F.when(F.col("doc_id").isNull(), -1).otherwise(F.size(F.filter(bounds, lambda b: F.col("doc_id") > b)))
    ranged = docs.withColumn("part", part)
    heads = ranged.groupBy("part").agg(F.max("doc_id").alias("head"))                  # one row per range
    down = Window.orderBy(F.col("part").desc())
    every = down.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    guests = heads.select("head", F.coalesce(F.lag("part").over(down), F.min("part").over(every)).alias("guest"))   # the first row follows the last range
    rows = ranged.join(F.broadcast(guests), F.col("doc_id").eqNullSafe(F.col("head")), "left").drop("head")
    places = F.array_compact(F.array(F.struct("part", F.lit(False).alias("guest")),
                                     F.when(F.col("guest").isNotNull(), F.struct(F.col("guest").alias("part"), F.lit(True).alias("guest")))))
    rows = rows.withColumn("place", F.explode(places)).drop("part", "guest").select("*", "place.part", "place.guest").drop("place")
    rows = build(rows.repartition("part"))                  # after the shuffle, which carries texts only
    order = Window.partitionBy("part").orderBy("guest", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), "text")
    return rows.withColumn("next", F.lead(F.struct("text", "own")).over(order)).where(~F.col("guest")).drop("part", "guest")


def report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(rows, lambda df: df.withColumn("own", packed(F.col("text"))))
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next.text"), F.lit(1), half))
    rows = rows.withColumns({"n_chars": n.cast("long"), "edited": edited}).withColumn("other", packed(F.col("edited")))
    return rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), readable(F.col("own")).alias("fingerprint"),
                       readable(F.col("other")).alias("edited_fingerprint"),
                       likeness(hashes(F.col("own")), hashes(F.col("other"))).alias("near_edited"),
                       likeness(hashes(F.col("own")), hashes(F.col("next.own"))).alias("near_next"))
