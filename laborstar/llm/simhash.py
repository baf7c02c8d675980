"""SimHash near-dedup over a table of distances to reference fingerprints (pivots).

Fingerprint of a text: A-Z lower-cased, words without ASCII white space, shingles of three words
joined by a space (fewer words: the whole sequence; none: fingerprint zero), XXH64 of each shingle
with seed 42; a bit is 1 if it is set in over half of the hashes. Fingerprints link at two or fewer
differing bits.

The pivots are the zero fingerprint and 32 fingerprints of two set bits each, on disjoint bits. The
distance to a pivot minus the distance to zero depends on that pivot's two bits only, so two bits of
difference change at most two of these 32 coordinates. The pivots are dealt to five groups, of which
at least three stay equal: ten equality keys, made of the coordinates of three groups each, hold
every linked pair. Within a key, pairs are discarded when any pivot distance differs by more than
two, and survivors are verified by their bits.

Work is per distinct fingerprint, so a group of exact copies is one row. A key with more than
``BUCKET`` fingerprints never emits its pairs: its members emit the 65 fingerprints within one bit,
and two fingerprints are within two bits exactly if they emit a common one. A common point has at
most 65 members, which are linked to the smallest.

Edge cases: null and empty texts have fingerprint zero and are linked like any other; a null doc_id
takes part and is never a component's id unless all ids are null; repeated rows and ids are rows of
their own; other columns are passed through.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from laborstar.llm._columns import hex64, like
from laborstar.llm._graph import components
from laborstar.llm._store import stored

SHINGLE = 3
SEED = 42
MAX_BITS = 2
BUCKET = 32
PIVOTS = [3 << 2 * j for j in range(32)]
GROUPS = 5
KEYS = list(combinations(range(GROUPS), GROUPS - MAX_BITS))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint_of(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned 64-bit fingerprint of one text."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = (ends - [len(w) + 1 for w in words]).tolist()
    ends = (ends - 1).tolist()
    if len(words) > shingle:
        starts, ends = starts[:len(words) - shingle + 1], ends[shingle - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    count = np.zeros(64, np.int64)
    for i in range(0, len(starts), 1 << 14):
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[i:i + (1 << 14)], ends[i:i + (1 << 14)])], "<u8")
        count += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * count > len(starts), bitorder="little").view("<u8")[0])


@F.arrow_udf(LongType())
def fingerprint(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for part in parts:
        yield pa.array([_signed(fingerprint_of(t.as_py())) for t in part], pa.int64())


def pivot_distances(fp: Column) -> list[Column]:
    """Distances to the zero fingerprint and to every pivot."""
    return [F.bit_count(fp), *(F.bit_count(fp.bitwiseXOR(F.lit(_signed(p)))) for p in PIVOTS)]


def pivot_keys(fp: Column) -> Column:
    """Hashes of the pivot coordinates of every choice of three groups."""
    zero, *rest = pivot_distances(fp)
    return F.array(*[F.xxhash64(F.lit(i), *[d - zero for j, d in enumerate(rest) if j % GROUPS in groups])
                     for i, groups in enumerate(KEYS)])


def _pairs(keyed: DataFrame, few: DataFrame) -> DataFrame:
    """Verified links inside keys of at most BUCKET fingerprints."""
    members = keyed.join(few, "key")
    both = members.select("key", F.col("fp").alias("u")).join(members.select("key", F.col("fp").alias("v")), "key").where("u < v")
    u, v = pivot_distances(F.col("u")), pivot_distances(F.col("v"))
    near = F.greatest(*[F.abs(a - b) for a, b in zip(u, v)]) <= MAX_BITS
    return both.where(near).where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= MAX_BITS).select("u", "v")


def _stars(keyed: DataFrame, many: DataFrame) -> DataFrame:
    """Links of the fingerprints in larger keys, through the fingerprints within one bit of them."""
    fp = F.col("fp")
    around = F.array(fp, *[fp.bitwiseXOR(F.lit(_signed(1 << i))) for i in range(64)])
    points = (keyed.join(many, "key").select("fp").distinct().select("fp", F.explode(around).alias("point"))
              .groupBy("point").agg(F.collect_list("fp").alias("near")).where(F.size("near") > 1))   # at most 65 each
    return points.select(F.explode("near").alias("u"), F.array_min("near").alias("v")).where("u <> v")


def links(distinct: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Links (u, v) that connect all fingerprints within MAX_BITS; ``distinct`` has one row per fp."""
    keyed = distinct.select("fp", F.explode(pivot_keys(F.col("fp"))).alias("key"))
    sizes = stored(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "pivot-keys")
    few, many = (sizes.where(c).select("key") for c in (F.col("n") <= bucket, F.col("n") > bucket))
    return _pairs(keyed, few).unionByName(_stars(keyed, many))


def classes(docs: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """One row per document: id, h (hash of its text), fp, root (key of its group), component_id."""
    rows = stored(docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("h"), fingerprint("text").alias("fp")), "fingerprints")
    distinct = stored(rows.groupBy("fp").agg(F.min("id").alias("least")), "distinct-fingerprints")
    linked = stored(components(links(distinct, bucket)).join(distinct, F.col("node") == F.col("fp")).select("fp", "root", "least"), "linked")
    groups = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    known = linked.select("fp", "root").join(groups, "root")
    every = distinct.join(known, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"),
        F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("component_id")).alias("component_id"))
    return rows.join(every, "fp").select("id", "h", "fp", "root", "component_id")


def report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, fingerprint, component_id."""
    return classes(docs.select("doc_id", "text")).select(F.col("id").alias("doc_id"), hex64(F.col("fp")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame) -> DataFrame:
    """One document of every group, the one with the smallest doc_id (then text hash), with all its columns."""
    first = (classes(docs.select("doc_id", "text")).groupBy("root")
             .agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "h")).alias("first"))
             .select(F.coalesce(F.col("first.id").cast("string"), F.lit("-")).alias("__id"), F.col("first.h").alias("__h")))
    keyed = docs.withColumns({"__id": F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "__h": F.xxhash64("text")})
    return like(keyed.join(first, ["__id", "__h"], "left_semi").dropDuplicates(["__id", "__h"]), docs)
