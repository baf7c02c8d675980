"""Mixing sources to target weights, in fixed-length blocks of words.

1. Targets. Sources in code point order (null last) weigh 1, 2, 3, 1, 2, 3, ... and share the words of
   all documents; a target stops at ``MAX_EPOCHS`` times its source's words and the excess is shared
   again by weight. With sources in order of cap / weight, the capped ones are a prefix, so running
   sums give the level of the others at once.
2. Blocks. The documents of a source are dealt into hash buckets of about ``BUCKET_DOCS``, so a source with a third of all rows is
   many groups. A bucket's documents form one stream of words, cut into blocks of ``BLOCK`` words (its last one may be
   shorter); a block's index is its place in the bucket plus the blocks of the source's buckets before.
3. Draws. The output is made of shards of ``SHARD`` slots. A shard gives every source the whole part of
   its expected slots; the remaining slots are a multinomial draw with the fractional parts as
   probabilities. So every shard, and the sum of all, stays within a few blocks of the target.
4. Slots. A source's slots are numbered through all shards. Slot j is in epoch j / blocks, and its
   place in the epoch goes through a pseudorandom permutation of the block numbers (swap-or-not
   rounds, a bijection for any number of blocks). Slots beyond ``MAX_EPOCHS`` epochs stay empty.
5. Slots look up the bucket of their block and go there with the texts, in the only shuffle that moves texts: a bucket cuts its
   texts into pieces, packs them into blocks, and every slot gets its block. Blocks keep the document and word count of each
   piece. The mix is written to the shared folder, and what it took of each document is counted from there.

Everything random is a hash of the seed, the source's rank and an index, so reruns agree. Sources are a table like any other, one
row each; ranks and levels are windows over these rows, nothing of them is held by the driver.

Edge cases: null text has size 0 and takes 0; a null source is a source, the last one; repeated rows and
ids are documents of their own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from laborstar.llm._columns import blank_words
from laborstar.llm._store import stored

BLOCK = 64
SHARD = 1 << 16
MAX_EPOCHS = 3
WEIGHTS = (1, 2, 3)
ROUNDS = 16
SEED = 7
BUCKET_DOCS = 1_000
WIDTH = 1_024             # rows of a running sum that one window adds up
CELL = 4_096              # points of a range that one lookup key covers


def targets(sizes: DataFrame) -> DataFrame:
    """Per source: source, rank (code point order, null last), docs, source_size, weight, target."""
    found = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())                     # one row per source
    found = found.withColumn("rank", F.row_number().over(by_name) - 1)
    found = found.withColumn("weight", F.get(F.array(*[F.lit(w) for w in WEIGHTS]), F.col("rank") % len(WEIGHTS)).cast("decimal(38,0)"))
    cap = F.col("source_size").cast("decimal(20,0)") * MAX_EPOCHS
    by_level = Window.orderBy(cap / F.col("weight"), "rank")
    before, everything = by_level.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(before), F.lit(0))
    weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    found = found.withColumn("stops", cap * weight <= left * F.col("weight"))
    found = found.withColumn("stops", F.min("stops").over(by_level.rowsBetween(Window.unboundedPreceding, 0)))
    rest = [F.sum(F.when(~F.col("stops"), x).otherwise(0)).over(everything).cast("double") for x in (F.lit(1), F.col("weight"))]
    excess = (F.sum("source_size").over(everything) - F.sum(F.when(F.col("stops"), cap).otherwise(0)).over(everything)).cast("double")
    target = F.when(F.col("stops"), cap.cast("double")).otherwise(excess * F.col("weight").cast("double") / rest[1])
    return found.select("source", "rank", "docs", "source_size", F.col("weight").cast("int").alias("weight"), target.alias("target"))


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from a hash."""
    return F.pmod(F.xxhash64(F.lit(SEED), *parts), F.lit(1 << 40)) / F.lit(float(1 << 40))


def running(rows: DataFrame, group: list[str], at: str, n: str, name: str = "before") -> DataFrame:
    """``rows`` with the sum of ``n`` over the rows of the group that come earlier by ``at`` (a number), in two levels, so
    that no window holds more than WIDTH rows or one row per WIDTH of them."""
    rows = rows.withColumn("__part", F.floor(F.col(at) / WIDTH))
    inner = Window.partitionBy(*group, "__part").orderBy(at)
    outer = Window.partitionBy(*group).orderBy("__part")
    parts = rows.groupBy(*group, "__part").agg(F.sum(n).alias("__sum"))
    parts = parts.select(*group, "__part", (F.sum("__sum").over(outer) - F.col("__sum")).alias("__whole"))
    rows = rows.withColumn(name, F.sum(n).over(inner) - F.col(n))
    return rows.join(parts, [*group, "__part"]).withColumn(name, F.col(name) + F.col("__whole")).drop("__part", "__whole")


def located(points: DataFrame, ranges: DataFrame, group: list[str], at: str, start: str, n: str) -> DataFrame:
    """``points`` with the columns of the range of their group (start .. start + n - 1) that holds ``at``. Ranges and points meet
    by cells of CELL points, so a large group is many keys."""
    cells = F.sequence(F.floor(F.col(start) / CELL), F.floor((F.col(start) + F.col(n) - 1) / CELL))
    spans = ranges.where(F.col(n) > 0).withColumn("__cell", F.explode(cells))
    met = points.withColumn("__cell", F.floor(F.col(at) / CELL)).join(spans, [*group, "__cell"])
    return met.where((F.col(at) >= F.col(start)) & (F.col(at) < F.col(start) + F.col(n))).drop("__cell")


def shard_counts(sources: DataFrame, shard: int = SHARD) -> DataFrame:
    """(shard, rank, n): slots of each source (rank, source_size, blocks, target) in each shard."""
    spark = sources.sparkSession
    expected = F.when(F.col("source_size") > 0, F.col("target") * F.col("blocks") / F.col("source_size")).otherwise(0.0)
    sources = sources.select("rank", expected.alias("expected"))
    total = sources.agg(F.sum("expected").alias("n")).first()["n"] or 0.0
    shards = max(1, round(total / shard))
    sources = sources.withColumn("quota", F.col("expected") / shards).withColumn("whole", F.floor("quota").cast("long"))
    each = sources.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"), "rank", F.col("whole").alias("n"))
    # The fractions in units of 2^-40, one after the other, are the ranges that a draw falls into.
    unit = 1 << 40
    parts = stored(sources.select("rank", F.floor((F.col("quota") - F.col("whole")) * unit).cast("long").alias("part"), F.lit(0).alias("all")), "fractions")
    rest = (parts.agg(F.sum("part").alias("n")).first()["n"] or 0) / unit
    parts = running(parts, ["all"], "rank", "part").drop("all")
    t = spark.range(shards).select(F.col("id").alias("shard"))
    draws = t.select("shard", (F.floor(F.lit(rest)) + (uniform(F.lit("draws"), F.col("shard")) < rest - int(rest)).cast("long")).alias("draws"))
    draws = draws.where("draws > 0").select("shard", F.explode(F.sequence(F.lit(1).cast("long"), F.col("draws"))).alias("draw"))
    draws = draws.withColumn("at", F.floor(uniform(F.lit("source"), F.col("shard"), F.col("draw")) * rest * SPREAD).cast("long"))
    scaled = parts.select("rank", F.floor(F.col("before") / (unit // SPREAD)).cast("long").alias("start"),
                          (F.floor((F.col("before") + F.col("part")) / (unit // SPREAD)) - F.floor(F.col("before") / (unit // SPREAD))).cast("long").alias("size"))
    drawn = located(draws, scaled, [], "at", "start", "size").select("shard", "rank", F.lit(1).cast("long").alias("n"))
    return each.unionByName(drawn).groupBy("shard", "rank").agg(F.sum("n").alias("n")).where("n > 0")


SPREAD = 1 << 20          # points that the fractions of one slot are told apart by


def permuted(i: Column, n: Column, *key: Column) -> Column:
    """A pseudorandom permutation of 0 .. n-1 by swap-or-not rounds."""
    def swap(x: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(F.lit("key"), r, *key), n) + n - x, n)
        chosen = F.xxhash64(F.lit("bit"), r, F.greatest(x, other), *key).bitwiseAND(F.lit(1)) == 1
        return F.when(chosen, other).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), i, swap)


def slots(sources: DataFrame, shard: int = SHARD) -> DataFrame:
    """The mix: (shard, rank, slot, block), slot numbered per source."""
    spark = sources.sparkSession
    counts = stored(shard_counts(sources, shard), "shard-counts")
    numbered = running(counts, ["rank"], "shard", "n", "from").join(sources.select("rank", "blocks"), "rank")
    # Few rows that become very many: dealt out by number, or adaptive execution would put them into one task.
    numbered = numbered.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "shard", "rank")
    each = (numbered.select("shard", "rank", "blocks", F.explode(F.sequence(F.col("from"), F.col("from") + F.col("n") - 1)).alias("slot"))
            .where(F.col("slot") < MAX_EPOCHS * F.col("blocks")))
    epoch = F.floor(F.col("slot") / F.col("blocks"))
    place = permuted(F.pmod(F.col("slot"), F.col("blocks")), F.col("blocks"), F.lit(SEED), F.col("rank"), epoch)
    return each.select("shard", "rank", "slot", place.alias("block"))


def sized(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("h"), F.col("source").cast("string").alias("source"),
                       F.size(blank_words(F.col("text"))).cast("long").alias("size"), "text")


def ranked(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows with id, h and source, with the source's rank and figures, and their bucket."""
    known = sources.select(F.col("source").alias("src"), "rank", "source_size", "target", "docs")
    rows = rows.join(known, rows["source"].eqNullSafe(known["src"])).drop("source", "src")
    buckets = F.floor(F.col("docs") / BUCKET_DOCS) + 1
    return rows.withColumn("bucket", F.pmod(F.xxhash64(F.lit(SEED), "id", "h"), buckets).cast("int")).drop("docs")


def placed(rows: DataFrame) -> DataFrame:
    """Every ranked row with its place in its bucket: nth, and offset in words. Rows with ``guest`` (slots) have none and come first."""
    inside = Window.partitionBy("rank", "bucket").orderBy(F.col("guest").desc(), "id", "h").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumns({"nth": F.sum(1 - F.col("guest")).over(inside), "offset": F.sum("size").over(inside) - F.col("size")})


def pieces(w: Column) -> Column:
    """The words of a text cut at block ends: structs of block (in the bucket) and piece (offset, nth, id, words, text)."""
    end = F.col("offset") + F.col("size")

    def piece(block: Column) -> Column:
        start, stop = F.greatest(F.col("offset"), block * BLOCK), F.least(end, (block + 1) * BLOCK)
        text = F.array_join(F.slice(w, (start - F.col("offset") + 1).cast("int"), (stop - start).cast("int")), " ")
        return F.struct(block.alias("block"), F.struct(start.alias("offset"), "nth", "id", (stop - start).alias("words"), text.alias("text")).alias("piece"),
                        F.lit(None).cast(SLOT).alias("slot"))

    return F.transform(F.sequence(F.floor(F.col("offset") / BLOCK), F.floor((end - 1) / BLOCK)), piece)


PIECE = "struct<offset:bigint,nth:bigint,id:{id},words:bigint,text:string>"
SLOT = "struct<shard:bigint,slot:bigint,source:string,index:bigint>"


def plan(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The documents' sizes (id, h, source, size), their sources with numbers of blocks, and the buckets (rank, bucket, blocks, before); all stored."""
    sizes = stored(sized(docs).drop("text"), "sizes")
    sources = stored(targets(sizes), "sources")
    words = ranked(sizes, sources).groupBy("rank", "bucket").agg(F.sum("size").alias("words"))
    buckets = words.select("rank", "bucket", F.ceil(F.col("words") / BLOCK).cast("long").alias("blocks"))
    buckets = stored(running(stored(buckets, "bucket-blocks"), ["rank"], "bucket", "blocks"), "buckets")
    blocks = buckets.groupBy("rank").agg(F.sum("blocks").alias("blocks"))
    return sizes, stored(sources.join(blocks, "rank"), "source-blocks"), buckets


def _mixed(docs: DataFrame, shard: int) -> tuple[DataFrame, DataFrame]:
    """The mix, and the placed documents without their texts."""
    sizes, sources, buckets = plan(docs)
    wanted = located(slots(sources, shard), buckets, ["rank"], "block", "before", "blocks").join(sources.select("rank", "source"), "rank")
    own = F.struct((F.col("block") - F.col("before")).alias("block"), F.struct("shard", "slot", "source", F.col("block").alias("index")).alias("slot"))
    wanted = wanted.select("rank", "bucket", F.lit(1).alias("guest"), own.alias("own"))
    rows = docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("h"), F.col("source").cast("string").alias("source"), "text")
    texts = ranked(rows, sources).select("rank", "bucket", F.lit(0).alias("guest"), "id", "h", "text")
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = texts.unionByName(wanted, allowMissingColumns=True).repartition(tasks, "rank", "bucket").withColumn("w", blank_words(F.col("text"))).drop("text")
    met = placed(met.withColumn("size", F.size("w").cast("long")).where("guest = 1 or size > 0"))
    kind = PIECE.format(id=docs.schema["doc_id"].dataType.simpleString())
    guest = F.array(F.struct(F.col("own.block").alias("block"), F.lit(None).cast(kind).alias("piece"), F.col("own.slot").alias("slot")))
    each = met.select("rank", "bucket", F.explode(F.when(F.col("guest") == 1, guest).otherwise(pieces(F.col("w")))).alias("x"))
    block = each.groupBy("rank", "bucket", "x.block").agg(F.array_sort(F.collect_list("x.piece")).alias("pieces"), F.collect_list("x.slot").alias("slots"))
    block = block.select("rank", "bucket", F.array_join(F.transform("pieces", lambda x: x["text"]), " ").alias("text"),
                         F.transform("pieces", lambda x: x.dropFields("offset", "text")).alias("pieces"), F.inline("slots"))
    mix = block.select("shard", "slot", "rank", "source", F.col("index").alias("block"), "bucket", "text", "pieces")
    return mix, placed(ranked(sizes, sources).withColumn("guest", F.when(F.col("size") > 0, 0).otherwise(1)))


def mixed_blocks(docs: DataFrame, shard: int = SHARD) -> DataFrame:
    """The mix itself: one row per slot with its shard, source, the words of its block, and the pieces (nth in the bucket, id, words) in it."""
    return _mixed(docs, shard)[0]


def report(docs: DataFrame, name: str = "mix", shard: int = SHARD) -> DataFrame:
    """Writes the mix to the shared folder. One row per document: doc_id, size, source_size, target, taken (its words in the mix)."""
    mix, documents = _mixed(docs, shard)
    mix = stored(mix, name)
    taken = (mix.select("rank", "bucket", F.explode("pieces").alias("p")).groupBy("rank", "bucket", "p.nth").agg(F.sum("p.words").alias("taken")))
    # Documents without words are in no block; their number is the next one's.
    documents = documents.withColumn("nth", F.when(F.col("guest") == 0, F.col("nth")))
    return documents.join(taken, ["rank", "bucket", "nth"], "left").select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
