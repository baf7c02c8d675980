"""Benchmark decontamination through a distributed positional inverted index.

Words: A-Z lower-cased, then runs of digits, a-z and everything beyond ASCII. A window is ten
consecutive words of a benchmark item; an item of fewer words, but not none, is one window.

1. Corpus counts of all benchmark terms, over all documents. A window with a term that the corpus
   lacks cannot occur and is left out.
2. The index: postings (term, document, position) of the two rarest terms of every window, stored.
3. Intersection from the rarest term: its postings, shifted by its offset in the window, give the
   possible starts; they are joined with the postings of the second rarest term at its own offset.
4. The other terms of the few remaining starts are read from the words of their documents, inside the row: exact
   phrases at slop 0; with ``slop`` > 0 also proximity matches, in which every term of the window has a word of its own at
   most ``slop`` words from its place (so a repeated term needs as many words), the window itself being inside the text.

Documents are split into words inside the scan, and only postings are shuffled. Whether a benchmark-side table or
the keys of candidate documents are broadcast is left to Spark, which compares the bytes of the stored tables with
``spark.sql.autoBroadcastJoinThreshold``; beyond it a frequent term is split by AQE.

Edge cases: null and empty texts have no words and are never contaminated; rows are keyed by
(doc_id, text hash), so repeated ids and null ids keep their own results; an item with a null id
marks words but is not listed; an empty benchmark marks nothing; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laborstar.llm._columns import ascii_lower, like
from laborstar.llm._store import stored
from laborstar.llm.fingerprint import let

WINDOW = 10
NO_ID = -(1 << 63)
ROW = ["id", "h"]


def words(text: Column) -> Column:
    """Benchmark words of a text; null has none."""
    parts = F.split(ascii_lower(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    return F.array_remove(parts, "")


def keyed(docs: DataFrame) -> DataFrame:
    """(id, h, text): the row key stands for a text, so a sentinel for null ids changes nothing."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64("text").alias("h"), "text")


def windows(items: DataFrame, size: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Distinct windows (win, terms) and their items (win, item)."""
    split = items.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))
    cut = split.select("item", "w", F.explode(starts).alias("at")).select("item", F.slice("w", F.col("at"), size).alias("terms"))
    cut = stored(cut.withColumn("win", F.array_join("terms", " ")), "benchmark-windows")
    return cut.select("win", "terms").dropDuplicates(["win"]), cut.select("win", "item").distinct()


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Occurrences of the terms in all documents."""
    tokens = docs.select(F.explode(words(F.col("text"))).alias("term"))
    return tokens.join(terms, "term", "left_semi").groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def seeds(wins: DataFrame, counts: DataFrame) -> DataFrame:
    """Per window that can occur: its number (a hash) and terms, and its two rarest terms with their offsets."""
    at = wins.select("win", "terms", F.posexplode("terms").alias("offset", "term"))
    ranked = (at.join(counts, "term").groupBy("win", "terms")
              .agg(F.array_sort(F.collect_list(F.struct("n", "offset", "term"))).alias("by")))     # at most ten
    rarest, second = F.get("by", F.lit(0)), F.coalesce(F.get("by", F.lit(1)), F.get("by", F.lit(0)))
    return ranked.where(F.size("by") == F.size("terms")).select(
        F.xxhash64("win").alias("w"), "win", "terms", rarest["term"].alias("term"), rarest["offset"].alias("offset"),
        second["term"].alias("term2"), second["offset"].alias("offset2"))


def postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """The positional inverted index of the given terms: (term, id, h, pos)."""
    tokens = docs.select("id", "h", F.posexplode(words(F.col("text"))).alias("pos", "term"))
    return tokens.join(terms, "term", "left_semi").select("term", "id", "h", "pos")


def candidates(index: DataFrame, seed: DataFrame, slop: int = 0) -> DataFrame:
    """Offset-adjusted intersection of the lists of the two rarest terms, each up to ``slop`` words from its place: (id, h, w, start)."""
    lookup = seed.select("w", "term", "offset", "term2", "offset2")
    shifts = F.array(*[F.lit(s) for s in range(-slop, slop + 1)])
    first = (index.join(lookup, "term").select("id", "h", "w", F.explode(F.transform(shifts, lambda s: F.col("pos") - F.col("offset") + s)).alias("start"),
                                              "term2", "offset2").where("start >= 0").distinct())
    second = index.select("id", "h", F.col("term").alias("term2"), F.col("pos").alias("pos2"))
    both = (first.withColumn("pos2", F.explode(F.transform(shifts, lambda s: F.col("start") + F.col("offset2") + s)))
            .join(second, ["id", "h", "term2", "pos2"], "left_semi"))
    return both.select("id", "h", "w", "start").distinct()


def _near(text: Column, terms: Column, start: Column, slop: int) -> Column:
    """Every term has a word of its own within ``slop`` of its place. Terms take the first word that is left, in order of their
    places, which finds such words if there are any: the reaches are equally long."""
    def take(used: Column, i: Column) -> Column:
        at = start + i
        reach = F.sequence(F.greatest(at - slop, F.lit(0)), at + slop)
        free = F.filter(reach, lambda p: (F.get(text, p) == F.get(terms, i)) & ~F.array_contains(used, p))
        return F.concat(used, F.slice(free, 1, 1))

    places = F.sequence(F.lit(0), F.size(terms) - 1)
    return F.size(F.aggregate(places, F.array().cast("array<int>"), take)) == F.size(terms)


def verified(rows: DataFrame, found: DataFrame, seed: DataFrame, slop: int = 0) -> DataFrame:
    """The candidates whose other terms are in place too: (id, h, win, start, len, exact).

    A document's candidates are tested against one array of its words; only documents with a candidate are moved.
    """
    tested = found.join(seed.select("w", "win", "terms"), "w")
    starts = stored(tested.groupBy(*ROW).agg(F.collect_list(F.struct("win", "terms", "start")).alias("found")), "candidates")
    keys = stored(starts.select(*ROW), "candidate-keys")          # a table of its own: its bytes decide on a broadcast
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = rows.join(keys, ROW, "left_semi").join(starts, ROW).repartition(tasks, *ROW)       # few bytes, much to test

    def test(text: Column) -> Column:
        def one(m: Column) -> Column:
            exact = F.slice(text, m["start"] + 1, F.size(m["terms"])) == m["terms"]
            inside = m["start"] + F.size(m["terms"]) <= F.size(text)
            fits = exact if slop == 0 else exact | (inside & _near(text, m["terms"], m["start"], slop))
            return F.struct(m["win"].alias("win"), m["start"].alias("start"), F.size(m["terms"]).alias("len"), exact.alias("exact"), fits.alias("fits"))

        return F.filter(F.transform("found", one), lambda m: m["fits"])

    each = texts.select("id", "h", F.explode(let(words(F.col("text")), test)).alias("m"))
    return each.select("id", "h", "m.win", "m.start", "m.len", "m.exact").distinct()


def matches(docs: DataFrame, items: DataFrame, slop: int = 0) -> tuple[DataFrame, DataFrame]:
    """Matches (id, h, win, start, len, exact) of all windows, and the windows' items (win, item)."""
    rows = keyed(docs)
    wins, owners = windows(items)
    wins = stored(wins, "windows")
    counts = stored(term_counts(rows, stored(wins.select(F.explode("terms").alias("term")).distinct(), "terms")), "term-counts")
    seed = stored(seeds(wins, counts), "seeds")
    rare = stored(seed.select(F.explode(F.array("term", "term2")).alias("term")).distinct(), "rare-terms")
    index = stored(postings(rows, rare), "postings")
    return stored(verified(rows, candidates(index, seed, slop), seed, slop), "matches"), owners


def hits(found: DataFrame, owners: DataFrame) -> DataFrame:
    """Per contaminated document: n_hit and the sorted list of its items."""
    spans = F.array_distinct(F.flatten(F.transform(
        "spans", lambda s: F.sequence(s["start"], s["start"] + s["len"] - 1))))
    hit = (found.groupBy(*ROW).agg(F.collect_set(F.struct("start", "len")).alias("spans"))
           .select(*ROW, F.size(spans).cast("long").alias("n_hit")))
    listed = (found.select(*ROW, "win").distinct().join(owners, "win").select(*ROW, "item").distinct()
              .groupBy(*ROW).agg(F.array_sort(F.collect_list("item")).alias("items")))
    return hit.join(listed, ROW, "left")


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found, owners = matches(docs, items)
    every = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64("text").alias("h"),
                        F.size(words(F.col("text"))).cast("long").alias("n_words"))
    listed = F.coalesce("items", F.array().cast("array<string>"))
    return every.join(hits(found, owners), ROW, "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.size(listed).cast("long").alias("n_items"),
        F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))


def keep_clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents without any benchmark window, with all their columns."""
    found, _ = matches(docs, items)
    bad = stored(found.select(F.col("id").alias("__id"), F.col("h").alias("__h")).distinct(), "contaminated")
    marked = docs.withColumns({"__id": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), "__h": F.xxhash64("text")})
    return like(marked.join(bad, ["__id", "__h"], "left_anti"), docs)
