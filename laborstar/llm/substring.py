"""Substring dedup: repeats of at least ``SIZE`` words, found by hashing windows in groups split by minimizers.

A window is SIZE consecutive words of one document (words without ASCII white space). Every word that is
covered by a window whose words also start in a document with a smaller doc_id is removed; windows are
judged on the input.

A suffix tree over all suffixes only matters here down to depth SIZE: its nodes at that depth are the
distinct windows, and those reached from several documents are the repeats. No tree is built, no suffix is ordered
and no maximal repeat comes out: equal windows are found by their hashes. A "prefix" below is a minimizer, a gram
anywhere inside the window, and a "subtree" is a sort of window hashes:

1. Suffixes are dealt by a prefix of ``PREFIX`` words. Only one in about twenty prefixes is sampled:
   of the PREFIX-word grams inside a window, the one with the least hash (its anchor), which depends on
   the window's words alone. A prefix that is in one document only has no deeper shared node.
2. For the other prefixes, documents send one row per run of windows with that anchor, with the hashes
   of the windows. A prefix with at most ``GROUP`` windows is a memory-sized group: its subtree's nodes at
   depth SIZE are found by sorting the group's windows, in batches, within one task.
3. A prefix with more windows is lengthened to all SIZE words: each node is then a key of its own, whose
   least doc_id is combined map-side, so a passage in a third of all documents is never gathered.
4. Runs of covered words are cut from the texts.

A window is identified by 128 bits (anchor and window hash). Documents are keyed by (doc_id, text hash).

Edge cases: null and empty texts have no words; a text of fewer than SIZE words keeps all; repeats inside
one document stay, and so do repeats among rows of the same doc_id; a null doc_id counts as larger than
any other; other columns pass through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laborstar.llm._columns import like
from laborstar.llm._store import stored
from laborstar.llm._tokens import mix, powers, words

SIZE = 50
PREFIX = 16
GROUP = 100_000           # windows of a group that one task sorts
NO_ID = (1 << 63) - 1
ROW = ["id", "h"]


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64("text").alias("h"), "text")


def _spans(h: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` word hashes."""
    up, down = powers(len(h) + 1)
    sums = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * up[:len(h)], out=sums[1:])
    return mix((sums[size:] - sums[:-size]) * down[:len(h) - size + 1])


def _least(x: np.ndarray, size: int) -> np.ndarray:
    """Minimum of every ``size`` consecutive values, by doubling."""
    have = 1
    while have * 2 <= size:
        x, have = np.minimum(x[:-have], x[have:]), have * 2
    return np.minimum(x[:len(x) - (size - have)], x[size - have:]) if size > have else x


def anchors(h: np.ndarray, size: int = SIZE, prefix: int = PREFIX) -> np.ndarray:
    """The anchor of every window of a document, from its word hashes."""
    return _least(_spans(h, prefix), size - prefix + 1).view(np.int64)


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """Row number and word hashes of every text that has a window."""
    found = words(batch.column("text"))
    for i in np.flatnonzero(np.diff(found.first) >= SIZE):
        yield i, found.hash[found.first[i]:found.first[i + 1]]


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at, values = [], []
        for i, h in _texts(batch):
            a = np.unique(anchors(h))
            at.append(np.full(len(a), i))
            values.append(a)
        if at:
            rows = batch.select(ROW).take(pa.array(np.concatenate(at)))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(values)), *rows.columns], names=["anchor", *ROW])


def _run_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per run of windows whose anchor is shared: anchor, id, h, place, window hashes."""
    for batch in batches:
        shared = batch.column("shared")
        at, anchor, place, count, hashes = [], [], [], [], []
        for i, h in _texts(batch):
            a = anchors(h)
            inside = np.isin(a, shared[int(i)].values.to_numpy())
            cut = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1])]))
            cut = cut[inside[cut]]
            ends = np.append(np.flatnonzero(a[1:] != a[:-1]) + 1, len(a))
            ends = ends[np.searchsorted(ends, cut, "right")]
            w = _spans(h, SIZE).view(np.int64)
            at.append(np.full(len(cut), i))
            anchor.append(a[cut])
            place.append(cut)
            count.append(ends - cut)
            hashes.extend(w[s:e] for s, e in zip(cut, ends))
        if hashes:
            rows = batch.select(ROW).take(pa.array(np.concatenate(at)))
            bounds = np.concatenate([[0], np.cumsum(np.concatenate(count))])
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(np.concatenate(hashes)))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(anchor)), *rows.columns,
                                              pa.array(np.concatenate(place)), pa.array(np.concatenate(count)), lists], names=["anchor", *ROW, "place", "count", "windows"])


def _merge(row: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ascending (row, window) pairs as spans: row, first window, last window."""
    new = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1)]))
    last = np.append(new[1:], len(row)) - 1
    return row[new], at[new], at[last]


def _subtrees(table: pa.Table) -> pa.RecordBatch:
    """Spans of the windows whose node (anchor, window) also holds a smaller id; ``table`` has whole groups."""
    lists = table.column("windows").combine_chunks()
    window = lists.values.to_numpy()[lists.offsets[0].as_py():lists.offsets[-1].as_py()]
    length = np.diff(lists.offsets.to_numpy())
    row = np.repeat(np.arange(len(length)), length)
    at = np.arange(len(window)) - np.repeat(np.cumsum(length) - length, length) + table.column("place").to_numpy()[row]
    anchor, ids = table.column("anchor").to_numpy()[row], table.column("id").to_numpy()[row]
    order = np.lexsort((ids, window, anchor))
    a, w = anchor[order], window[order]
    node = np.cumsum(np.concatenate([[True], (a[1:] != a[:-1]) | (w[1:] != w[:-1])])) - 1
    first = ids[order][np.searchsorted(node, np.arange(node[-1] + 1))]
    later = np.sort(order[ids[order] > first[node]])
    if not len(later):
        return pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 4, names=[*ROW, "start", "stop"])
    r, s, e = _merge(row[later], at[later])
    return pa.RecordBatch.from_arrays([pa.array(table.column(c).to_numpy()[r]) for c in ROW] + [pa.array(s), pa.array(e + SIZE)],
                                      names=[*ROW, "start", "stop"])


def _group_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Subtrees of the groups of one partition, sorted by anchor; the last group waits for its rest."""
    wait = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if wait is not None:
            table = pa.concat_tables([wait, table]).combine_chunks()
        if not len(table):
            continue
        anchor = table.column("anchor").to_numpy()
        cut = int(np.flatnonzero(anchor == anchor[-1])[0])
        if cut:
            yield _subtrees(table.slice(0, cut).combine_chunks())
        wait = table.slice(cut)
    if wait is not None and len(wait):
        yield _subtrees(wait.combine_chunks())


def repeated_spans(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """Per document with repeats: id, h, spans (start, stop) of words that go."""
    rows = keyed(docs)
    sampled = stored(rows.mapInArrow(_anchor_rows, "anchor long, id long, h long"), "anchors")
    shared = stored(sampled.groupBy("anchor").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a < b").select("anchor"), "shared-prefixes")
    alive = stored(sampled.join(shared, "anchor").groupBy(*ROW).agg(F.collect_set("anchor").alias("shared")), "alive")
    texts = rows.join(alive.hint("merge"), ROW)                   # texts move once at any size: no broadcast that ends as tables grow
    runs = stored(texts.mapInArrow(_run_rows, "anchor long, id long, h long, place long, count long, windows array<long>"), "runs")
    # A group is large by its windows, not by its documents: one long text may repeat a passage any number of times.
    large = stored(runs.groupBy("anchor").agg(F.sum("count").alias("n")).where(F.col("n") > group).select("anchor"), "large-groups")
    groups = (runs.join(large, "anchor", "left_anti").drop("count").repartition("anchor").sortWithinPartitions("anchor", "id")
              .mapInArrow(_group_spans, "id long, h long, start long, stop long"))
    each = runs.join(large, "anchor", "left_semi").select("anchor", *ROW, "place", F.posexplode("windows").alias("i", "w"))
    # Nodes of several documents, as a table: both sides of the join are then plain exchanges, so Spark can split a passage that is in most documents.
    nodes = stored(each.groupBy("anchor", "w").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last").drop("last"), "nodes")
    single = each.join(nodes, ["anchor", "w"]).where(F.col("id") > F.col("first"))
    start = F.col("place") + F.col("i")
    hot = single.groupBy("anchor", *ROW, "place").agg(F.array_sort(F.collect_set(start)).alias("at"))      # one run's windows
    hot = hot.select(*ROW, F.explode("at").alias("start")).withColumn("stop", F.col("start") + SIZE)
    return (groups.unionByName(hot).groupBy(*ROW)
            .agg(F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("spans")))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the words of their spans."""
    for batch in batches:
        n, gone, kept = [], [], []
        for text, spans in zip(batch.column("text"), batch.column("__spans")):
            found = (text.as_py() or "").encode().split()
            stay = np.ones(len(found), bool)
            for s in spans.as_py() or ():
                stay[s["start"]:s["stop"]] = False
            n.append(len(found))
            gone.append(int((~stay).sum()))
            kept.append(b" ".join(w for w, k in zip(found, stay) if k) if gone[-1] else b" ".join(found))
        names = [c for c in batch.schema.names if c != "__spans"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(n, pa.int64()), pa.array(gone, pa.int64()),
                                          pa.array([k.decode() for k in kept], pa.string()),
                                          pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())],
                                         names=[*names, "__n_words", "__n_removed", "__kept", "__sha"])


def remove_repeats(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """``docs`` with ``__n_words``, ``__n_removed``, ``__kept`` (the words that stay, joined by a space) and its SHA-256."""
    spans = stored(repeated_spans(docs, group), "spans").select(F.col("id").alias("__id"), F.col("h").alias("__h"), F.col("spans").alias("__spans"))
    marked = docs.withColumns({"__id": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), "__h": F.xxhash64("text")})
    both = marked.join(spans.hint("merge"), ["__id", "__h"], "left").drop("__id", "__h")
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields),
                        "__n_words long, __n_removed long, __kept string, __sha string"])
    return both.mapInArrow(_cut, schema)


def dedup(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated words removed; a text that keeps all its words is unchanged."""
    new = F.when(F.col("__n_removed") > 0, F.col("__kept")).otherwise(F.col("text"))
    return like(remove_repeats(docs).withColumn("text", new), docs)


def report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256."""
    return remove_repeats(docs.select("doc_id", "text")).select(
        "doc_id", F.col("__n_words").alias("n_words"), F.col("__n_removed").alias("n_removed"), F.col("__sha").alias("kept_sha256"))
