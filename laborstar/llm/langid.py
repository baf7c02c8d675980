"""Language identification by prediction by partial matching (PPM) over bytes.

Per language a variable-order context tree of bytes is counted on a bounded sample of labelled texts:
after a context of ``ORDER`` bytes a byte has probability count / (total + distinct); otherwise the
escape probability distinct / (total + distinct) is paid and the next shorter context is asked, without
the bytes that the longer context already offered (exclusion), down to all bytes alike. The statistics
are then frozen, so a byte's code length depends on the ORDER bytes before it only, and the code
lengths of all contexts of the tree and all bytes are computed once. A text is scored by its exact code
length under every language; the language with the shortest code wins.

Learning takes at most ``MAX_ROWS`` texts per language (smallest hashes of the text), counted on the
executors; the driver receives the counts, bounded by the sample. Scoring covers whole texts of all rows.

score: the posterior of the predicted language if all languages are alike before, with code lengths.

Edge cases: null text or a text without a letter gets ``und`` and score 0; rows with null lang, null
text or null id are not learned from; without anything learned every text gets ``und``; equal code
lengths go to the language that is first in code point order; lang, source and doc_id are not inputs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from laborstar.llm._tokens import text_bytes

ORDER = 3
MAX_ROWS = 250
FOLDS, FOLD = 4, 2
UNKNOWN = "und"
PIECE = 1 << 20


def held_out(doc_id: Column) -> Column:
    """Rows that learning never sees; false where the id is null."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == FOLD, F.lit(False))


def _grams(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The ORDER bytes before every byte and the byte itself, as one number; 0 stands before a text."""
    n = len(data)
    within = np.arange(n) - np.repeat(at[:-1], np.diff(at))
    code = data.astype(np.int64) + 1
    gram = code.copy()
    for k in range(1, ORDER + 1):
        before = np.zeros(n, np.int64)
        before[k:] = code[:-k] if n > k else 0
        before[within < k] = 0
        gram += before * (257 ** k)
    return gram


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) of the labelled texts of a partition."""
    for batch in batches:
        lang = batch.column("lang").to_numpy(zero_copy_only=False)
        for name in np.unique(lang):
            data, at = text_bytes(batch.column("text").filter(pa.array(lang == name)))
            gram, n = np.unique(_grams(data, at), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(gram), pa.string()), pa.array(gram), pa.array(n)], names=["lang", "gram", "n"])


def count_contexts(docs: DataFrame, max_rows: int = MAX_ROWS) -> pd.DataFrame:
    """Byte counts after every context of ORDER bytes, per language, from a bounded sample."""
    rows = docs.select(F.col("doc_id").alias("id"), "text", F.col("lang").cast("string").alias("lang"))
    rows = rows.where("id is not null and lang is not null and text is not null").where(~held_out(F.col("id")))
    # The group limit keeps max_rows rows of a language per task before the shuffle, also for a language of most rows.
    order = Window.partitionBy("lang").orderBy("hash", "id")
    ids = (rows.select("lang", "id", F.xxhash64("id").alias("hash")).withColumn("nth", F.row_number().over(order))
           .where(F.col("nth") <= max_rows).select("id", "lang"))
    sample = rows.join(F.broadcast(ids), ["id", "lang"]).select("lang", "text")         # max_rows per language
    return (sample.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram")
            .agg(F.sum("n").alias("n")).toPandas())


class Model:
    """Frozen code lengths. Bytes never seen share one symbol; row[a, b, c] is the row of a context."""

    def __init__(self, counts: pd.DataFrame):
        self.langs = sorted(counts["lang"].unique(), key=lambda s: s.encode())
        seen = np.unique(np.concatenate([np.zeros(1, np.int64), counts["gram"].to_numpy(np.int64) % 257]))
        self.symbol = np.full(257, len(seen), np.int64)             # 0 is the place before a text
        self.symbol[seen] = np.arange(len(seen))
        self.size = len(seen) + 1
        rest = 257 - len(seen)                                       # how many bytes the last symbol stands for
        gram = counts["gram"].to_numpy(np.int64)
        lang = counts["lang"].map({x: i for i, x in enumerate(self.langs)}).to_numpy(np.int64)
        symbols = [self.symbol[gram // 257 ** k % 257] for k in range(ORDER, -1, -1)]
        weight = counts["n"].to_numpy(float)
        every = np.full(self.size, 1.0)
        every[0], every[-1] = 0.0, max(rest, 1)
        row = np.zeros(1, np.int64)                                  # rows of the contexts of the order so far
        cost = np.repeat((every / every.sum())[None, :, None], len(self.langs), 2)      # probabilities without any context
        for order in range(ORDER + 1):
            context = np.zeros(len(gram), np.int64)
            for s in symbols[ORDER - order:ORDER]:
                context = context * self.size + s
            known, place = np.unique(context, return_inverse=True)
            table = np.zeros((len(known), self.size, len(self.langs)))
            np.add.at(table, (place, symbols[ORDER], lang), weight)
            # Shorter context: the same number without its first symbol.
            short = row[known % (self.size ** max(order - 1, 0))] if order else np.zeros(1, np.int64)
            base = cost[short]
            hit = table > 0
            distinct, total = hit.sum(1, keepdims=True), table.sum(1, keepdims=True)
            left = np.where(hit, 0.0, base)
            free = left.sum(1, keepdims=True)
            low = np.divide(left, free, out=np.zeros_like(left), where=free > 0)
            found = np.where(hit, table, distinct * low) / np.maximum(total + distinct, 1)
            whole = (free <= 0) & (total > 0)                        # nothing left to escape to
            found = np.where(whole, table / np.maximum(total, 1), found)
            found = np.where(total > 0, found, base)                 # context unknown to this language
            offset = len(cost) if order else 0
            old = row
            cost = np.concatenate([cost, found]) if order else found
            span = self.size ** order
            row = np.tile(old, span // len(old)) if order else np.zeros(1, np.int64)
            row[known] = offset + np.arange(len(known))
        self.row = row.astype(np.int32)
        per_byte = cost.copy()
        per_byte[:, -1, :] /= max(rest, 1)
        self.bits = -np.log2(np.maximum(per_byte, 1e-30)).astype(np.float32).reshape(-1, len(self.langs))

    def lengths(self, column: pa.Array) -> np.ndarray:
        """Code length in bits of every text under every language."""
        data, at = text_bytes(column)
        out = np.zeros((len(at) - 1, len(self.langs)))
        for start in range(0, len(data), PIECE):                     # bounded memory, also for one very long text
            stop = min(start + PIECE, len(data))
            lead = min(ORDER, start)
            s = self.symbol[data[start - lead:stop].astype(np.int64) + 1]
            first = int(np.searchsorted(at, start, "right")) - 1
            doc = np.repeat(np.arange(first, len(at) - 1), np.diff(np.clip(at[first:], start, stop)))
            within = np.arange(start, stop) - at[doc]
            context = np.zeros(stop - start, np.int64)
            for k in range(ORDER, 0, -1):
                before = np.zeros(stop - start, np.int64)
                have = s[max(lead - k, 0):len(s) - k]
                before[len(before) - len(have):] = have
                before[within < k] = 0
                context = context * self.size + before
            place = self.row[context].astype(np.int64) * self.size + s[lead:]
            for i in range(len(self.langs)):
                out[:, i] += np.bincount(doc, self.bits[place, i], len(at) - 1)
        return out

    def predict(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Number of the best language and its posterior."""
        bits = self.lengths(column)
        best = bits.argmin(1)
        gap = np.minimum(bits - bits.min(1, keepdims=True), 1000)
        return best, 1 / (2.0 ** -gap).sum(1)


def predictor(spark, counts: pd.DataFrame):
    """A column function text -> struct(lang, score)."""
    shared = spark.sparkContext.broadcast(Model(counts)) if len(counts) else None

    @F.arrow_udf("lang string, score double")
    def predicted(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            if shared is None:
                yield pa.StructArray.from_arrays([pa.array([UNKNOWN] * len(part), pa.string()), pa.array(np.zeros(len(part)))], ["lang", "score"])
                continue
            model = shared.value
            best, score = model.predict(part)
            yield pa.StructArray.from_arrays([pa.array([model.langs[i] for i in best], pa.string()), pa.array(score)], ["lang", "score"])

    return predicted


def identify(docs: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    guess = predictor(docs.sparkSession, count_contexts(docs, max_rows))
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    found = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), lettered.alias("lettered"), guess(F.col("text")).alias("g"))
    return found.select("doc_id", "held_out",
                        F.when(F.col("lettered"), F.col("g.lang")).otherwise(UNKNOWN).alias("lang_pred"),
                        F.when(F.col("lettered") & (F.col("g.lang") != UNKNOWN), F.col("g.score")).otherwise(0.0).alias("score"))
