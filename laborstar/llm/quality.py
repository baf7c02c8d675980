"""Quality classifier: logistic regression over hashed word n-grams, trained with
follow-the-regularised-leader (FTRL-proximal) updates and scored as sparse dot products.

Features of a text: its words (ASCII lower case), word pairs, word shapes (case, digits,
punctuation, length) and shape pairs, and whether a word repeats the one before, all hashed into
``DIMS`` places. A feature's value is its count divided by the number of words, so whole texts of
any length are comparable.

Training takes a bounded sample of labelled rows (``MAX_ROWS``, the rows with the smallest hash of
their id), so it is one small task; scoring covers every row, batch by batch, on the executors. The
only thing sent to executors is the weight vector (``DIMS`` floats).

Edge cases: a null or empty text has only the bias; rows whose label is neither 0 nor 1 and rows
with a null id are not learned from; without any usable label every score is 0.5; an id with
several labels gives several training rows; other columns are passed through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laborstar.llm._sample import smallest
from laborstar.llm._tokens import mix, words

DIMS = 1 << 18
MAX_ROWS = 4_000        # labelled rows that training may take
EPOCHS = 4
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.001, 0.005
SCALE = 20.0
THRESHOLD = 0.3
CHUNK = 100             # texts whose features are held at once
FOLDS = 5

_CLASS = np.full(256, 2, np.uint8)                 # 0 lower, 1 upper, 2 other sign, 3 digit, 4 beyond ASCII
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 0, 1, 3, 4


def _shapes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A small integer per word from its case, signs, digits and length."""
    kind = _CLASS[data]

    def count(k: int, most: int) -> np.ndarray:
        total = np.zeros(len(data) + 1, np.int32)
        np.cumsum(kind == k, out=total[1:])
        return np.minimum(total[end] - total[start], most)

    length = np.minimum((end - start) // 3, 5)
    return (((count(1, 2) * 4 + count(2, 3)) * 2 + count(3, 1)) * 6 + length).astype(np.uint64)


def _features(column: pa.Array) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Blocks of (text number, feature place), and the number of words of each text."""
    raw = words(column)
    plain = words(column, lower=True)
    doc, h = raw.doc, plain.hash
    shape = _shapes(raw.data, raw.start, raw.end)
    pair = np.flatnonzero(doc[1:] == doc[:-1])
    blocks = [(doc, h), (doc[pair], h[pair] * np.uint64(31) + h[pair + 1]),
              (doc, mix(shape + np.uint64(1 << 20))),
              (doc[pair], mix(shape[pair] * np.uint64(512) + shape[pair + 1] + np.uint64(1 << 30))),
              (doc[pair], mix((h[pair] == h[pair + 1]) + np.uint64(1 << 40)))]
    places = [(d, (mix(x + np.uint64(i)) & np.uint64(DIMS - 1)).astype(np.int64)) for i, (d, x) in enumerate(blocks)]
    return places, np.diff(raw.first)


def dot(column: pa.Array, weights: np.ndarray) -> np.ndarray:
    """Bias plus the sparse dot product of every text with the weights (place DIMS is the bias)."""
    places, n = _features(column)
    total = np.zeros(len(n))
    for doc, at in places:
        total += np.bincount(doc, weights[at], len(n))
    return weights[DIMS] + SCALE * total / np.maximum(n, 1)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def _rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows of some texts: bounds, places and values."""
    places, n = _features(column)
    doc = np.concatenate([d for d, _ in places])
    code, count = np.unique(doc * (DIMS + 1) + np.concatenate([a for _, a in places]), return_counts=True)
    doc, at = np.divmod(code, DIMS + 1)
    value = SCALE * count / np.maximum(n, 1)[doc]
    return np.searchsorted(doc, np.arange(len(n) + 1)), at.astype(np.int32), value.astype(np.float32)


def ftrl(column: pa.Array, labels: np.ndarray) -> np.ndarray:
    """Weights after EPOCHS passes of FTRL-proximal, one text at a time in the given order."""
    bounds, at, value = [np.zeros(1, np.int64)], [], []
    for i in range(0, len(column), CHUNK):
        b, a, v = _rows(column.slice(i, CHUNK))
        bounds.append(b[1:] + bounds[-1][-1])
        at.append(a)
        value.append(v)
    bounds, at, value = np.concatenate(bounds), np.concatenate(at), np.concatenate(value)
    z, g2 = np.zeros(DIMS + 1), np.zeros(DIMS + 1)

    def solve(zi: np.ndarray, gi: np.ndarray) -> np.ndarray:
        return np.where(np.abs(zi) <= L1, 0.0, (np.sign(zi) * L1 - zi) / ((BETA + np.sqrt(gi)) / ALPHA + L2))

    for _ in range(EPOCHS):
        for i, y in enumerate(labels):
            j = np.append(at[bounds[i]:bounds[i + 1]], DIMS)
            x = np.append(value[bounds[i]:bounds[i + 1]], 1.0)
            w = solve(z[j], g2[j])
            g = (sigmoid(w @ x) - y) * x
            z[j] += g - (np.sqrt(g2[j] + g * g) - np.sqrt(g2[j])) / ALPHA * w
            g2[j] += g * g
    return solve(z, g2)


def held_out(doc_id: Column) -> Column:
    """Rows that training never sees; false where the id is null."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> np.ndarray:
    """Weights from at most ``max_rows`` labelled rows outside the held-out fold."""
    sample = (labels.select(F.col("doc_id").alias("id"), F.col("quality").cast("int").alias("y"))
              .where("id is not null and y in (0, 1)").where(~held_out(F.col("id"))))
    rows = docs.select(F.col("doc_id").alias("id"), "text").join(F.broadcast(smallest(sample, "id", max_rows)), "id")
    rows = rows.withColumn("order", F.xxhash64("id"))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["order", "id", "y"], kind="stable")
        w = ftrl(pa.array(pdf["text"], pa.string(), from_pandas=True), pdf["y"].to_numpy(float))
        at = np.flatnonzero(w)
        return pd.DataFrame({"place": at, "w": w[at]})

    found = rows.withColumn("one", F.lit(1)).groupBy("one").applyInPandas(fit, "place long, w double").toPandas()   # at most DIMS + 1 rows
    weights = np.zeros(DIMS + 1)
    weights[found["place"].to_numpy(int)] = found["w"]
    return weights


def score(spark, weights: np.ndarray):
    """A column function text -> score (0 to 1; higher: label 1 likelier)."""
    shared = spark.sparkContext.broadcast(weights)

    @F.arrow_udf("double")
    def quality_score(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            few = [sigmoid(dot(part.slice(i, CHUNK), shared.value)) for i in range(0, len(part), CHUNK)]
            yield pa.array(np.concatenate(few or [np.zeros(0)]), pa.float64())

    return quality_score


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    quality = score(docs.sparkSession, train(docs, labels))
    return (docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), quality("text").alias("score"))
            .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier accepts, with all their columns."""
    quality = score(docs.sparkSession, train(docs, labels))
    return docs.where(quality(F.col("text")) >= THRESHOLD)
