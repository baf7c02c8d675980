"""Toxicity by maximum-scoring segments of token log-odds.

* Token scores. A token (``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the lower-cased text) hashes to one of ``DIMS``
  places. The documents that hold a place are counted among toxic, clean and all documents; the log-odds of toxic against clean
  have a Dirichlet prior proportional to the counts of all documents. Log-odds are shrunk by their standard error (places seen too
  rarely to tell get none) and moved by ``DRIFT`` downwards, so a text without evidence scores below zero everywhere.
* Passages. A linear scan (Ruzzo and Tompa) yields every maximal segment of a text: the disjoint passages whose sums cannot be
  improved by growing, cutting or joining them.
* Calibration. Under clean text the best segment of n tokens follows an extreme-value law: its normalised score
  x = lambda S - ln(K n) exceeds y with probability 1 - exp(-exp(-y)). lambda solves sum p(place) exp(lambda s) = 1 over the places
  of clean documents; K is fitted to clean documents that the scores were not learned from (the sample is dealt into ``PARTS``,
  and a part is judged by scores learned from the others). The r best segments together have Karlin and Altschul's tail
  of their sum; the least tail over r, corrected for the choice, is the document's p-value. The score is
  sigmoid(a + b ln(1 - ln p)), a and b fitted to the same parts, so it never falls with the evidence.

Labels come from at most ``MAX_ROWS`` labelled rows (those with the smallest hashes of their id); the counts behind the prior
cover all documents, and every token of every text is scored. The driver holds at most ``DIMS`` rows of counts (places that a
toxic sample document holds) and two figures for each sampled row; executors get the ``DIMS`` scores.

Edge cases: null and empty texts have no token and the lowest score there is; rows whose label is neither 0 nor 1 or whose id is null are
not learned from; without toxic or without clean labels every score is 0; an id with several labels or rows gives several rows to learn
from, of which ``MAX_ROWS`` at most are taken; equal texts have equal scores; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laborstar.llm._sample import smallest
from laborstar.llm._store import stored
from laborstar.llm._tokens import LOWER, mix, span_hashes, text_bytes

DIMS = 1 << 18
MAX_ROWS = 20_000       # labelled rows that may be learned from
PRIOR = 40_000.0        # weight of the prior, in (document, place) pairs
SURE = 3.0              # standard errors that log-odds must have before any of them counts
DRIFT = 0.02
THRESHOLD = 0.5
FOLDS = 5               # one of them is never learned from
PARTS = 4
CHUNK = 100             # texts held at once
EULER = 0.5772156649015329

_TOKEN = np.zeros(256, bool)
_TOKEN[48:58], _TOKEN[97:123], _TOKEN[128:] = True, True, True


def places(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The place of every token of some texts, and the n + 1 bounds of the texts among the tokens."""
    data, at = text_bytes(column)
    data = LOWER[data]
    inside = _TOKEN[data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    cut = at[(at > 0) & (at < len(data))]
    opens[cut] |= inside[cut]
    closes[cut - 1] |= inside[cut - 1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    place = (mix(span_hashes(data, start, end)) & np.uint64(DIMS - 1)).astype(np.int64)
    return place, np.searchsorted(start, at)


def document_counts(column: pa.Array) -> np.ndarray:
    """How many of the texts hold each place."""
    found = np.zeros(DIMS, np.int64)
    for i in range(0, len(column), CHUNK):
        place, first = places(column.slice(i, CHUNK))
        doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
        found += np.bincount(np.unique(doc * DIMS + place) % DIMS, minlength=DIMS)
    return found


def log_odds(toxic: np.ndarray, clean: np.ndarray, prior: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """Score of places from the documents that hold them; ``prior`` holds shares of one, the n are sums over all places."""
    a, b = toxic + PRIOR * prior, clean + PRIOR * prior
    odds = np.log(a / (n_toxic + PRIOR)) - np.log(b / (n_clean + PRIOR))
    error = np.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
    return np.sign(odds) * np.maximum(np.abs(odds) - SURE * error, 0.0) - DRIFT


def segments(score: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first token, one past the last, sum) of one text, in order.

    Only tokens with positive scores start or end a segment, so the scan visits these alone."""
    upto = np.concatenate([[0.0], np.cumsum(score)])
    left: list[float] = []          # sums before the candidates, and up to their ends
    right: list[float] = []
    spans: list[tuple[int, int]] = []
    low: list[int] = []             # for every candidate, the nearest earlier one with a smaller sum before it
    for i in np.flatnonzero(score > 0):
        start, lo, hi = int(i), float(upto[i]), float(upto[i + 1])
        while True:
            j = len(left) - 1
            while j >= 0 and left[j] >= lo:
                j = low[j]
            if j < 0 or right[j] >= hi:
                break
            start, lo = spans[j][0], left[j]            # the text from candidate j on is one better segment
            del left[j:], right[j:], spans[j:], low[j:]
        left.append(lo)
        right.append(hi)
        spans.append((start, int(i) + 1))
        low.append(j)
    return [(s, e, hi - lo) for (s, e), lo, hi in zip(spans, left, right)]


@dataclass
class Model:
    """Token scores, the extreme-value law of clean text, and the law of the score."""
    score: np.ndarray
    rate: float = 1.0
    log_k: float = 0.0
    law: tuple[float, float] | None = None          # a and b; None without labels
    clean: np.ndarray | None = None                 # normalised best scores of the clean sample, ascending (at most MAX_ROWS)

    def normalised(self, n: int, sums: np.ndarray) -> np.ndarray:
        return self.rate * sums - self.log_k - np.log(max(n, 1))

    def chance(self, n: int, sums: np.ndarray) -> np.ndarray:
        """How often clean text of n tokens has a segment like each of these: by the law, but no less than the clean sample had."""
        x = self.normalised(n, sums)
        law = -np.expm1(-np.exp(-np.clip(x, -30, 700)))
        if self.clean is None or not len(self.clean):
            return law
        return np.maximum(law, 1 - np.searchsorted(self.clean, x, "left") / len(self.clean))

    def evidence(self, n: int, sums: np.ndarray) -> float:
        """-ln of the chance that clean text of n tokens has segments like the best r of these, for the most telling r."""
        x = np.sort(self.normalised(n, sums))[::-1]
        if not len(x):
            return 0.0
        least = np.log(-np.expm1(-np.exp(-x[0]))) if x[0] > -30 and x[0] < 30 else min(-x[0], 0.0)
        r = np.arange(2, 2 + np.count_nonzero(x[1:] > 0))              # further segments that clean text would not have
        if len(r):
            total = np.cumsum(x[:len(r) + 1])[1:]
            fact = np.cumsum(np.log(r) + np.log(r - 1))                 # r! (r - 1)!
            with np.errstate(divide="ignore", invalid="ignore"):
                tails = np.where(total > 0, -total + (r - 1) * np.log(total) - fact, 0.0)
            least = min(least, float((tails + (r - 1) * np.log(2.0)).min()))
        return max(-least - np.log(2.0), 0.0)                           # halves of the error rate go to r = 1, 2, 3, ...

    def evidences(self, column: pa.Array) -> np.ndarray:
        out = np.zeros(len(column))
        for i, score in self.texts(column):
            out[i] = self.evidence(len(score), np.array([s for _, _, s in segments(score)]))
        return out

    def texts(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
        """Number and token scores of every text."""
        for i in range(0, len(column), CHUNK):
            place, first = places(column.slice(i, CHUNK))
            for j, (a, b) in enumerate(zip(first[:-1], first[1:])):
                yield i + j, self.score[place[a:b]]

    def scores(self, column: pa.Array) -> np.ndarray:
        if self.law is None:
            return np.zeros(len(column))
        a, b = self.law
        return 1.0 / (1.0 + np.exp(-np.clip(a + b * np.log1p(self.evidences(column)), -40, 40)))


def root(share: np.ndarray, score: np.ndarray) -> float:
    """lambda: the positive root of sum p exp(lambda s) = 1; what ``share`` leaves of one scores -DRIFT."""
    rest = max(1.0 - float(share.sum()), 0.0)

    def total(rate: float) -> float:
        return float(share @ np.exp(rate * score)) + rest * np.exp(-rate * DRIFT)

    lo, hi = 0.0, 1.0
    while total(hi) < 1 and hi < 64:
        lo, hi = hi, hi * 2
    for _ in range(50):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if total(mid) < 1 else (lo, mid)
    return max(hi, 1e-3)


def logistic(u: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """a and b >= 0 of P(y) = sigmoid(a + b u), by damped Newton steps with a little shrinkage."""
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    a, b = float(np.log(share / (1 - share))), 0.5
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a + b * u, -30, 30)))
        w = p * (1 - p) + 1e-9
        slope = np.array([(y - p).sum() - 1e-3 * a, ((y - p) * u).sum() - 1e-3 * b])
        bend = np.array([[w.sum() + 1e-3, (w * u).sum()], [(w * u).sum(), (w * u * u).sum() + 1e-3]])
        step = np.clip(np.linalg.solve(bend, slope), -1, 1)
        a, b = float(a + step[0]), float(max(b + step[1], 0.0))
    return a, b


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from; false where the id is null."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, max_rows: int) -> DataFrame:
    """At most ``max_rows`` labelled rows outside the held-out fold: text, y, part (a stored table)."""
    known = (labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("y"))
             .where("id is not null and y in (0, 1)").where(~held_out(F.col("id"))).distinct())
    chosen = smallest(known, "id", max_rows)
    rows = stored(docs.select(F.col("doc_id").alias("id"), "text").join(F.broadcast(chosen), "id")
                  .select("text", "y", F.xxhash64("id", "text").alias("key"), F.pmod(F.xxhash64("id"), F.lit(PARTS)).cast("int").alias("part")), "toxic-sample")
    return rows if rows.count() <= max_rows else stored(smallest(rows, "key", max_rows), "toxic-sample")


def _counted(rows: DataFrame) -> DataFrame:
    """(group, place, n): how many texts of a group (column g) hold each place; one partial row per task, group and place."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}                    # as many groups as the caller deals
        for batch in batches:
            group = batch.column("g").to_numpy()
            for g in np.unique(group).tolist():
                n = document_counts(batch.column("text").filter(pa.array(group == g)))
                held[g] = held[g] + n if g in held else n
        for g, n in held.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), g, np.int32)), pa.array(at.astype(np.int32)), pa.array(n[at])], names=["g", "place", "n"])

    return rows.mapInArrow(count, "g int, place int, n long").groupBy("g", "place").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    spark = docs.sparkSession
    rows = sample(docs, labels, max_rows)
    groups = 2 * PARTS                                                                      # part and label
    counts = stored(_counted(rows.select("text", (F.col("part") * 2 + F.col("y")).alias("g"))), "sample-counts")
    corpus = stored(_counted(docs.select("text", F.lit(0).alias("g"))), "corpus-counts")
    totals = np.zeros(groups)
    for r in counts.groupBy("g").agg(F.sum("n").alias("n")).collect():                       # 2 PARTS rows
        totals[r["g"]] = r["n"]
    if not totals[0::2].sum() or not totals[1::2].sum():
        return Model(np.zeros(DIMS))
    everything = float(corpus.agg(F.sum("n").alias("n")).first()["n"])
    wide = counts.groupBy("place").agg(*[F.sum(F.when(F.col("g") == g, F.col("n")).otherwise(0)).alias(f"g{g}") for g in range(groups)])
    wide = wide.where(" + ".join(f"g{g}" for g in range(1, groups, 2)) + " > 0")
    found = wide.join(corpus.select("place", F.col("n").alias("all")), "place").toPandas()        # at most DIMS rows
    n = found[[f"g{g}" for g in range(groups)]].to_numpy(float).T
    at, prior = found["place"].to_numpy(int), found["all"].to_numpy(float) / everything

    def learned(parts: list[int]) -> tuple[np.ndarray, float]:
        clean, toxic = [2 * p for p in parts], [2 * p + 1 for p in parts]
        score = log_odds(n[toxic].sum(0), n[clean].sum(0), prior, totals[toxic].sum(), totals[clean].sum())
        whole = np.full(DIMS, -DRIFT)
        whole[at] = score
        return whole, root(n[clean].sum(0) / max(totals[clean].sum(), 1), score)

    score, rate = learned(list(range(PARTS)))
    parts = [Model(s, rate) for s, _ in (learned([q for q in range(PARTS) if q != p]) for p in range(PARTS))]
    best = _judged(rows.where("y = 0"), spark.sparkContext.broadcast(parts), "best")
    log_k = float(np.mean(rate * best["value"] - np.log(np.maximum(best["tokens"], 1)))) - EULER if len(best) else 0.0
    clean = np.sort(rate * best["value"].to_numpy(float) - np.log(np.maximum(best["tokens"].to_numpy(float), 1)) - log_k)
    for m in parts:
        m.log_k = log_k
    seen = _judged(rows, spark.sparkContext.broadcast(parts), "evidence")
    return Model(score, rate, log_k, logistic(np.log1p(seen["value"].to_numpy(float)), seen["y"].to_numpy(float)), clean)


def _judged(rows: DataFrame, shared, what: str):
    """y, tokens and the best sum or the evidence of every sampled row, by the model that its part has not taught; at most MAX_ROWS rows."""
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = batch.column("part").to_numpy()
            for p in np.unique(part).tolist():
                some = batch.filter(pa.array(part == p))
                model, tokens, value = shared.value[p], np.zeros(len(some), np.int64), np.zeros(len(some))
                for i, score in model.texts(some.column("text")):
                    sums = np.array([s for _, _, s in segments(score)])
                    tokens[i] = len(score)
                    value[i] = sums.max(initial=0.0) if what == "best" else model.evidence(len(score), sums)
                yield pa.RecordBatch.from_arrays([some.column("y"), pa.array(tokens), pa.array(value)], names=["y", "tokens", "value"])

    return rows.select("text", "y", "part").mapInArrow(judge, "y int, tokens long, value double").toPandas()


def classify(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, max_rows))

    @F.arrow_udf("double")
    def toxicity(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            yield pa.array(shared.value.scores(part), pa.float64())

    return (docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), toxicity(F.col("text")).alias("score"))
            .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")))


def passages(docs: DataFrame, labels: DataFrame, chance: float = 0.01, max_rows: int = MAX_ROWS) -> DataFrame:
    """Every segment that clean text of its document's length would have with at most ``chance``: doc_id, first_token, tokens, score, p_value."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, max_rows))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            model, rows = shared.value, []
            for i, score in model.texts(batch.column("text")):
                found = segments(score)
                p = model.chance(len(score), np.array([s for _, _, s in found]))
                rows += [(i, a, b - a, s, q) for (a, b, s), q in zip(found, p) if q <= chance]
            if rows and model.law is not None:
                row, start, size, total, p = zip(*rows)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(row)), pa.array(start, pa.int64()), pa.array(size, pa.int64()),
                                                  pa.array(total), pa.array(p)], names=["doc_id", "first_token", "tokens", "score", "p_value"])

    return docs.select("doc_id", "text").mapInArrow(find, "doc_id long, first_token long, tokens long, score double, p_value double")
