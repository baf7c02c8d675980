"""Language-model scoring by masked pseudo-likelihood.

Every word of a text is predicted from the ``SIDE`` words before and the ``SIDE`` words after it, itself masked; the
sum of the conditional log-probabilities scores the text.

* Symbols: the ``VOCAB`` most frequent words of the corpus, and ``RARE`` buckets that all other words
  hash to. Word counts are gathered over all documents.
* Rare words: a bucket is a symbol like any other for the network, and a word of it has the share
  (count + 1) / (words of the bucket + its distinct words + 1). What is left, one count, is the share of all words
  that the corpus does not have. Counts are looked up by a shuffled join of (document, word, n).
* Network: hidden = tanh(sum over places of an embedding per place and symbol + bias); a softmax over ``CLASSES``
  classes of symbols; inside a class a symbol has its corpus frequency (plus one). Classes have about
  equal shares of the square roots of the counts, so P(symbol | both sides) sums to one.
* Training: ``EPOCHS`` round over all documents. In a round every partition runs minibatch Adagrad in numpy over its
  texts, from the network of the round before; every parameter row becomes the mean of the partitions' rows,
  weighted by how many words of a partition used it. A minibatch takes every k-th word of many texts, so it never sees one text
  alone and needs no permutation. Scoring covers every word of every text, in pieces of bounded size.

The driver holds the symbol counts (VOCAB + RARE rows) and the network (its size is fixed), which are broadcast; a
partition sends the rows it used, so at most one network.

Edge cases: null and empty texts have 0 words, log_prob 0 and mean 0; an empty table trains nothing and
returns no rows; ties in counts go to the smaller hash; repeated rows are scored alike; other columns are ignored;
the network depends a little on how the input is split into partitions, and messages are added up in the order of these, so
a run over the same partitions agrees to the last bit.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laborstar.llm._sample import smallest
from laborstar.llm._store import stored
from laborstar.llm._tokens import words

VOCAB = 16_384
RARE = 4_096
CLASSES = 48
SIDE = 2
HIDDEN = 32
EPOCHS = 1
BATCH = 32_768
RATE = 0.1
PIECE = 1 << 14
TEXTS = 1_000             # texts whose words a task deals into minibatches at once
BYTES = 1 << 23           # or fewer, if they are longer than so many bytes together
ROWS = 256                # embeddings of a message between the partitions and the combining tasks
PLACES = [k for k in range(-SIDE, SIDE + 1) if k]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        word, n = np.unique(words(batch.column("text"), lower=True).hash.view(np.int64), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(n)], names=["word", "n"])


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): how often the corpus has each word."""
    return stored(docs.select("text").mapInArrow(_counts, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "word-counts")


def symbols_of(counts: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The VOCAB most frequent word hashes (ascending), the corpus counts of all symbols, and the distinct words of every bucket."""
    top = counts.orderBy(F.col("n").desc(), "word").limit(VOCAB)
    known = top.toPandas().sort_values("word")                                              # VOCAB rows
    rest = counts.join(F.broadcast(top.select("word")), "word", "left_anti")                # VOCAB rows
    rare = rest.groupBy(F.pmod("word", F.lit(RARE)).alias("bucket")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("types")).toPandas()   # RARE rows
    n, types = np.zeros(len(known) + RARE), np.zeros(RARE)
    n[:len(known)] = known["n"]
    n[len(known) + rare["bucket"].to_numpy(int)] = rare["n"]
    types[rare["bucket"].to_numpy(int)] = rare["types"]
    return known["word"].to_numpy(np.int64), n, types


def symbol_counts(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The VOCAB most frequent word hashes (ascending), and the corpus counts of all symbols."""
    return symbols_of(word_counts(docs))[:2]


class Model:
    """Symbols, classes and the network."""

    def __init__(self, vocab: np.ndarray, counts: np.ndarray, types: np.ndarray | None = None):
        self.vocab = vocab
        self.bucket = np.log(counts[len(vocab):] + (0 if types is None else types) + 1)
        self.size = len(counts)                               # one more embedding stands for "outside the text"
        order = np.argsort(-counts, kind="stable")
        mass = np.cumsum(np.sqrt(counts[order])) + 1e-9                # buckets without words fall into the last class
        self.classes = np.empty(self.size, np.int64)
        self.classes[order] = np.minimum((mass / mass[-1] * CLASSES).astype(int), CLASSES - 1)
        total = np.bincount(self.classes, counts + 1, CLASSES)
        self.inside = np.log((counts + 1) / total[self.classes])
        self.share = np.log(np.maximum(total, 1e-9) / total.sum())
        rng = np.random.default_rng(0)
        self.embed = (rng.standard_normal((len(PLACES), self.size + 1, HIDDEN)) * 0.1).astype(np.float32)
        self.bias = np.zeros(HIDDEN, np.float32)
        self.out = (rng.standard_normal((HIDDEN, CLASSES)) * 0.1).astype(np.float32)
        self.base = self.share.astype(np.float32).copy()
        # Adagrad's sums of squares: a row of ``embed`` or ``out`` has one, ``bias`` and ``base`` one each.
        self.seen = {"embed": np.full(self.embed.shape[:2], 1e-6, np.float32), "out": np.full(HIDDEN, 1e-6, np.float32),
                     "bias": np.full(1, 1e-6, np.float32), "base": np.full(1, 1e-6, np.float32)}
        self.used = np.zeros(self.embed.shape[:2], np.float32)      # words that used a row, since the round began
        self.learned = 0

    def symbols(self, word: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.vocab, word), max(len(self.vocab) - 1, 0))
        known = self.vocab[at] == word if len(self.vocab) else np.zeros(len(word), bool)
        return np.where(known, at, len(self.vocab) + word % RARE)

    def contexts(self, symbol: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Symbols at the places around every word, never beyond the word's own text."""
        doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
        at = np.arange(len(symbol))
        around = np.full((len(PLACES), len(symbol)), self.size, np.int64)
        for i, k in enumerate(PLACES):
            ok = (at + k >= first[doc]) & (at + k < first[doc + 1])
            around[i, ok] = symbol[at[ok] + k]
        return around

    def hidden(self, around: np.ndarray) -> np.ndarray:
        h = self.embed[0][around[0]]
        h += self.bias
        for e, a in zip(self.embed[1:], around[1:]):
            h += e[a]
        return np.tanh(h, out=h)

    def forward(self, around: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hidden layer and class log-probabilities."""
        h = self.hidden(around)
        z = h @ self.out
        z += self.base
        z -= z.max(1, keepdims=True)
        z -= np.log(np.exp(z).sum(1, keepdims=True))
        return h, z

    def scores(self, h: np.ndarray) -> np.ndarray:
        """Class scores, safe to exponentiate: below 80 by the size of the weights, or else less their largest."""
        z = h @ self.out
        z += self.base
        if np.abs(self.out).sum(0).max() + np.abs(self.base).max() > 80:              # |h| <= 1
            z -= z.max(1, keepdims=True)
        return z

    def chosen(self, around: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Log-probability of one class per word."""
        z = self.scores(self.hidden(around))
        found = z[np.arange(len(target)), target]
        return found - np.log(np.exp(z, out=z).sum(1))

    def fit(self, column: pa.Array, rounds: int = 4) -> None:
        for _ in range(rounds):
            self.learn(column)

    def learn(self, column: pa.Array) -> None:
        """One pass over the words of some texts, every k-th word at a time."""
        found = words(column, lower=True)
        symbol = self.symbols(found.hash.view(np.int64))
        around = self.contexts(symbol, found.first)
        target = self.classes[symbol]
        self.learned += len(symbol)
        steps = -(-len(symbol) // BATCH)
        number = np.zeros(self.size + 1, np.int64)                                # of a symbol among those of a minibatch
        for i in range(steps):
            context, goal = around[:, i::steps], target[i::steps]
            h = self.hidden(context)
            d = self.scores(h)
            np.exp(d, out=d)
            d *= (1 / np.sqrt(np.float32(len(goal)))) / d.sum(1, keepdims=True)
            d[np.arange(len(goal)), goal] -= 1 / np.sqrt(np.float32(len(goal)))
            back = d @ self.out.T
            back *= 1 - h * h
            self._step(self.out, self.seen["out"], np.arange(HIDDEN), h.T @ d)
            columns = np.ascontiguousarray(back.T).astype(float)
            for e, seen, used, a in zip(self.embed, self.seen["embed"], self.used, context):
                times = np.bincount(a, minlength=self.size + 1)
                rows = np.flatnonzero(times)
                used[rows] += times[rows]
                number[rows] = np.arange(len(rows))
                at = number[a]
                g = np.stack([np.bincount(at, c, len(rows)) for c in columns], axis=1).astype(np.float32)
                self._step(e, seen, rows, g)
            for x, seen, g in ((self.bias, self.seen["bias"], back.sum(0)), (self.base, self.seen["base"], d.sum(0))):
                seen += (g * g).mean()
                x -= RATE * g / np.sqrt(seen)

    @staticmethod
    def _step(x: np.ndarray, seen: np.ndarray, rows: np.ndarray, g: np.ndarray) -> None:
        seen[rows] += (g * g).mean(1)
        x[rows] -= (RATE / np.sqrt(seen[rows]))[:, None] * g

    def _dense(self) -> list[np.ndarray]:
        return [self.out, self.bias, self.base, self.seen["out"], self.seen["bias"], self.seen["base"]]

    def messages(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """What the round has changed: block, rows, words that used each row, values. Block -1 has all but the embeddings."""
        if self.learned:
            yield -1, np.zeros(1, np.int64), np.array([self.learned], float), np.concatenate([x.ravel() for x in self._dense()])[None]
        used = self.used.ravel()
        for block in range(0, -(-len(used) // ROWS)):
            rows = block * ROWS + np.flatnonzero(used[block * ROWS:(block + 1) * ROWS])
            if len(rows):
                values = np.concatenate([self.embed.reshape(-1, HIDDEN)[rows], self.seen["embed"].reshape(-1)[rows, None]], axis=1)
                yield block, rows, used[rows].astype(float), values

    def take(self, block: int, rows: np.ndarray, values: np.ndarray) -> None:
        """The other end of ``messages``."""
        if block >= 0:
            values = values.reshape(len(rows), HIDDEN + 1)
            self.embed.reshape(-1, HIDDEN)[rows] = values[:, :HIDDEN]
            self.seen["embed"].reshape(-1)[rows] = values[:, HIDDEN]
            return
        for x in self._dense():
            x[...] = values[:x.size].reshape(x.shape)
            values = values[x.size:]

    def score(self, column: pa.Array, with_rare: bool = False) -> tuple[np.ndarray, ...]:
        """Number of words and summed log-probability of every text's symbols. ``with_rare`` takes the size of their buckets off
        rare words, which then lack log(count + 1) alone, and adds the number of these."""
        found = words(column, lower=True)
        symbol = self.symbols(found.hash.view(np.int64))
        around, doc = self.contexts(symbol, found.first), found.doc
        total = np.zeros(len(found.first) - 1)
        for i in range(0, len(symbol), PIECE):
            s = symbol[i:i + PIECE]
            of, known = doc[i:i + PIECE], self.chosen(around[:, i:i + PIECE], self.classes[s]) + self.inside[s]
            total[of[0]:of[-1] + 1] += np.bincount(of - of[0], known, of[-1] - of[0] + 1)
        if not with_rare:
            return np.diff(found.first), total
        at = symbol >= len(self.vocab)
        total -= np.bincount(doc[at], self.bucket[symbol[at] - len(self.vocab)], len(total))
        return np.diff(found.first), total, np.bincount(doc[at], minlength=len(total))

    def rare(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rare words of the texts, each once per text: text number, word, how often."""
        found = words(column, lower=True)
        word = found.hash.view(np.int64)
        at = self.symbols(word) >= len(self.vocab)
        doc, word = found.doc[at], word[at]
        order = np.lexsort((word, doc))
        doc, word = doc[order], word[order]
        first = np.flatnonzero(np.concatenate([np.ones(min(len(doc), 1), bool), (doc[1:] != doc[:-1]) | (word[1:] != word[:-1])]))
        return doc[first], word[first], np.diff(np.append(first, len(doc)))


MESSAGE = pa.schema([("block", pa.int32()), ("part", pa.int32()), ("rows", pa.binary()), ("used", pa.binary()), ("x", pa.binary())])


def _sent(block: int, rows: np.ndarray, used: np.ndarray, x: np.ndarray, part: int = 0) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{"block": block, "part": part, "rows": rows.astype(np.int64).tobytes(), "used": used.astype(float).tobytes(),
                                        "x": x.astype(np.float32).tobytes()}], MESSAGE)


def _means(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weighted means of every block's rows; the messages are sorted by block, and one block's sums are held."""
    block, weight, sums = None, None, None

    def result() -> pa.RecordBatch:
        at = np.flatnonzero(weight)
        return _sent(block, max(block, 0) * ROWS + at, weight[at], sums[at] / weight[at, None])

    for batch in batches:
        for m in batch.to_pylist():
            rows, used = np.frombuffer(m["rows"], np.int64), np.frombuffer(m["used"], float)
            x = np.frombuffer(m["x"], np.float32).reshape(len(rows), -1)
            if m["block"] != block:
                if block is not None:
                    yield result()
                block, weight, sums = m["block"], np.zeros(ROWS), np.zeros((ROWS if m["block"] >= 0 else 1, x.shape[1]))
                weight = weight[:len(sums)]
            at = rows - max(block, 0) * ROWS
            weight[at] += used
            sums[at] += x * used[:, None]
    if block is not None:
        yield result()


def several(column: pa.Array) -> Iterator[pa.Array]:
    """Slices of at most TEXTS texts and about BYTES bytes."""
    size = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    i = 0
    while i < len(column):
        full = int(np.searchsorted(size, (size[i - 1] if i else 0) + BYTES, "right"))
        j = min(max(full, i + 1), i + TEXTS, len(column))
        yield column.slice(i, j - i)
        i = j


def train(docs: DataFrame, max_rows: int | None = None, counts: DataFrame | None = None) -> Model:
    """Counts and network over all documents; ``max_rows`` fits the network on that many only (for trials)."""
    model = Model(*symbols_of(word_counts(docs) if counts is None else counts))
    texts = docs.select("text")
    if max_rows is not None:
        texts = docs.select("doc_id", "text").join(F.broadcast(smallest(docs.select("doc_id"), "doc_id", max_rows)), "doc_id").select("text")
    for _ in range(EPOCHS):
        shared = docs.sparkSession.sparkContext.broadcast(model)

        def learn(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            local = copy.deepcopy(shared.value)                # a worker keeps the broadcast value for its next task
            for batch in batches:
                for few in several(batch.column(0)):
                    local.learn(few)
            for m in local.messages():
                yield _sent(*m, part=TaskContext.get().partitionId())

        schema = "block int, part int, rows binary, used binary, x binary"
        sent = texts.mapInArrow(learn, schema).repartition("block").sortWithinPartitions("block", "part")
        for m in stored(sent.mapInArrow(_means, schema), "network").toLocalIterator():      # one network, of fixed size
            model.take(m["block"], np.frombuffer(m["rows"], np.int64), np.frombuffer(m["x"], np.float32))
        shared.unpersist()
    return model


def rare_shares(docs: DataFrame, shared, counts: DataFrame) -> DataFrame:
    """Per key of a row, for those with rare words: the summed log(count + 1) of their rare words, and how many these are.

    Rows of one id and text have one key, so both sums have them all."""
    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in several(batch.column("text")):
                key, at = batch.column("key").slice(at, len(part)), at + len(part)
                doc, word, n = shared.value.rare(part)
                yield pa.RecordBatch.from_arrays([key.take(pa.array(doc)), pa.array(word), pa.array(n.astype(np.int32))], names=["key", "word", "times"])

    rows = docs.select(F.xxhash64("doc_id", "text").alias("key"), "text").mapInArrow(pairs, "key long, word long, times int")
    share = F.col("times") * F.log1p(F.coalesce("n", F.lit(0)).cast("double"))
    return rows.join(counts, "word", "left").groupBy("key").agg(F.sum(share).alias("share"), F.sum("times").alias("times"))


def score(docs: DataFrame, max_rows: int | None = None, corpus: DataFrame | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, log_prob, mean_log_prob; counts and network from ``corpus`` (the documents themselves if None)."""
    corpus = docs if corpus is None else corpus
    counts = word_counts(corpus)
    shared = docs.sparkSession.sparkContext.broadcast(train(corpus, max_rows, counts))

    @F.arrow_udf("n long, total double, rare long")
    def pseudo_likelihood(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            few = [shared.value.score(some, with_rare=True) for some in several(part)]
            n, total, rare = (np.concatenate([x[k] for x in few]) if few else np.zeros(0) for k in (0, 1, 2))
            yield pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(total, pa.float64()), pa.array(rare, pa.int64())], ["n", "total", "rare"])

    found = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), pseudo_likelihood(F.col("text")).alias("s"))
    found = found.join(rare_shares(docs, shared, counts), "key", "left")
    # The row's part of what all rows of its key have.
    total = F.col("s.total") + F.when(F.col("s.rare") > 0, F.col("share") * F.col("s.rare") / F.col("times")).otherwise(0.0)
    return found.select("doc_id", F.col("s.n").alias("n_words"), total.alias("log_prob"),
                        F.when(F.col("s.n") > 0, total / F.col("s.n")).otherwise(0.0).alias("mean_log_prob"))
