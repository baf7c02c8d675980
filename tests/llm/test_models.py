"""Language identification, quality classifier and LM scoring."""
from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from laborstar.llm import langid, lm, quality
from laborstar.llm._tokens import words
from laborstar.llm.queries import queries, table
from tests.conftest import SF_MID
from tests.llm import cases

ROWS = cases.corpus(n=20)


def test_words_match_a_regular_expression():
    texts = [r[1] for r in ROWS] + ["a\x1cb\x85c\xa0d", "x" * 3_000_000 + " y", "\x0b\x0c\r"]
    found = words(pa.array(texts))
    for i, t in enumerate(texts):
        part = slice(found.first[i], found.first[i + 1])
        got = [bytes(found.data[a:b]).decode() for a, b in zip(found.start[part], found.end[part])]
        assert got == cases.SPACES.findall(t or "")
    seen: dict = {}
    for a, b, h in zip(found.start, found.end, found.hash):
        assert seen.setdefault(int(h), bytes(found.data[a:b])) == bytes(found.data[a:b])
    again = words(pa.array(["pad pad", *texts]).slice(1))                       # an array with an offset
    assert (again.hash == found.hash).all() and (again.first == found.first).all()


# ---- PPM --------------------------------------------------------------------------------------

def ppm_tree(texts):
    tree: dict = {}
    for t in texts:
        b = [0] * langid.ORDER + [x + 1 for x in t.encode()]
        for i in range(langid.ORDER, len(b)):
            for k in range(langid.ORDER + 1):
                node = tree.setdefault(tuple(b[i - k:i]), {})
                node[b[i]] = node.get(b[i], 0) + 1
    return tree


def ppm_bits(tree, text):
    def dist(context):
        base = dist(context[1:]) if context else {x: 1 / 256 for x in range(1, 257)}
        node = tree.get(context)
        if not node:
            return base
        distinct, total = len(node), sum(node.values())
        free = sum(v for x, v in base.items() if x not in node)
        if free <= 0:
            return {x: node[x] / total for x in node}
        return {x: node[x] / (total + distinct) if x in node else distinct / (total + distinct) * v / free for x, v in base.items()}

    b = [0] * langid.ORDER + [x + 1 for x in text.encode()]
    return sum(-math.log2(dist(tuple(b[i - langid.ORDER:i]))[b[i]]) for i in range(langid.ORDER, len(b)))


def model_of(labelled):
    batch = pa.RecordBatch.from_arrays([pa.array([x[0] for x in labelled]), pa.array([x[1] for x in labelled])], names=["lang", "text"])
    return langid.Model(pd.concat([b.to_pandas() for b in langid._count(iter([batch]))]))


def test_code_lengths_are_exact(monkeypatch):
    labelled = [("en", "the cat and the hat"), ("en", "a hat"), ("fr", "le chat et l'été"), ("fr", "là")]
    model = model_of(labelled)
    probes = ["the chat", "été", "", "z", "le", "xyz " * 5, "th", "漢字 q"]
    for monkey in (1 << 20, 5):                                       # pieces that cut texts give the same sums
        monkeypatch.setattr(langid, "PIECE", monkey)
        got = model.lengths(pa.array(probes))
        for j, lang in enumerate(model.langs):
            tree = ppm_tree([t for x, t in labelled if x == lang])
            assert got[:, j] == pytest.approx([ppm_bits(tree, p) for p in probes], rel=1e-5)


def test_language_of_awkward_rows(spark):
    df = cases.frame(spark, ROWS)
    got = langid.identify(df).collect()
    assert len(got) == len(ROWS)
    text = {}
    for r in ROWS:
        text.setdefault(r[0], set()).add(r[1])
    for r in got:
        lettered = {any(c.isalpha() for c in t or "") for t in text[r["doc_id"]]}
        assert (r["lang_pred"] != "und") in lettered and 0 <= r["score"] <= 1
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
    assert {r["lang_pred"] for r in got} <= {"en", "fr", "und"}


def test_language_without_labels(spark):
    df = cases.frame(spark, [(i, "some text", None, "a", 9) for i in range(5)])
    assert {(r["lang_pred"], r["score"]) for r in langid.identify(df).collect()} == {("und", 0.0)}
    assert langid.identify(cases.frame(spark, [])).count() == 0


def test_language_held_out_accuracy(spark):
    docs = table(spark, SF_MID, "documents").select("doc_id", "lang")
    got = queries()["op1_language_id"](spark, SF_MID).join(docs, "doc_id").where("held_out").toPandas()
    assert len(got) > 150 and (got["lang"] == got["lang_pred"]).mean() >= 0.97


# ---- quality ----------------------------------------------------------------------------------

def test_quality_dot_product_and_batches():
    texts = [r[1] for r in ROWS]
    w = np.random.default_rng(0).standard_normal(quality.DIMS + 1)
    whole = quality.dot(pa.array(texts), w)
    assert whole == pytest.approx([quality.dot(pa.array([t], pa.string()), w)[0] for t in texts])
    assert whole[[i for i, t in enumerate(texts) if not (t or "").split()]] == pytest.approx(w[quality.DIMS])


def test_ftrl_separates_and_is_sparse():
    rng = np.random.default_rng(3)
    good = [" ".join(rng.choice(list("abcdefgh"), 30)) for _ in range(40)]
    bad = [t.upper() + "!!" for t in good]
    w = quality.ftrl(pa.array(good + bad), np.array([1.0] * 40 + [0.0] * 40))
    p = quality.sigmoid(quality.dot(pa.array(good + bad), w))
    assert p[:40].min() > 0.5 > p[40:].max() and (w != 0).sum() < quality.DIMS / 10


def test_ftrl_equals_a_replay(monkeypatch):
    """One update after the other, place by place, in plain numbers."""
    monkeypatch.setattr(quality, "DIMS", 64)
    rng = np.random.default_rng(5)
    texts = [" ".join(rng.choice(list("abcdefgh"), rng.integers(1, 12))) for _ in range(25)] + ["", "A B!"]
    y = rng.integers(0, 2, len(texts)).astype(float)
    z, n = Counter(), Counter()

    def weight(i):
        if abs(z[i]) <= quality.L1:
            return 0.0
        return (math.copysign(quality.L1, z[i]) - z[i]) / ((quality.BETA + math.sqrt(n[i])) / quality.ALPHA + quality.L2)

    rows = []
    for t in texts:
        blocks, words_of = quality._features(pa.array([t]))
        count = Counter(int(p) for _, at in blocks for p in at)
        rows.append({p: float(np.float32(quality.SCALE * c / max(words_of[0], 1))) for p, c in count.items()} | {64: 1.0})
    for _ in range(quality.EPOCHS):
        for row, label in zip(rows, y):
            w = {i: weight(i) for i in row}
            p = 1 / (1 + math.exp(-sum(w[i] * x for i, x in row.items())))
            for i, x in row.items():
                g = (p - label) * x
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / quality.ALPHA * w[i]
                n[i] += g * g
    assert quality.ftrl(pa.array(texts), y) == pytest.approx([weight(i) for i in range(65)], abs=1e-4)


def test_quality_of_awkward_rows(spark):
    df = cases.frame(spark, ROWS)
    labels = cases.frame(spark, [(r[0], i % 2, None) for i, r in enumerate(ROWS)] + [(1, 1, 0), (4, None, 0), (7, 9, 0), (None, 1, 1)],
                         "doc_id long, quality int, toxic int")
    got = quality.classify(df, labels).collect()
    assert len(got) == len(ROWS) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    assert quality.keep_good(df, labels).columns == df.columns
    unlabelled = quality.classify(df, labels.limit(0)).collect()
    assert {r["score"] for r in unlabelled} == {0.5}
    assert quality.classify(cases.frame(spark, []), labels).count() == 0


def test_quality_held_out_accuracy(spark):
    labels = table(spark, SF_MID, "labels")
    got = queries()["op8_quality_classifier"](spark, SF_MID).join(labels, "doc_id").where("held_out").toPandas()
    assert len(got) > 50 and (got["quality"] == got["predicted"]).mean() >= 0.97


# ---- language model ---------------------------------------------------------------------------

def small_model():
    texts = ["the cat sat on the mat"] * 30 + ["on the mat the cat sat"] * 30
    w, n = np.unique(words(pa.array(texts), lower=True).hash.view(np.int64), return_counts=True)
    model = lm.Model(w, np.concatenate([n, np.zeros(lm.RARE)]))
    model.fit(pa.array(texts))
    return model


def test_conditionals_sum_to_one_and_match_a_loop():
    model = small_model()
    text = "the cat flew on the mat"
    found = words(pa.array([text]), lower=True)
    symbol = model.symbols(found.hash.view(np.int64))
    total = 0.0
    for i in range(len(symbol)):
        around = [[symbol[i + k] if 0 <= i + k < len(symbol) else model.size] for k in lm.PLACES]
        h = np.tanh(model.bias + sum(e[a[0]] for e, a in zip(model.embed, around)))
        z = h @ model.out + model.base
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        every = p[model.classes] * np.exp(model.inside)
        assert every.sum() == pytest.approx(1, abs=1e-4)
        total += np.log(every[symbol[i]])
    n, got = model.score(pa.array([None, text, ""]))
    assert list(n) == [0, 6, 0] and got == pytest.approx([0, total, 0], rel=1e-4)


def test_training_prefers_the_order_it_saw(monkeypatch):
    model = small_model()
    _, got = model.score(pa.array(["the cat sat on the mat", "mat sat the the on cat"]))
    assert got[0] > got[1]
    whole = model.score(pa.array([r[1] for r in ROWS]))[1]
    monkeypatch.setattr(lm, "PIECE", 7)
    assert model.score(pa.array([r[1] for r in ROWS]))[1] == pytest.approx(whole, rel=1e-4)


def test_lm_scores_every_row(spark):
    got = lm.score(cases.frame(spark, ROWS), max_rows=10)
    want = sorted((r[0] or -1, len(cases.SPACES.findall(r[1] or ""))) for r in ROWS)
    rows = got.collect()
    assert sorted((r["doc_id"] or -1, r["n_words"]) for r in rows) == want
    assert all((r["log_prob"] < 0) == (r["n_words"] > 0) for r in rows)
    assert lm.score(cases.frame(spark, [])).count() == 0


def test_corpus_counts_cover_all_documents(spark, monkeypatch):
    monkeypatch.setattr(lm, "VOCAB", 20)
    vocab, counts = lm.symbol_counts(cases.frame(spark, ROWS))
    assert len(vocab) == 20 and (np.diff(vocab) > 0).all()
    assert counts.sum() == sum(len(cases.SPACES.findall(r[1] or "")) for r in ROWS)


def test_network_learns_from_every_document(spark):
    """More documents than the old sample had: each has a word of its own place, and that word's embedding is trained."""
    df = cases.frame(spark, [(i, f"begin own{i} end", "en", "a", 0) for i in range(1_500)], clashing=False)
    model, start = lm.train(df), lm.Model(*lm.symbol_counts(df))
    own = words(pa.array([f"own{i}" for i in range(1_500)]), lower=True).hash.view(np.int64)
    place = lm.PLACES.index(1)                                  # own words follow "begin"
    moved = (model.embed[place] != start.embed[place]).any(axis=1)
    assert moved[model.symbols(own)].all() and np.isfinite(model.embed).all()


def test_one_partition_trains_as_the_driver_does(spark):
    texts = ["the cat sat on the mat", "on the mat the cat sat"] * 40
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    got, want = lm.train(df), lm.Model(*lm.symbol_counts(df))
    for _ in range(lm.EPOCHS):
        want.learn(pa.array(texts))
    assert np.allclose(got.embed, want.embed, atol=1e-5) and np.allclose(got.out, want.out, atol=1e-5)
    assert np.allclose(got.bias, want.bias, atol=1e-5) and np.allclose(got.base, want.base, atol=1e-5)


def test_rare_words_have_their_own_share(spark, monkeypatch):
    """Against a loop; shares of a bucket's words and of what the corpus lacks sum to one; an unseen word is the least likely."""
    monkeypatch.setattr(lm, "VOCAB", 20)
    rows = ROWS + [(900, "gu " * 3 + "unheardofword", "en", "a", 0)]
    corpus = cases.frame(spark, ROWS)
    counts = lm.word_counts(corpus)
    model = lm.train(corpus, counts=counts)
    n = {r["word"]: r["n"] for r in counts.collect()}
    types = Counter(w % lm.RARE for w in n if w not in set(model.vocab.tolist()))
    got = Counter()
    for r in lm.score(cases.frame(spark, rows), corpus=corpus).collect():
        got[r["doc_id"], r["n_words"], round(r["log_prob"], 2)] += 1
    want = Counter()
    for r in rows:
        text = pa.array([r[1]], pa.string())
        word = words(text, lower=True).hash.view(np.int64)
        size, total = model.score(text)
        for w, s in zip(word.tolist(), model.symbols(word).tolist()):
            if s >= len(model.vocab):
                total[0] += np.log(n.get(w, 0) + 1) - np.log(model_count(n, w, model) + types[w % lm.RARE] + 1)
        want[r[0], int(size[0]), round(float(total[0]), 2)] += 1
    near = lambda c: sorted((k[0] or -1, k[1], k[2], v) for k, v in c.items())
    assert len(got) == len(want) and all(a[:2] == b[:2] and a[2] == pytest.approx(b[2], rel=1e-3) and a[3] == b[3] for a, b in zip(near(got), near(want)))
    bucket = next(iter(types))
    inside = [np.exp(np.log(c + 1) - model.bucket[bucket]) for w, c in n.items() if w % lm.RARE == bucket and w not in set(model.vocab.tolist())]
    assert sum(inside) + np.exp(-model.bucket[bucket]) == pytest.approx(1)


def model_count(n, word, model):
    known = set(model.vocab.tolist())
    return sum(c for w, c in n.items() if w % lm.RARE == word % lm.RARE and w not in known)
