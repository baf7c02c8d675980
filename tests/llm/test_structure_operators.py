"""Embedding whitening, conversation repair and toxicity against brute force."""
from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from laborstar.llm import repair, toxicity, whitening
from laborstar.llm.queries import queries, table
from tests.conftest import SF_MID, SF_SMALL
from tests.llm import cases

# ---- whitening --------------------------------------------------------------------------------


def whitened_rows(rows, components=16):
    """(id, n, deviation, whitened, explained) per remaining row from one eigendecomposition."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(64 * c) + 1000000 for c in v] for _, v in kept]
    d = max(map(len, x))
    x = np.array([v + [1000000] * (d - len(v)) for v in x], np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(0)
    c = (fit * n - sums) / n
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1], u[:, ::-1]
    k = min(components, d)
    return [(i, n, int(dev), w, e[:k] / e.sum()) for (i, _), dev, w in
            zip(kept, ((x * n - sums) ** 2).sum(1), ((x * n - sums) / n) @ u[:, :k] / np.sqrt(e[:k]))]


def same_whitening(got, want):
    rows = {}
    for r in got:
        rows.setdefault(r["vec_id"], {})[r["component"]] = r
    assert sorted(rows) == sorted(w[0] for w in want)
    k = len(want[0][3])
    first = np.array([[rows[w[0]][c + 1]["whitened"] for c in range(k)] for w in want])
    other = np.array([w[3] for w in want])
    sign = np.sign((first * other).sum(0))
    assert first == pytest.approx(other * sign, abs=1e-8)
    for i, n, dev, _, explained in want:
        for c in range(k):
            r = rows[i][c + 1]
            assert (r["n"], r["deviation"]) == (n, dev) and r["explained"] == pytest.approx(explained[c], rel=1e-8) and r["identity_error"] < 1e-9


def test_whitening_equals_an_eigendecomposition(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(150, 5)) * [30, 3, 1, 0.5, 0.2] @ rng.normal(size=(5, 5))
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(base)]
    rows += [(500 + i, rows[0][1]) for i in range(40)]                                      # a vector that many rows share
    rows += [(600, None), (601, [1.0, None, 2.0, 0.0, 1.0]), (602, [math.nan] * 5), (603, [math.inf, 0.0, 0.0, 0.0, 0.0]), (604, [0.5, 0.25]), (605, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(6)
    df = df.selectExpr("*", "1 as x", "2 as n", "3 as i", "'v' as v", "4 as label")
    same_whitening(whitening.whiten(df).collect(), whitened_rows(rows))


def test_whitening_of_the_table(spark):
    rows = [tuple(r) for r in table(spark, SF_SMALL, "embeddings").select("vec_id", "embedding").collect()]
    same_whitening(queries()["op11_embedding_whitening"](spark, SF_SMALL).collect(), whitened_rows(rows))


def test_whitening_of_dependent_columns(spark):
    """Columns that depend on others have no variance left: whitened 0, and the rest is still whitened."""
    rng = np.random.default_rng(2)
    a = np.round(rng.normal(size=(80, 2)) * 5)
    rows = [(i, [x, y, x, x + y, 7.0]) for i, (x, y) in enumerate(a.tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = whitening.whiten(df).toPandas()
    assert len(got) == 400 and (got[got.component > 2][["whitened", "explained"]] == 0).all().all() and got.identity_error.max() < 1e-9
    assert got[got.component <= 2].groupby("component")["explained"].first().sum() == pytest.approx(1)
    still = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], "vec_id long, embedding array<double>")
    assert {(r["n"], r["deviation"], r["whitened"]) for r in whitening.whiten(still).collect()} == {(1, 0, 0.0)}
    assert whitening.whiten(df.limit(0)).collect() == []
    huge = spark.createDataFrame([(1, [1e30, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 0.0])], "vec_id long, embedding array<double>")
    assert {r["deviation"] for r in whitening.whiten(huge).collect()} == {None}


def test_ill_conditioned_columns_take_several_factors(spark):
    """Scales nine digits apart: one Gram matrix would lose the small one, the composed factors keep it."""
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.normal(size=300) * 1e7, rng.normal(size=300)])
    x[:, 1] += x[:, 0] * 1e-3
    fit = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = whitening.Whitening(whitening.fit_list(whitening.integers(fit)))
    assert found.passes >= 2 and found.identity_error < 1e-4 and found.e.min() > 0


# ---- conversations ----------------------------------------------------------------------------

STEPS = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}


def damage(rows):
    """The rows of every conversation after the contract's damage."""
    out = {}
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        case = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        mine = out.setdefault(c, [])
        if case:
            text = "" if case == 1 else re.sub("[.!?]", "", text) if case == 2 else text
            mine += [(t, "user" if case == 4 else role, text)] * (2 if case == 3 else 1)
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2])) for c, r in out.items()}


def repaired(rows):
    """Figures of one conversation, with whole strings of edits in the programme."""
    turns = {t for t, _, _ in rows if t is not None}
    seen, faults = set(), []
    for _, role, text in rows:
        body = text.strip(" \t\n\x0b\f\r")
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    best = {"": (0, ""), "a": (0, ""), "u": (5, "I"), "s": (10, "II")}
    for (_, role, _), fault in reversed(list(zip(rows, faults))):
        new = {}
        for state in STEPS:
            options = [(best[state][0] + 2, "D" + best[state][1])]
            if fault in ("", "truncated"):
                more = 5 * (fault == "truncated")
                for name, cost, kind in [("K", 0, role[:1]), ("R", 1, "u"), ("R", 1, "a")]:
                    if kind and kind in STEPS[state]:
                        cost_after, edits = best[STEPS[state][kind]]
                        options.append((cost + more + cost_after, name + edits))
            new[state] = min(options)
        for _ in range(4):
            new = {s: min([new[s]] + [(new[t][0] + 5, "I" + new[t][1]) for k, t in STEPS[s].items() if k != "s"]) for s in new}
        best = new
    cost, audit = best[""]
    said, state, rest = [], "", iter(rows)
    for edit in audit:
        _, role, text = next(rest) if edit != "I" else (None, "", "")
        if edit != "D":
            state = role[0] if edit == "K" else "a" if state == "u" else "u"
            said.append(f"{role if edit == 'K' else {'u': 'user', 'a': 'assistant'}[state]}:{text}")
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows)), cost, audit, cases.sha("\n".join(said)))


def talks(seed: int, sizes):
    rng = random.Random(seed)
    roles = ["user", "assistant"] * 3 + ["system", "tool", "", None, "u", "sx"]
    texts = ["Hi there.", "ok", "", " ", None, "What?", "yes!  ", "é. x", "same.", "\n"]
    return [(c, rng.choice([None, k, k, k, k // 2, k + 3]), rng.choice(roles), rng.choice([*texts, f"n{k}.", f"n{k}"]))
            for c, n in sizes for k in range(n)]


TALK = "conv_id long, turn long, role string, text string"


def same_repair(df):
    want = {c: repaired(r) for c, r in damage([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]).items()}
    rows = repair.report(df).collect()
    assert {r["conv_id"]: tuple(r)[1:] for r in rows} == want and len(rows) == len(want)


def test_repair_equals_brute_force(spark):
    sizes = [(c, random.Random(c).choice([1, 2, 3, 8, 40])) for c in range(50)] + [(None, 5), (77, 700)]
    df = spark.createDataFrame(talks(3, sizes), TALK).repartition(7).selectExpr("*", "1 as run", "'x' as seq", "2 as part", "3 as cost", "4 as case")
    same_repair(df)


def test_a_hot_conversation_in_many_runs(spark):
    """Partitions that are not merged cut conversations into runs, and identical rows lie in several of them."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(talks(4, [(1, 600), (2, 20), (3, 1)]) + [(1, 9, "user", "again.")] * 200, TALK).repartition(4)
        assert repair.runs(repair.judged(repair.ordered(df))).where("conv_id = 1").count() > 3
        same_repair(df)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_repair_of_the_table_and_of_nothing(spark):
    same_repair(table(spark, SF_SMALL, "conversations"))
    empty = spark.createDataFrame([], TALK)
    assert repair.report(empty).collect() == []
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = repair.report(spark.createDataFrame([(gone, 0, "user", "hi.")], TALK)).collect()
    assert [tuple(r) for r in got] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]


def test_walk_keeps_few_vectors_and_is_least():
    """A walk with blocks of any size gives the same edits; and no other edits of a short run are cheaper or sort before them."""
    rng = random.Random(5)
    for _ in range(200):
        codes = "".join(rng.choice("abcdefghijkl") for _ in range(rng.randint(1, 6)))
        edits, _, front = repair.walk(codes, repair.END, True)
        best = min((cost, e) for cost, e in every_edit(codes) if cost is not None)
        assert (front[repair.START], edits[repair.START]) == best


def every_edit(codes, inserts: int = 4):
    for n in range(inserts + 1):
        for where in itertools.combinations_with_replacement(range(len(codes) + 1), n):
            for marks in itertools.product("DKR", repeat=len(codes)):
                edits = "".join("I" * where.count(i) + (marks[i] if i < len(codes) else "") for i in range(len(codes) + 1))
                yield cost_of(codes, edits), edits


def cost_of(codes, edits):
    state, cost, rest = repair.START, 0, iter(codes)
    for e in edits:
        if e == "I":
            state, cost = repair.NEXT[state], cost + 5
            continue
        move = [m for m in repair.MOVES[next(rest)][state] if m[0] == e]
        if not move:
            return None
        cost, state = cost + move[0][1], move[0][2]
    return cost if state in (repair.START, repair.ASSISTANT) else None


# ---- toxicity ---------------------------------------------------------------------------------

def maximal_segments(score):
    """Ruzzo and Tompa's definition: the best segment (the shortest of equals), then the same on both sides."""
    def within(lo, hi):
        best = max(((sum(score[a:b]), -(b - a), -a) for a in range(lo, hi) for b in range(a + 1, hi + 1)), default=(0, 0, 0))
        if best[0] <= 0:
            return []
        a = -best[2]
        b = a - best[1]
        return within(lo, a) + [(a, b, best[0])] + within(b, hi)
    return within(0, len(score))


def test_segments_are_maximal():
    rng = random.Random(1)
    for _ in range(150):
        score = [rng.choice([-3, -2, -1, 0.5, 1, 2, 4]) + rng.random() / 1e3 for _ in range(rng.randint(0, 18))]
        got = toxicity.segments(np.array(score))
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in maximal_segments(score)]
        assert [s for *_, s in got] == pytest.approx([s for *_, s in maximal_segments(score)])


def test_tokens_and_counts():
    texts = [r[1] for r in cases.corpus(n=10)]
    place, first = toxicity.places(pa.array(texts))
    found, seen = [cases.WORDS.findall((t or "").translate(cases.UPPER)) for t in texts], {}
    assert np.diff(first).tolist() == [len(w) for w in found]
    for p, w in zip(place, itertools.chain(*found)):
        assert seen.setdefault(w, p) == p
    counts = toxicity.document_counts(pa.array(texts))
    assert counts.sum() == sum(len({seen[w] for w in words}) for words in found)
    assert counts[seen["licensed"]] == sum("licensed" in w for w in found)


def test_law_of_clean_text():
    """lambda makes the expected odds one, and evidence grows with the best segments and falls with the length."""
    score = np.array([2.0, 0.5, -1.0])
    share = np.array([0.05, 0.2, 0.75])
    assert share @ np.exp(toxicity.root(share, score) * score) == pytest.approx(1)
    model = toxicity.Model(score, 1.0, 0.0, (-2.0, 1.0))
    one, two = np.array([9.0]), np.array([9.0, 8.0])
    assert model.evidence(10, two) > model.evidence(10, one) > model.evidence(1000, one) > 0 == model.evidence(10, np.array([]))
    assert model.evidence(10, np.array([9.0])) == pytest.approx(-math.log(2 * -math.expm1(-math.exp(math.log(10) - 9))))
    u, y = np.repeat([0.0, 1.0, 3.0], 100), np.concatenate([np.zeros(100), np.tile([0, 1], 50), np.ones(100)])
    a, b = toxicity.logistic(u, y)
    assert b > 0 and 1 / (1 + math.exp(-a - b * 3)) > 0.9 > 0.1 > 1 / (1 + math.exp(-a))


def test_toxicity_of_awkward_rows(spark):
    rows = cases.corpus(n=30)
    rows += [(2000 + i, cases.prose(random.Random(i), 60) + (" vile" * 2 if i % 4 == 0 else ""), "en", "a", 0) for i in range(160)]
    df = cases.frame(spark, rows)
    labels = [(r[0], int(" vile" in (r[1] or "")), 1) for r in rows] + [(1, 1, 0), (4, None, 0), (7, 9, 0), (None, 1, 1)]
    labels = cases.frame(spark, labels, "doc_id long, toxic int, quality int")
    got = toxicity.classify(df, labels).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert {r["score"] for r in toxicity.classify(df, labels.limit(0)).collect()} == {0.0}
    assert toxicity.classify(cases.frame(spark, []), labels).count() == 0


def test_passages_are_found(spark):
    rng = random.Random(8)
    rows = []
    for i in range(300):
        words = cases.prose(rng, 80).split()
        if i % 5 == 0:
            words[30:33] = ["wretch", "cur", "knave"]
        rows.append((i, " ".join(words), "en", "a", 0))
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(300)], "doc_id long, toxic int")
    monkey = pytest.MonkeyPatch()
    monkey.setattr(toxicity, "PRIOR", 200.0)
    try:
        found = toxicity.passages(cases.frame(spark, rows), labels).collect()
    finally:
        monkey.undo()
    inside = {r["doc_id"] for r in found if r["first_token"] <= 30 and r["first_token"] + r["tokens"] >= 33}
    assert inside >= {i for i in range(0, 300, 5)} and len({r["doc_id"] for r in found} - inside) <= 3


def test_toxicity_held_out(spark):
    """Few labels at this size (70 held-out rows, 6 toxic): clean documents are left alone and the ranking holds."""
    labels = table(spark, SF_MID, "labels")
    got = queries()["op13_toxicity"](spark, SF_MID).join(labels, "doc_id").where("held_out").toPandas()
    toxic, clean = got[got["toxic"] == 1], got[got["toxic"] == 0]
    assert (clean["predicted"] == 0).mean() >= 0.95 and (toxic["predicted"] == 1).mean() >= 0.5


def test_a_sample_is_bounded_and_never_empty(spark):
    docs = cases.frame(spark, [(1, f"text {i}", "en", "a", 0) for i in range(50)])
    labels = spark.createDataFrame([(1, 1), (1, 1), (1, 0)], "doc_id long, toxic int")
    assert 0 < toxicity.sample(docs, labels, 10).count() <= 10
