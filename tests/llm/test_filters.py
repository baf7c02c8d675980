"""Line dedup, SimHash groups, decontamination and substring dedup against brute force."""
from __future__ import annotations

import random
from collections import Counter

import pytest

from laborstar.llm import decontam, linededup, simhash, substring
from tests.llm import cases

ROWS = cases.corpus()


def test_line_dedup_equals_brute_force(spark):
    want = cases.dedup_lines(ROWS)
    got = cases.rows_of(linededup.report(cases.frame(spark, ROWS)))
    assert got == Counter((d, n, x, cases.sha(t)) for d, n, x, t in want)
    assert sum(x for _, _, x, _ in want) > 5


def test_line_dedup_keeps_columns_and_null_texts(spark):
    df = cases.frame(spark, ROWS)
    out = linededup.dedup(df)
    assert out.columns == df.columns and dict(out.dtypes) == dict(df.dtypes)
    assert out.select(*cases.CLASHING).distinct().collect() == df.select(*cases.CLASHING).distinct().collect()
    want = Counter((d, t if r[1] is not None else None) for r, (d, _, _, t) in zip(ROWS, cases.dedup_lines(ROWS)))
    assert cases.rows_of(out.select("doc_id", "text")) == want
    assert out.where("n_chars <> char_length(text)").count() == 0


@pytest.mark.parametrize("batches", [1, 5])
def test_line_dedup_does_not_depend_on_batches(spark, batches):
    df = cases.frame(spark, [r for r in ROWS if r[0] is not None])
    a, b = (cases.rows_of(linededup.dedup_lines(df, batches=k).select("doc_id", "__kept")) for k in (batches, 3))
    assert a == b


def test_line_runs_leave_settled_keys_out(spark):
    runs = linededup.Runs(spark, min_docs=3, fanout=9)
    schema = "k1 long, k2 int, n long, holder long"
    runs.add(spark.createDataFrame([(1, 1, 3, 90), (2, 2, 1, 91)], schema))
    runs.add(spark.createDataFrame([(1, 1, 5, 50), (2, 2, 2, 51)], schema))
    second = spark.table(runs.levels[0][1])
    assert cases.rows_of(second) == Counter([(2, 2, 2, 51)])
    assert cases.rows_of(runs.merged()) == Counter([(1, 1, 3, 90), (2, 2, 3, 91)])
    runs.close()


@pytest.mark.parametrize("bucket", [32, 1])
def test_simhash_groups_equal_all_pairs(spark, bucket):
    """bucket=1 sends every shared key through the one-bit neighbours."""
    fps = [cases.fingerprint(r[1]) for r in ROWS]
    group = cases.components(fps)
    least = {g: min((r[0] for r, x in zip(ROWS, group) if x == g and r[0] is not None), default=None) for g in group}
    want = Counter((r[0], cases.signed(f), least[g]) for r, f, g in zip(ROWS, fps, group))
    got = simhash.classes(cases.frame(spark, ROWS), bucket=bucket)
    assert cases.rows_of(got.select("id", "fp", "component_id")) == want
    assert len(set(group)) < len(ROWS) - 5


def test_simhash_links_chains_and_stars(spark):
    """Fingerprints two bits apart in a row, and many around one centre, are one group each."""
    chain = [sum(3 << 2 * j for j in range(k)) for k in range(12)]
    centre = 0xF0F0F0F0F0F0F0F0
    star = [centre] + [centre ^ (1 << i) ^ (1 << j) for i in range(0, 64, 2) for j in range(1, 64, 7)]
    far = [0x0123456789ABCDEF]
    fps = list(dict.fromkeys(chain + star + far))
    df = spark.createDataFrame([(cases.signed(f),) for f in fps], "fp long")
    from laborstar.llm._graph import components
    got = {r["node"]: r["root"] for r in components(simhash.links(df, bucket=4)).collect()}
    group = cases.components(fps)
    for i, f in enumerate(fps):
        for j in range(i):
            a, b = (got.get(cases.signed(x), cases.signed(x)) for x in (f, fps[j]))
            assert (a == b) == (group[i] == group[j])


def test_simhash_keeps_one_document_of_each_group(spark):
    df = cases.frame(spark, ROWS)
    out = simhash.keep_first(df)
    assert out.columns == df.columns
    assert out.select(*cases.CLASHING).distinct().collect() == df.select(*cases.CLASHING).distinct().collect()
    group = cases.components([cases.fingerprint(r[1]) for r in ROWS])
    kept = out.select("doc_id", "text").collect()
    assert len(kept) == len(set(group))
    ids = {r[0] for r in kept}
    for g in set(group):
        members = [r[0] for r, x in zip(ROWS, group) if x == g and r[0] is not None]
        assert not members or min(members) in ids


def test_simhash_fingerprint_of_long_and_short_texts():
    for text in (None, "", " ", "a", "a B", "a b c", "x y " * 40_000, "é ü " * 3):
        assert simhash.fingerprint_of(text) == cases.fingerprint(text)


ITEMS = [(1, ROWS[7][1]), (2, " ".join(ROWS[9][1].split()[3:16])), (2, "ONE"), (30, "the benchmark has a passage of words that no one wrote yet"),
         (4, None), (5, "?!"), (None, " ".join(ROWS[12][1].split()[:11])), (11, "same same same")]


def test_decontamination_equals_brute_force(spark):
    items = cases.frame(spark, ITEMS, "item_id long, text string")
    got = cases.rows_of(decontam.report(cases.frame(spark, ROWS), items))
    want = cases.decontaminate(ROWS, ITEMS)
    assert got == Counter(want) and sum(w[5] for w in want) >= 5


def test_decontamination_without_broadcast(spark):
    conf = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    saved = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k in conf:
            spark.conf.set(k, "-1")
        items = cases.frame(spark, ITEMS, "item_id long, text string")
        assert cases.rows_of(decontam.report(cases.frame(spark, ROWS), items)) == Counter(cases.decontaminate(ROWS, ITEMS))
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_decontamination_drops_contaminated_documents_only(spark):
    df = cases.frame(spark, ROWS)
    out = decontam.keep_clean(df, cases.frame(spark, ITEMS, "item_id long, text string"))
    want = Counter((r[0], r[1]) for r, w in zip(ROWS, cases.decontaminate(ROWS, ITEMS)) if not w[5])
    assert out.columns == df.columns and cases.rows_of(out.select("doc_id", "text")) == want
    assert out.select(*cases.CLASHING).distinct().collect() == df.select(*cases.CLASHING).distinct().collect()


def test_proximity_matches(spark):
    """With slop, a window whose words moved by one place is found; exact matches stay marked."""
    words = [f"w{i}" for i in range(10)]
    moved = words[:4] + ["new"] + words[4:]
    docs = cases.frame(spark, [(1, " ".join(words), "en", "a", 1), (2, "x y " + " ".join(moved), "en", "a", 1),
                               (3, " ".join(reversed(words)), "en", "a", 1)])
    items = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    exact, _ = decontam.matches(docs, items)
    near, _ = decontam.matches(docs, items, slop=1)
    assert {r["id"] for r in exact.collect()} == {1}
    assert {(r["id"], r["exact"]) for r in near.collect()} == {(1, True), (2, False)}


def assigned(text, terms, start, slop):
    """Whether every term can have a word of its own within ``slop`` of its place, by trying all."""
    def rest(j, used):
        if j == len(terms):
            return True
        reach = range(max(0, start + j - slop), min(len(text), start + j + slop + 1))
        return any(text[p] == terms[j] and p not in used and rest(j + 1, used | {p}) for p in reach)
    return rest(0, frozenset())


@pytest.mark.parametrize("slop", [0, 1, 2])
def test_proximity_equals_brute_force(spark, slop):
    """Windows with repeated terms, moved words, matches at the first word, on texts of few different words."""
    rng = random.Random(slop)
    items = [(1, "a b c d e f g h i j"), (2, "a a b a c"), (3, "b a a c c a b b a a d"), (4, "x"), (5, "c b a")]
    texts = ["b a c d e f g h i j", "j a b c d e f g h i", "a b c d e f g h j i tail", "a b a a c", "a a a b c", "a a b b", "x y x", "c a b", "a b", ""]
    for _ in range(60):
        base = rng.choice(items)[1].split()
        for _ in range(rng.randint(0, 4)):
            i = rng.randrange(max(1, len(base) - 1))
            base[i:i + 2] = base[i:i + 2][::-1] if rng.random() < 0.7 else base[i:i + 1] + [rng.choice("abcxz")] + base[i + 1:i + 2]
        texts.append(" ".join(rng.choices("abcz", k=rng.randint(0, 3)) + base + rng.choices("abcdz", k=rng.randint(0, 3))))
    wins = {tuple(w[i:i + 10]) for _, t in items for w in [t.split()] for i in range(max(1, len(w) - 9))}
    want = {(d, " ".join(w), s, tuple(text[s:s + len(w)]) == w) for d, t in enumerate(texts) for text in [t.split()] for w in wins
            for s in range(len(text) - len(w) + 1) if assigned(text, w, s, slop)}
    docs = cases.frame(spark, [(d, t, "en", "a", 1) for d, t in enumerate(texts)])
    found, _ = decontam.matches(docs, spark.createDataFrame(items, "item_id long, text string"), slop=slop)
    assert {(r["id"], r["win"], r["start"], r["exact"]) for r in found.collect()} == want and len(want) > 20


@pytest.mark.parametrize("group", [5_000, 0])
def test_substring_dedup_equals_brute_force(spark, group):
    """group=0 lengthens every shared prefix to the whole window."""
    out = substring.remove_repeats(cases.frame(spark, ROWS).select("doc_id", "text"), group)
    want = cases.remove_repeats(ROWS)
    assert cases.rows_of(out.select("doc_id", "__n_words", "__n_removed", "__sha")) == Counter(want)
    assert sum(w[2] for w in want) > 500


def test_one_long_text_is_a_large_group(spark):
    """Two documents, one of which repeats a passage so often that its windows are no memory-sized group."""
    passage = [f"p{i}" for i in range(60)]
    rows = [(1, " ".join(passage * 40), "en", "a", 0), (2, " ".join(["x", *passage, "y"]), "en", "a", 0), (3, " ".join(passage[:49]), "en", "a", 0)]
    for group in (100, 100_000):
        out = substring.remove_repeats(cases.frame(spark, rows).select("doc_id", "text"), group)
        assert cases.rows_of(out.select("doc_id", "__n_words", "__n_removed", "__sha")) == Counter(cases.remove_repeats(rows))


def test_substring_joins_do_not_change_with_size(spark, monkeypatch):
    """Texts are moved once a join however small the other side is; the join that finds a hot passage is over plain exchanges."""
    plans = {}

    def kept(df, name, store=substring.stored):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return store(df, name)

    monkeypatch.setattr(substring, "stored", kept)
    out = substring.remove_repeats(cases.frame(spark, ROWS).select("doc_id", "text"), 0)
    plans["out"] = out._jdf.queryExecution().executedPlan().toString()
    for name in ("runs", "out"):
        assert plans[name].count("SortMergeJoin") == 1 and "Broadcast" not in plans[name]
    assert plans["out"].count("Scan ExistingRDD") == 1                   # texts are read once, not once for those with spans and once for the others
    assert "nodes" in plans                                               # a table: an aggregate under the join would keep Spark from splitting a hot passage
    assert cases.rows_of(out.select("doc_id", "__n_words", "__n_removed", "__sha")) == Counter(cases.remove_repeats(ROWS))


def test_substring_dedup_keeps_columns(spark):
    df = cases.frame(spark, ROWS)
    out = substring.dedup(df)
    assert out.columns == df.columns and out.count() == len(ROWS)
    assert out.select(*cases.CLASHING).distinct().collect() == df.select(*cases.CLASHING).distinct().collect()
    untouched = Counter((r[0], r[1]) for r, w in zip(ROWS, cases.remove_repeats(ROWS)) if not w[2])
    assert untouched - cases.rows_of(out.select("doc_id", "text")) == Counter()


def test_substring_group_that_crosses_batches():
    """A prefix group split over Arrow batches is still one group."""
    import pyarrow as pa

    rows = [(7, i, i, 0, [1, 2, 3]) for i in range(6)] + [(8, 1, 1, 4, [9])]
    cols = list(zip(*rows))
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 4 + [pa.list_(pa.int64())])],
                                       names=["anchor", "id", "h", "place", "windows"])
    whole = [b.to_pylist() for b in substring._group_spans(iter([batch]))]
    parts = [b.to_pylist() for b in substring._group_spans(batch.slice(i, 2) for i in range(0, 7, 2))]
    assert sum(whole, []) == sum(parts, []) and len(sum(whole, [])) == 5


def test_empty_tables(spark):
    none = cases.frame(spark, [])
    items = spark.createDataFrame([], "item_id long, text string")
    for df in (linededup.report(none), linededup.dedup(none), simhash.report(none), simhash.keep_first(none),
               substring.report(none), decontam.report(none, items), decontam.keep_clean(none, items),
               decontam.report(none, spark.createDataFrame([(1, "a b")], "item_id long, text string"))):
        assert df.count() == 0
    assert decontam.report(cases.frame(spark, ROWS), items).where("contaminated or n_items > 0 or n_hit > 0").count() == 0
