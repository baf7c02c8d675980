"""Small tables with every awkward case, and brute-force versions of the operators."""
from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import xxhash

# Columns that operators use inside; an input may have columns of the same names.
CLASHING = ("id", "h", "key", "n", "pos", "score", "part", "guest", "next", "own", "rank", "bucket", "words", "lines",
            "gone", "spans", "term", "start", "size", "fp", "root", "word", "block", "window", "f", "y", "order", "one")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SPACES = re.compile(r"[^\x20\x09-\x0D]+")
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def prose(rng: random.Random, n: int) -> str:
    vowels, rest = "aeiouéü", "bcdfglmnprstv"
    words = ["".join(rng.choice(rest) + rng.choice(vowels) for _ in range(rng.randint(1, 4))) for _ in range(n)]
    return " ".join(w.capitalize() + "." if rng.random() < 0.1 else w for w in words)


def corpus(seed: int = 1, n: int = 60) -> list[tuple]:
    """Prose, exact and near copies, shared passages and lines, and the awkward rows."""
    rng = random.Random(seed)
    passage, line = prose(rng, 70), "Licensed under the Licence, version 2.0"
    rows: list[list] = []
    for i in range(n):
        text = prose(rng, rng.randint(5, 160))
        if i % 5 == 1:
            text = f"{text}\n  {line.upper() if i % 2 else line}\t\n{prose(rng, 10)}"
        if i % 6 == 2:
            words = passage.split()
            text = f"{text} {' '.join(words[rng.randint(0, 12):])} {prose(rng, 5)}"
        rows.append([i * 3 + 1, text, rng.choice(["en", "fr", None]), rng.choice(["b", "a", "é", None])])
    for i in (3, 3, 10, 11):
        rows.append([500 + len(rows), rows[i][1], "en", "a"])                              # exact copies
    for i in (4, 20):
        rows.append([600 + len(rows), rows[i % len(rows)][1] + " " + prose(rng, 1), "fr", "b"])          # near copies
    rows += [[700, None, "en", "a"], [701, "", None, None], [702, " \t\n ", "en", "b"], [703, "!!! 12 ...", "fr", "a"],
             [704, "é ß Ünï x 漢字 \U0001f600", "fr", "é"], [705, "one", "en", "b"], [None, "a null id " + passage, "en", "a"],
             [None, None, None, None], [706, prose(rng, 9_000), "en", "b"], [707, "same " * 400, "fr", "a"],
             [708, "\n".join([line] * 5 + ["short"] * 3), "en", "a"]]
    rows += [rows[0][:], [1, "another text of the first id " + line, "en", "a"]]                 # repeated row, repeated id
    return [(*r, len(r[1]) if r[1] is not None else None) for r in rows]


def frame(spark, rows, schema: str = SCHEMA, clashing: bool = True):
    """The rows in several partitions, with extra columns of clashing names."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, schema).repartition(5) if rows else spark.createDataFrame([], schema)
    return df.withColumns({c: F.lit(i).cast("string") for i, c in enumerate(CLASHING)}) if clashing else df


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def rows_of(df) -> Counter:
    return Counter(tuple(r) for r in df.collect())


# ---- brute force ------------------------------------------------------------------------------

def dedup_lines(rows, min_chars=20, min_docs=3):
    key = lambda s: s.strip(" \t\n\x0b\f\r").translate(UPPER)
    holders = defaultdict(list)
    for r in rows:
        for k in {key(s) for s in (r[1] or "").split("\n")}:
            if len(k) >= min_chars and r[0] not in holders[k]:
                holders[k].append(r[0])                       # a document is an id
    small = lambda d: (d is not None, d or 0)  # noqa: E731  a null id is the smallest
    out = []
    for r in rows:
        lines = (r[1] or "").split("\n")
        kept = [s for s in lines if not (len(h := holders.get(key(s), [])) >= min_docs
                                         and max(h, key=small) != r[0])]
        out.append((r[0], len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def fingerprint(text, shingle=3):
    w = [x.decode() for x in (text or "").encode().lower().split()]
    if not w:
        return 0
    grams = [" ".join(w[i:i + shingle]) for i in range(max(1, len(w) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fps, bits=2):
    """Group number of every fingerprint in the list."""
    group = list(range(len(fps)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                group[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def decontaminate(rows, items):
    words = lambda t: WORDS.findall((t or "").translate(UPPER))
    wins = defaultdict(set)
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            wins[tuple(w[i:i + 10])].add(item)
    sizes = {len(w) for w in wins}
    out = []
    for r in rows:
        w, hit, found = words(r[1]), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in wins:
                    hit |= set(range(i, i + n))
                    found |= wins[tuple(w[i:i + n])]
        ids = sorted(str(x) for x in found if x is not None)
        out.append((r[0], len(w), len(hit), len(ids), sha(",".join(ids)), bool(hit)))
    return out


def remove_repeats(rows, size=50):
    rank = lambda d: float("inf") if d is None else d
    first = {}
    split = [SPACES.findall(r[1] or "") for r in rows]
    for r, w in zip(rows, split):
        for i in range(len(w) - size + 1):
            k = tuple(w[i:i + size])
            first[k] = min(first.get(k, float("inf")), rank(r[0]))
    out = []
    for r, w in zip(rows, split):
        gone = set()
        for i in range(len(w) - size + 1):
            if rank(r[0]) > first[tuple(w[i:i + size])]:
                gone |= set(range(i, i + size))
        out.append((r[0], len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out
