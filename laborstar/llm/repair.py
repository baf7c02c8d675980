"""Conversation structure repair: the cheapest edits that make a conversation's roles a legal sequence.

Legal are ``(s?(ua)+)?``: nothing, or an optional system turn and pairs of user and assistant. A row may be kept (K, cost 0), given the
other role (R, 1) or deleted (D, 2; blank rows and rows seen before have to be); an empty user or assistant turn may be inserted (I, 5);
a truncated row that is not deleted costs 5 more. Of all cheapest edits the ASCII-least string of initials is taken.

The state of a row of edits is what the roles so far allow next (``START``, after system, after user, after assistant), so the least
cost of what is still to come is a vector of four numbers per row.

* Order. Rows are sorted by conversation, turn (null first), role and text over the whole cluster (range partitions), so a
  conversation of any size lies in consecutive tasks; its rows inside one task are a *run*.
* Backward. Every run is reduced to the least costs from each state before it to each state after it; these 4 x 4 matrices are combined per
  conversation (as many as it has runs, at most one per task), which gives the cost vector behind every run.
* Forward. A run of m rows goes backward from that vector and keeps the vectors of every sqrt(m)-th row only; then it walks forward,
  recomputing the vectors of one block at a time, and writes the ASCII-least edits for each state it may be entered in. The
  states at the borders follow from the first run on.
* Rows and edits meet by run, so a conversation with a third of all rows is repaired by many tasks.

``report``, whose digests need a conversation's whole text in order, passes the repaired rows of a conversation through one task, row by
row; it holds one row and a hash state.

Edge cases: null roles and texts are one space; rows of equal turn are ordered by role and text, so identical rows are interchangeable; a
null conv_id is a conversation; the first of equal rows counts, the others are duplicates; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laborstar.llm._columns import BLANKS
from laborstar.llm._store import stored

# Costs, states and the roles that follow them.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}          # the turn that a reroled or inserted row becomes
ROLE = {USER: "user", ASSISTANT: "assistant"}
STATE = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
LEGAL = ("su", "ua", "au")
END = (0, 2 * INSERT, INSERT, 0)            # least costs behind the last row: pairs are completed
FAR = 1 << 40
FAULTS = ("", "blank", "duplicate", "truncated")


def damaged(conversations: DataFrame) -> DataFrame:
    """The damage of the query's contract, by the hash of conversation and turn: conv_id, turn, role, text."""
    space = F.lit(" ")
    rows = conversations.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = rows.withColumn("case", F.crc32(name.cast("binary")) % 20).where("case <> 0")
    text = F.when(F.col("case") == 1, "").when(F.col("case") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("case") == 4, "user").otherwise(F.col("role"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"),
                       F.explode(F.array_repeat(F.lit(1), F.when(F.col("case") == 3, 2).otherwise(1)))).drop("col")


def ordered(rows: DataFrame) -> DataFrame:
    """The rows (stored) with ``seq``, ascending in the order of conversation, turn, role and text, and ``part``, the task that holds a row."""
    space, keys = F.lit(" "), ["conv_id", "turn", "role", "text"]
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
    # Identical rows are told apart, or they would all lie in one range.
    rows = rows.withColumn("tie", F.monotonically_increasing_id())
    sorted_rows = rows.repartitionByRange(*keys, "tie").sortWithinPartitions(*keys, "tie").drop("tie")
    return stored(sorted_rows.withColumn("seq", F.monotonically_increasing_id())
                  .withColumn("part", F.shiftright("seq", 33).cast("int")), "turns")


def judged(turns: DataFrame) -> DataFrame:
    """conv_id, turn, part, seq, initial and fault (an index of FAULTS) of every row."""
    last = F.right(F.rtrim(F.col("text"), F.lit(BLANKS)), F.lit(1))
    rows = turns.select("conv_id", "turn", "part", "seq", F.substring("role", 1, 1).alias("initial"), last.alias("last"),
                        F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)).alias("same"))
    first = rows.where("last <> ''").groupBy("conv_id", "same").agg(F.min("seq").alias("seq")).select("seq", F.lit(True).alias("first"))
    fault = (F.when(F.col("last") == "", 1).when(F.col("first").isNull(), 2).when(~F.col("last").isin(".", "!", "?"), 3).otherwise(0))
    return rows.join(first, "seq", "left").select("conv_id", "turn", "part", "seq", "initial", fault.cast("int").alias("fault"))


# ---- one row of the dynamic programme --------------------------------------------------------------------------------------------

def code_of(initial: str, fault: int) -> str:
    """One letter for what decides a row's edits: system, user, assistant or other; free, truncated or to be deleted."""
    return chr(97 + STATE.get(initial, 4) * 3 - 3 + (0, 2, 2, 1)[fault])


def _moves(code: str) -> list[list[tuple[str, int, int]]]:
    """For each state: (initial, cost, next state) of the edits of a row that use it up, in ASCII order."""
    kind, fault = divmod(ord(code) - 97, 3)
    fits = {0: {START: SYSTEM}, 1: {START: USER, SYSTEM: USER, ASSISTANT: USER}, 2: {USER: ASSISTANT}}.get(kind, {})
    more = TRUNCATED if fault == 1 else 0
    out = []
    for state in range(4):
        moves = [("D", DELETE, state)]
        if fault != 2:
            moves += [("K", more, fits[state])] if state in fits else []
            moves += [("R", more + REROLE, NEXT[state])]
        out.append(moves)
    return out


MOVES = {chr(97 + i): _moves(chr(97 + i)) for i in range(12)}


def before(code: str, after: tuple) -> tuple:
    """Least costs in front of a row, in each state, from those behind it."""
    v = [min(cost + after[to] for _, cost, to in moves) for moves in MOVES[code]]
    u, a = v[USER], v[ASSISTANT]
    v[USER], v[ASSISTANT] = min(u, INSERT + a), min(a, INSERT + u)
    v[START], v[SYSTEM] = min(v[START], INSERT + v[USER]), min(v[SYSTEM], INSERT + v[USER])
    return tuple(v)


def matrix(codes: str) -> list[int]:
    """Least costs from each state before a run to each state right behind its last row, row by row."""
    columns = []
    for to in range(4):
        v = tuple(0 if s == to else FAR for s in range(4))
        for c in reversed(codes):
            v = before(c, v)
        columns.append(v)
    return [min(columns[to][s], FAR) for s in range(4) for to in range(4)]


def walk(codes: str, behind: tuple, last: bool) -> tuple[list[str], list[int], tuple]:
    """For each entering state the ASCII-least cheapest edits of a run and the state behind it; and the costs in front of it.

    The vectors of every sqrt(m)-th row are kept, those between are computed again block by block."""
    size = max(isqrt(len(codes)), 1)
    kept, v = {}, behind
    for i in range(len(codes) - 1, -1, -1):
        if (i + 1) % size == 0 or i == len(codes) - 1:
            kept[i // size] = v                           # behind the last row of the block
        v = before(codes[i], v)
    front, state, edits = v, list(range(4)), [[] for _ in range(4)]
    for block in range(-(-len(codes) // size)):
        lo, hi = block * size, min((block + 1) * size, len(codes))
        costs = [kept[block]]
        for i in range(hi - 1, lo - 1, -1):
            costs.append(before(codes[i], costs[-1]))
        for i in range(lo, hi):
            here, after = costs[hi - i], costs[hi - i - 1]
            for k in range(4):
                while True:
                    s = state[k]
                    name, cost, to = MOVES[codes[i]][s][0]
                    if cost + after[to] == here[s]:
                        break
                    if INSERT + here[NEXT[s]] == here[s]:
                        edits[k].append("I")
                        state[k] = NEXT[s]
                        continue
                    name, cost, to = next(m for m in MOVES[codes[i]][s][1:] if m[1] + after[m[2]] == here[s])
                    break
                edits[k].append(name)
                state[k] = to
    for k in range(4):
        while last and state[k] in (SYSTEM, USER):
            edits[k].append("I")
            state[k] = NEXT[state[k]]
    return ["".join(e) for e in edits], state, front


# ---- over the cluster ------------------------------------------------------------------------------------------------------------

RUN = ("conv_id long, part int, run long, codes string, costs array<long>, blank long, duplicate long, truncated long, illegal long, "
       "first string, last string")


def _tasks(df: DataFrame) -> int:
    """Rows of a few bytes that take long are dealt out by number, or adaptive execution would put them into one task."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def runs(rows: DataFrame) -> DataFrame:
    """One row per conversation and task of the sorted rows (stored). ``run`` is the first seq; costs are null for a run with others
    of its task on both sides, which is a whole conversation."""
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def closed(edge: bool) -> pa.RecordBatch:
            pairs = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))
            codes = "".join(map(code_of, initials, faults))
            row = {"conv_id": held[1], "part": held[0], "run": start, "codes": codes, "costs": matrix(codes) if edge else None,
                   "blank": faults.count(1), "duplicate": faults.count(2), "truncated": faults.count(3), "illegal": pairs, "first": initials[0], "last": initials[-1]}
            return pa.RecordBatch.from_pylist([row], schema)

        schema = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("run", pa.int64()), ("codes", pa.string()), ("costs", pa.list_(pa.int64())),
                            *[(c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal")], ("first", pa.string()), ("last", pa.string())])
        held, start, initials, faults, leading = None, 0, [], [], True
        for batch in batches:
            for conv, part, seq, initial, fault in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "part", "seq", "initial", "fault")]):
                if (part, conv) != held:
                    if held is not None:
                        yield closed(leading or part != held[0])
                    leading = held is None or part != held[0]
                    held, start, initials, faults = (part, conv), seq, [], []
                initials.append(initial)
                faults.append(fault)
        if held is not None:
            yield closed(True)

    dealt = rows.repartition(_tasks(rows), "part").sortWithinPartitions("part", "seq").select("conv_id", "part", "seq", "initial", "fault")
    return stored(dealt.mapInArrow(gather, RUN), "runs")


def _vector(values) -> Column:
    return F.array(*[F.lit(x).cast("long") for x in values])


def borders(found: DataFrame) -> DataFrame:
    """Per run: ``behind``, the least costs behind it, and ``final``, whether it is its conversation's last. One array entry per run of a conversation."""
    def through(acc: Column, x: Column) -> Column:
        v = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda s: F.array_min(F.transform(
            F.sequence(F.lit(0), F.lit(3)), lambda t: F.get(x["costs"], s * 4 + t) + F.get(acc["v"], t))))
        return F.struct(v.alias("v"), F.concat(acc["out"], F.array(F.struct(x["run"].alias("run"), acc["v"].alias("behind"), (F.size(acc["out"]) == 0).alias("final")))).alias("out"))

    none = F.array().cast("array<struct<run:bigint,behind:array<bigint>,final:boolean>>")
    lists = found.groupBy("conv_id").agg(F.reverse(F.array_sort(F.collect_list(F.struct("run", "costs")))).alias("r"))
    return lists.select(F.inline(F.aggregate("r", F.struct(_vector(END).alias("v"), none.alias("out")), through, lambda acc: acc["out"])))


def walks(found: DataFrame) -> DataFrame:
    """Per run: the edits and the state behind it for each entering state, and the costs in front of it (stored)."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [walk(c, tuple(b), f) for c, b, f in zip(*[batch.column(n).to_pylist() for n in ("codes", "behind", "final")])]
            edits, states, front = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("part"), batch.column("run"), pa.array(edits, pa.list_(pa.string())),
                                              pa.array(states, pa.list_(pa.int64())), pa.array([f[START] for f in front], pa.int64())],
                                             names=["conv_id", "part", "run", "edits", "states", "cost"])

    rows = found.select("conv_id", "part", "run", "codes").join(borders(found), "run").repartition(_tasks(found), "run")
    return stored(rows.mapInArrow(step, "conv_id long, part int, run long, edits array<string>, states array<long>, cost long"), "walks")


def audits(walked: DataFrame) -> DataFrame:
    """Per run: the state it is entered in and its edits."""
    def onward(acc: Column, x: Column) -> Column:
        return F.struct(F.get(x["states"], acc["s"].cast("int")).alias("s"), F.concat(acc["out"], F.array(F.struct(x["run"].alias("run"), acc["s"].alias("state")))).alias("out"))

    none = F.array().cast("array<struct<run:bigint,state:bigint>>")
    lists = walked.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("run", "states"))).alias("r"))
    entered = lists.select(F.inline(F.aggregate("r", F.struct(F.lit(START).cast("long").alias("s"), none.alias("out")), onward, lambda acc: acc["out"])))
    return walked.join(entered, "run").select("conv_id", "part", "run", "state", F.get("edits", F.col("state").cast("int")).alias("audit"), "cost")


def rebuilt(turns: DataFrame, chosen: DataFrame) -> DataFrame:
    """The repaired rows: conv_id, run, nth (order inside the run), edit, role, text."""
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, at, left, state, run, nth = "", 0, 0, START, None, 0
        for batch in batches:
            out = []
            for conv, new, edits, entered, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "run", "audit", "state", "role", "text")]):
                if edits is not None:                                    # the head of a run
                    audit, at, left, state, run, nth = edits, 0, len(edits) - edits.count("I"), entered, new, 0
                    continue
                left -= 1
                stop = len(audit) if not left else None                  # inserts behind the last row of all
                used = False
                while at < len(audit) and (not used or stop):
                    edit = audit[at]
                    at += 1
                    used = used or edit != "I"
                    if edit == "D":
                        continue
                    state = STATE[role[0]] if edit == "K" else NEXT[state]
                    out.append((conv, run, nth, edit, role if edit == "K" else ROLE[state], "" if edit == "I" else text))
                    nth += 1
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], f.type) for k, f in enumerate(schema)], schema=schema)

    schema = pa.schema([("conv_id", pa.int64()), ("run", pa.int64()), ("nth", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])
    heads = chosen.select("conv_id", "part", F.lit(-1).cast("long").alias("seq"), "run", "audit", "state")
    rows = turns.select("conv_id", "part", "seq", "role", "text").unionByName(heads, allowMissingColumns=True)
    dealt = rows.repartition("part", "conv_id").sortWithinPartitions("part", "conv_id", "seq")
    return dealt.select("conv_id", "run", "audit", "state", "role", "text").mapInArrow(apply, "conv_id long, run long, nth long, edit string, role string, text string")


class Repair:
    """The tables of one repair: turns, runs, audits (per run) and the repaired rows."""

    def __init__(self, rows: DataFrame):
        self.turns = ordered(rows)
        self.judged = stored(judged(self.turns), "judged")
        self.runs = runs(self.judged)
        self.audits = stored(audits(walks(self.runs)), "audits")

    @property
    def rows(self) -> DataFrame:
        return rebuilt(self.turns, self.audits)

    def figures(self) -> DataFrame:
        """Per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit."""
        span = F.max("turn").cast("decimal(38,0)") - F.min("turn") + 1 - F.count_distinct("turn")
        gaps = self.judged.groupBy("conv_id").agg(F.coalesce(span, F.lit(0)).try_cast("long").alias("gaps"))
        pairs = F.zip_with(F.slice("r", 1, F.size("r") - 1), F.slice("r", 2, F.size("r")), lambda a, b: F.concat(a["last"], b["first"]))
        between = F.size(F.filter(F.when(F.size("r") > 1, pairs).otherwise(F.array().cast("array<string>")), lambda p: ~p.isin(*LEGAL)))
        whole = self.runs.groupBy("conv_id").agg(
            *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")], F.array_sort(F.collect_list(F.struct("run", "first", "last"))).alias("r"))
        whole = whole.withColumn("illegal", F.col("illegal") + between).drop("r")
        audit = self.audits.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("run", "audit", "cost"))).alias("a"))
        audit = audit.select("conv_id", F.get("a", F.lit(0))["cost"].alias("cost"), F.array_join(F.transform("a", lambda x: x["audit"]), "").alias("audit"))
        found = whole.withColumnRenamed("conv_id", "c")
        for other in (gaps, audit):
            found = found.join(other, F.col("c").eqNullSafe(other["conv_id"])).drop("conv_id")
        return found.withColumnRenamed("c", "conv_id")


def digests(rows: DataFrame) -> DataFrame:
    """conv_id and the SHA-256 of the repaired ``role:text``, newline-joined: one conversation's rows in order, one at a time."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, state, done = None, None, []
        for batch in batches:
            for conv, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "role", "text")]):
                if state is None or conv != held:
                    done += [(held, state.hexdigest())] if state is not None else []
                    held, state = conv, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(f"{role}:{text}".encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in done], pa.int64()), pa.array([h for _, h in done])], names=["conv_id", "sha"])
                done = []
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([held], pa.int64()), pa.array([state.hexdigest()])], names=["conv_id", "sha"])

    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "run", "nth")
    return dealt.select("conv_id", "role", "text").mapInArrow(hashed, "conv_id long, sha string")


def report(conversations: DataFrame) -> DataFrame:
    """Per original conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    found = Repair(damaged(conversations))
    every = conversations.select("conv_id").distinct().withColumnRenamed("conv_id", "c")
    for other in (found.figures(), digests(found.rows)):
        every = every.join(other, F.col("c").eqNullSafe(other["conv_id"]), "left").drop("conv_id")
    numbers = [F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.select(F.col("c").alias("conv_id"), *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("sha", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
