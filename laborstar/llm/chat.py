"""Chat formatting in budgeted windows of whole turns.

A turn is written as ``<|turn|>role<|text|>text<|end|>`` and a line break. Inside roles and texts every
backslash is doubled, and a backslash is put after the first character of every control string
(``CONTROL``), so a text can never open or close a turn, and reading back is one replacement.

A conversation longer than ``BUDGET`` tokens is cut into windows of consecutive turns by prefix sums:
with S = half of what the budget leaves beside the system turn and the history, a turn belongs to the
window that its tokens' running sum falls in (steps of S), so turns of at most S tokens never exceed the
budget together; a longer turn has a window of its own and is never cut. Every later window repeats the
system turn and up to ``HISTORY_TURNS`` turns (``HISTORY_TOKENS`` tokens) before it. The loss mask of a
window covers the assistant texts that are new in it, so a repeated target is learned once.

One sort per conversation gives all sums and the turns before; a window's turns are gathered within
the budget. The query's digests need all turns of a conversation in one row; the windows do not.

Edge cases: null role and null text are empty; turns are ordered by turn (null first), then role and text, so
repeated rows and ties have one order; a null conv_id is a conversation of its own; only a first turn
with role ``system`` is the system turn; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from laborstar.llm._columns import rows_of

# The template, and the strings that texts must not contain unescaped.
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>\n"
CONTROL = ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
BUDGET = 512
HISTORY_TURNS = 2
HISTORY_TOKENS = 128
PROBE = "</s>[INST] ok [/INST]"


def escape(c: Column) -> Column:
    c = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    for s in CONTROL:
        c = F.replace(c, F.lit(s), F.lit(s[0] + "\\" + s[1:]))
    return c


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


def tokens(c: Column) -> Column:
    """Words and single signs: the unit of the budget."""
    return F.regexp_count(c, F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]"))


def windows(conversations: DataFrame, budget: int = BUDGET, history_turns: int = HISTORY_TURNS,
            history_tokens: int = HISTORY_TOKENS) -> DataFrame:
    """conv_id, window (from 1), text, n_repeated (turns at its start), loss (start, length in code points)."""
    turns = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    head = F.concat(F.lit(TURN), escape(F.col("role")), F.lit(TEXT))
    turns = turns.withColumns({"head": F.char_length(head), "body": F.char_length(escape(F.col("text"))),
                               "f": F.concat(head, escape(F.col("text")), F.lit(END))}).withColumn("n", tokens(F.col("f")))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    turns = turns.withColumn("pos", F.row_number().over(order))
    first_system = (F.col("pos") == 1) & (F.col("role") == "system")
    turns = turns.withColumns({
        "system": F.first(F.when(first_system, F.col("f"))).over(upto),
        "step": F.greatest(F.lit(1), F.floor((budget - history_tokens - F.first(F.when(first_system, F.col("n")).otherwise(0)).over(upto)) / 2)),
        "counted": F.when(first_system, 0).otherwise(F.col("n")), "chars": F.sum(F.char_length("f")).over(upto) - F.char_length("f")})
    big = (F.col("counted") > F.col("step")).cast("int")
    turns = turns.withColumn("part", F.struct((F.sum(big).over(upto) * 2 - big).alias("a"),
                                              F.floor((F.sum("counted").over(upto) - F.col("counted")) / F.col("step")).alias("b")))
    body = F.col("system").isNull() | (F.col("pos") > 2)                     # the first turn after a system turn stays with it
    new = (F.col("pos") == 1) | (body & (F.col("part") != F.lag("part").over(order)))
    turns = turns.withColumn("new", new).withColumn("window", F.sum(F.col("new").cast("int")).over(upto))
    before, room = [], F.lit(0)
    for k in range(1, history_turns + 1):
        room = room + F.lag("n", k).over(order)
        fits = (room <= history_tokens) & ~(F.col("system").isNotNull() & (F.col("pos") - k == 1))
        before.insert(0, F.when(fits, F.lag("f", k).over(order)))
    repeated = F.when(F.col("new"), F.array_compact(F.array(F.when(F.col("pos") > 1, F.col("system")), *before)))
    turns = turns.withColumn("repeated", repeated)
    grouped = turns.groupBy("conv_id", "window").agg(
        F.array_sort(F.collect_list(F.struct("pos", "chars", "head", "body", "f", (F.col("role") == "assistant").alias("target")))).alias("t"),
        F.first("repeated", ignorenulls=True).alias("repeated"))
    again = F.array_join("repeated", "")
    start = F.char_length(again)
    loss = F.transform(F.filter("t", lambda t: t["target"]), lambda t: F.struct(
        (start + t["chars"] - F.get("t", F.lit(0))["chars"] + t["head"]).cast("int").alias("start"), t["body"].alias("length")))
    return grouped.select("conv_id", "window", F.concat(again, F.array_join(F.transform("t", lambda t: t["f"]), "")).alias("text"),
                          F.size("repeated").alias("n_repeated"), loss.alias("loss"))


def read_turns(formatted: DataFrame) -> DataFrame:
    """Windows with ``turns``: the new turns (role, text) read back from the text of the window."""
    ended = F.split("text", r"<\|end\|>\n", -1)
    fresh = F.slice(ended, F.col("n_repeated") + 1, F.size(ended) - 1 - F.col("n_repeated"))

    def parse(t: Column) -> Column:
        parts = F.split(F.substring(t, len(TURN) + 1, 1 << 30), r"<\|text\|>", 2)
        return F.struct(unescape(F.get(parts, F.lit(0))).alias("role"), unescape(F.get(parts, F.lit(1))).alias("text"))

    return formatted.withColumn("turns", F.transform(fresh, parse))


def read_loss(formatted: DataFrame) -> DataFrame:
    """Windows with ``targets``: the unescaped texts under the loss mask."""
    return formatted.withColumn("targets", F.transform("loss", lambda s: unescape(
        F.substring(F.col("text"), s["start"] + 1, s["length"]))))


def report(conversations: DataFrame) -> DataFrame:
    """Per conversation: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    back = read_loss(read_turns(windows(conversations)))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    rows = back.select("conv_id", "window", F.size("turns").alias("n"), said.alias("said"), F.array_join("targets", "").alias("loss"), F.char_length("text").alias("chars"))
    whole = rows.groupBy("conv_id").agg(F.sum("n").alias("n_turns"), F.array_sort(F.collect_list(F.struct("window", "said", "loss"))).alias("w"),
                                        F.sum("chars").alias("formatted_chars"))
    text = {name: F.array_join(F.col(f"w.{name}"), "") for name in ("said", "loss")}
    return whole.select("conv_id", F.col("n_turns").cast("long").alias("n_turns"), F.sha2(text["said"], 256).alias("turns_sha256"),
                        F.char_length(text["loss"]).cast("long").alias("loss_chars"), F.sha2(text["loss"], 256).alias("loss_sha256"),
                        F.col("formatted_chars").cast("long").alias("formatted_chars"))


def with_probe(conversations: DataFrame) -> DataFrame:
    """The table plus conversation -7, whose texts are control strings of another template."""
    probe = rows_of(conversations.sparkSession, [(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)],
                    "conv_id long, turn long, role string, text string")
    return conversations.select("conv_id", "turn", "role", "text").unionByName(probe)
