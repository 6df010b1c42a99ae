r"""Chat conversations as training windows of a token budget.

Each turn is ``<turn role>``, its text and ``</turn>``, on lines of their own. Texts escape ``\`` as
``\b`` and ``<`` as ``\l``, so a mark in a text is no mark, and undoing ``\l`` before
``\b`` gives the text back. Roles escape line ends and ``>`` as well.

Windows come from prefix sums of turn tokens: with room for R tokens of new turns, a turn
that ends inside the k-th stretch of R tokens belongs to window (k, 0), and one that crosses
into the next stretch is window (k, 1) by itself. So turns are whole, every turn is new in
exactly one window, and new turns exceed R only if one turn does. Every window begins with
the conversation's first system turn, if that stands before it, and repeats the turns right
before its new ones that fit in ``HISTORY`` tokens together, by a range of the prefix sums. The
loss mask covers the texts of assistant turns that are new in the window; what is repeated is masked.

Turns are ordered by turn, role and text, nulls first; repeated rows are turns of their own. Null texts
and roles are empty. A null ``conv_id`` is one conversation. An empty table gives no rows.
Only the four columns are read. Tokens are words and marks, and ``MARKS`` for the turn itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

ROOM = 512
HISTORY = 128
TOKEN = r"[0-9A-Za-z_]+|[^0-9A-Za-z_\x20\x09-\x0D]"
MARKS = 4


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def escaped_role(role: Column) -> Column:
    return F.replace(F.replace(escaped(role), F.lit("\n"), F.lit("\\n")), F.lit(">"), F.lit("\\g"))


def unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(F.replace(role, F.lit("\\g"), F.lit(">")), F.lit("\\n"), F.lit("\n")))


def turns(rows: DataFrame, tokens: Column | None = None) -> DataFrame:
    """``conv_id, n, role, text, tokens, upto``: numbered turns with prefix sums of tokens."""
    clean = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("tokens", ((F.regexp_count("text", F.lit(TOKEN)) if tokens is None else tokens) + MARKS).cast("long"))
    order = W.partitionBy("conv_id").orderBy("turn", "role", "text")
    return clean.select(
        "conv_id", F.row_number().over(order).alias("n"), "role", "text", "tokens",
        F.sum("tokens").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)).alias("upto"),
    )


def windows(rows: DataFrame, room: int = ROOM, history: int = HISTORY, tokens: Column | None = None) -> DataFrame:
    """``conv_id, stretch, alone, text, turns``: formatted windows in order of stretch and alone.

    ``turns`` holds for each turn in the text its number, whether it is new, and where its escaped
    text begins and ends in code points; with ``is_loss`` that span is under the loss mask.
    """
    numbered = turns(rows, tokens).withColumn("before", F.col("upto") - F.col("tokens"))
    stretch = F.floor(F.col("before") / room).cast("long")
    order = W.partitionBy("conv_id").orderBy("before")
    placed = numbered.select(
        "conv_id", "n", "role", "text", stretch.alias("stretch"), (F.col("upto") > (stretch + 1) * room).cast("int").alias("alone"),
        F.min("n").over(order.rangeBetween(-history, W.currentRow)).alias("since"),
        F.min(F.when(F.col("role") == "system", F.col("n"))).over(order.rangeBetween(W.unboundedPreceding, W.currentRow)).alias("system"),
    )
    key = ["conv_id", "stretch", "alone"]
    new = placed.select(*key, "n", F.lit(True).alias("is_new"), "role", "text")
    starts = placed.groupBy(*key).agg(F.min_by(F.struct("n", "since", "system"), F.col("n")).alias("s"))
    past = F.when(F.col("s.since") < F.col("s.n"), F.sequence("s.since", F.col("s.n") - 1)).otherwise(F.array().cast("array<int>"))
    head = F.when(F.col("s.system") < F.least("s.since", "s.n"), F.array("s.system")).otherwise(F.array().cast("array<int>"))
    again = starts.select(*key, F.explode(F.concat(head, past)).alias("n"))
    same = F.col("a.conv_id").eqNullSafe(F.col("b.conv_id")) & (F.col("a.n") == F.col("b.n"))
    again = again.alias("a").join(placed.alias("b"), same).select("a.conv_id", "a.stretch", "a.alone", "a.n", F.lit(False), "b.role", "b.text")
    made = new.union(again).groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("n", "is_new", "role", "text"))).alias("parts"))
    marked = F.transform("parts", lambda t: F.struct(
        t["n"].alias("n"), t["is_new"].alias("is_new"), (t["is_new"] & (t["role"] == "assistant")).alias("is_loss"),
        F.concat(F.lit("<turn "), escaped_role(t["role"]), F.lit(">\n")).alias("open"), escaped(t["text"]).alias("text"),
    ))
    made = made.select(*key, marked.alias("marked"))
    close = "\n</turn>\n"
    length = F.transform("marked", lambda t: F.char_length(t["open"]) + F.char_length(t["text"]) + len(close))
    made = made.withColumn("length", length)
    upto = lambda i: F.aggregate(F.slice("length", 1, i), F.lit(0), lambda a, x: a + x)
    spans = F.transform("marked", lambda t, i: F.struct(
        t["n"].alias("n"), t["is_new"].alias("is_new"), t["is_loss"].alias("is_loss"),
        (upto(i) + F.char_length(t["open"])).alias("start"), (upto(i) + F.char_length(t["open"]) + F.char_length(t["text"])).alias("end"),
    ))
    text = F.array_join(F.transform("marked", lambda t: F.concat(t["open"], t["text"], F.lit(close))), "")
    return made.select(*key, text.alias("text"), spans.alias("turns"))


def read_back(formatted: DataFrame) -> DataFrame:
    """One row per conversation from its windows: digests of turns and of text under the loss mask."""
    span = F.lit(r"<turn ([^>]*)>\n([^<]*)\n</turn>\n")
    parsed = formatted.select(
        "conv_id", F.char_length("text").alias("chars"),
        F.arrays_zip(
            "turns", F.regexp_extract_all("text", span, 1).alias("roles"), F.regexp_extract_all("text", span, 2).alias("texts")
        ).alias("t"), F.col("text").alias("whole"),
    )
    new = F.filter("t", lambda t: t["turns"]["is_new"])
    rows = F.transform(new, lambda t: F.struct(
        t["turns"]["n"].alias("n"),
        F.concat(unescaped_role(t["roles"]), F.lit("\n"), unescaped(t["texts"]), F.lit("\n")).alias("turn"),
        F.when(t["turns"]["is_loss"], unescaped(F.substr("whole", t["turns"]["start"] + 1, t["turns"]["end"] - t["turns"]["start"]))).alias("loss"),
    ))
    found = parsed.select("conv_id", "chars", rows.alias("rows")).groupBy("conv_id").agg(
        F.sort_array(F.flatten(F.collect_list("rows"))).alias("rows"), F.sum("chars").alias("formatted_chars")
    )
    loss = F.array_join(F.transform("rows", lambda r: r["loss"]), "")
    return found.select(
        "conv_id", F.size("rows").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("rows", lambda r: r["turn"]), ""), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.col("formatted_chars").cast("long"),
    )
