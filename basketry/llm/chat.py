"""Prefix-target expansion of conversations (DataFrame functions only).

Every assistant turn becomes one example: all turns before it as context, its own text the only
trainable part. A turn is written ``[INST]role[/INST]text</s>`` and an example starts with ``<s>``.
A control string inside a role or text gets a backslash after its first character, before any
backslash that already stands there; reading removes one again, so that every text is recovered.

Defined results: NULL role and NULL text are empty; turns are ordered by (turn, role, text), a NULL
turn first; repeated rows are turns of their own; rows with a NULL conv_id are one conversation.
Turns after the last reply (or all turns, if nobody replies) are kept in one closing example
without a trainable part. An empty table gives no rows; columns other than the four are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, OPEN, CLOSE, END = "<s>", "[INST]", "[/INST]", "</s>"
CONTROL = r"([<\[])(\\*/?(?:s>|INST\]))"
ESCAPED = r"([<\[])\\(\\*/?(?:s>|INST\]))"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2")


def expand(turns: DataFrame) -> DataFrame:
    """(conv_id, example, n_turns, text, loss_start, loss_end, last) of (conv_id, turn, role, text).

    Offsets are code points, the end exclusive; NULL where nothing is trainable. ``last`` marks the
    example of a conversation that holds all its turns.
    """
    text, role = (F.coalesce(F.col(c), F.lit("")) for c in ("text", "role"))
    whole = turns.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", role.alias("role"), escape(text).alias("text")))).alias("turns")
    )
    head = lambda t: F.concat(F.lit(OPEN), escape(t["role"]), F.lit(CLOSE))
    rendered = whole.select(
        "conv_id",
        F.transform("turns", lambda t: F.concat(head(t), t["text"], F.lit(END))).alias("pieces"),
        F.transform("turns", lambda t: F.length(t["text"])).alias("lengths"),
        F.filter(
            F.transform("turns", lambda t, i: F.when((t["role"] == "assistant") | (i == F.size("turns") - 1), i)),
            lambda i: i.isNotNull(),
        ).alias("ends"),
        F.transform("turns", lambda t: t["role"] == "assistant").alias("replies"),
    )
    examples = rendered.select("conv_id", "pieces", "lengths", "replies", F.posexplode("ends").alias("example", "at"))
    joined = F.concat(F.lit(START), F.array_join(F.slice("pieces", F.lit(1), F.col("at") + 1), ""))
    end = F.when(F.get("replies", F.col("at")), F.length("text") - len(END))
    return examples.select(
        "conv_id",
        F.col("example").cast("long").alias("example"),
        (F.col("at") + 1).cast("long").alias("n_turns"),
        joined.alias("text"),
        F.get("lengths", F.col("at")).alias("reply"),
        "replies",
        "at",
        (F.col("at") == F.size("pieces") - 1).alias("last"),
    ).select(
        "conv_id",
        "example",
        "n_turns",
        "text",
        (end - F.col("reply")).cast("long").alias("loss_start"),
        end.cast("long").alias("loss_end"),
        "last",
    )


def parse(text: Column) -> Column:
    """The turns of a formatted example as an array of (role, text)."""
    body = F.substring(text, len(START) + 1, 2**31 - 1)
    parts = F.filter(F.split(body, END, -1), lambda p: p != "")
    return F.transform(
        parts,
        lambda p: F.struct(
            unescape(F.regexp_extract(p, r"(?s)^\[INST\](.*?)\[/INST\]", 1)).alias("role"),
            unescape(F.regexp_replace(p, r"(?s)^\[INST\].*?\[/INST\]", "")).alias("text"),
        ),
    )


def digests(examples: DataFrame) -> DataFrame:
    """Per conversation, read back from the formatted examples: turn and loss digests."""
    reply = unescape(F.substring(F.col("text"), F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start")))
    read = examples.select(
        "conv_id",
        "example",
        F.length("text").cast("long").alias("chars"),
        F.when(F.col("loss_start").isNotNull(), reply).alias("reply"),
        F.when(F.col("last"), F.col("text")).alias("whole"),
    )
    gathered = read.groupBy("conv_id").agg(
        F.sum("chars").alias("formatted_chars"),
        F.max("whole").alias("whole"),
        F.array_sort(F.collect_list(F.when(F.col("reply").isNotNull(), F.struct("example", "reply")))).alias("replies"),
    )
    turns = parse(F.col("whole"))
    loss = F.array_join(F.col("replies.reply"), "")
    return gathered.select("conv_id", turns.alias("turns"), loss.alias("loss"), "formatted_chars").select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(
            F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256
        ).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )
