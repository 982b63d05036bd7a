"""Chat formatting by prefix-target expansion, in DataFrame operations only.

Every assistant turn becomes an example of its own: all turns before it as context, then that reply, the only
trainable part. A conversation whose last turn is not an assistant's adds one example of all its turns with
nothing to train on, so that no turn is lost.

A turn is written ``<|im_start|>role NEWLINE text<|im_end|> NEWLINE``. Roles and texts are escaped so that they can't
hold a control string: backslash becomes ``\\e``, ``<|`` becomes ``\\l`` and, in a role, a newline becomes ``\\n``;
unescape() undoes this exactly.

Turns go by turn number (null first), then role and text; rows that repeat are turns of their own. A null role or text
is empty; rows with a null conv_id form one conversation. Further columns are ignored; no rows give no examples. A
conversation is one row here, so its texts must fit a row (2 GB); the expansion's size is the sum of its prefixes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
TRAINED_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\e")), F.lit("<|"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<|")), F.lit("\\e"), F.lit("\\"))


def examples(conversations: DataFrame) -> DataFrame:
    """(conv_id, example, n_turns, text, loss_start, loss_length): the loss mask is a span of code points of text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    shown = F.replace(escape(role), F.lit("\n"), F.lit("\\n"))
    turn = F.struct("turn", role.alias("role"), text.alias("text"), F.concat(F.lit(START), shown, F.lit("\n")).alias("head"), escape(text).alias("body"))
    talks = conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    ends = F.filter(F.sequence(F.lit(1), F.size("turns")), lambda i: (F.element_at("turns", i)["role"] == TRAINED_ROLE) | (i == F.size("turns")))
    spread = talks.select("conv_id", "turns", F.posexplode(ends).alias("at", "n_turns"))
    written = F.transform(F.slice("turns", 1, F.col("n_turns")), lambda t: F.concat(t["head"], t["body"], F.lit(f"{END}\n")))
    last = F.element_at("turns", F.col("n_turns"))
    trained = last["role"] == TRAINED_ROLE
    full = F.concat_ws("", written)
    closing = F.length(last["body"]) + len(END) + 1
    return spread.select(
        "conv_id", (F.col("at") + 1).alias("example"), F.col("n_turns").cast("long").alias("n_turns"), full.alias("text"),
        F.when(trained, F.length(full) - closing).otherwise(F.length(full)).alias("loss_start"), F.when(trained, F.length(last["body"])).otherwise(0).alias("loss_length"),
    )


def parse(text: Column) -> Column:
    """The turns of a formatted text: an array of (role, text)."""
    blocks = F.filter(F.split(text, r"<\|im_end\|>\n"), lambda b: b != "")
    role = lambda b: F.regexp_extract(b, r"(?s)^<\|im_start\|>([^\n]*)\n(.*)$", 1)
    body = lambda b: F.regexp_extract(b, r"(?s)^<\|im_start\|>([^\n]*)\n(.*)$", 2)
    return F.transform(blocks, lambda b: F.struct(unescape(F.replace(role(b), F.lit("\\n"), F.lit("\n"))).alias("role"), unescape(body(b)).alias("text")))


def digests(formatted: DataFrame) -> DataFrame:
    """What each conversation's examples hold, read back from them."""
    piece = F.struct("example", unescape(F.expr("substring(text, loss_start + 1, loss_length)")).alias("loss"))
    back = formatted.groupBy("conv_id").agg(F.max_by("text", "example").alias("whole"), F.array_sort(F.collect_list(piece)).alias("pieces"), F.sum(F.length("text")).alias("formatted_chars"))
    back = back.select("conv_id", parse(F.col("whole")).alias("turns"), F.concat_ws("", F.col("pieces.loss")).alias("loss"), "formatted_chars")
    lines = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), F.col("formatted_chars").cast("long").alias("formatted_chars"))
