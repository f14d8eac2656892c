"""Chat formatting: prefix-target expansion.

Every assistant turn becomes its own training example: all preceding turns are its context
and only that reply is trainable. A conversation whose last turn is not an assistant's (or
that has no assistant turn at all) ends in one more example without a target, so that every
turn is in the output.

Template: ``<|im_start|>role<|im_sep|>text<|im_end|>`` per turn. Control strings inside roles
and texts are escaped reversibly: a backslash goes in after their first character, and
strings that already look escaped get one more, so that taking one out restores them all.
``read_back`` undoes it from the formatted examples alone.

A conversation is one training text, so its turns meet in one row; what grows with the
table is the number of conversations. Everything is DataFrame functions.

Defined results: null texts and roles are empty; turns with one number are ordered by role
and text; a null conversation id is a conversation of its own; an empty table gives no rows;
columns besides the four named are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
ASSISTANT = "assistant"
#: Bodies of the control strings, after their first character ``<`` or ``[``.
BODIES = r"\|im_start\|>|\|im_sep\|>|\|im_end\|>|/?s>|/?INST\]"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*)({BODIES})", r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*)({BODIES})", "$1$2$3")


def conversations(turns: DataFrame) -> DataFrame:
    """conv_id and its ordered array ``turns`` of struct(turn, role, text)."""
    row = F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("turns"))


def expand(turns: DataFrame) -> DataFrame:
    """One row per example: conv_id, example (index of its last turn), formatted,
    loss_start (characters before the trainable reply) and loss_chars (its escaped length;
    both null without a target)."""
    heads = lambda x: F.concat(F.lit(START), escaped(x["role"]), F.lit(SEP))
    pieces = conversations(turns).select(
        "conv_id",
        F.transform("turns", lambda x: F.struct(
            (x["role"] == ASSISTANT).alias("target"),
            F.length(heads(x)).alias("head"),
            F.length(escaped(x["text"])).alias("body"),
            F.concat(heads(x), escaped(x["text"]), F.lit(END)).alias("piece"),
        )).alias("__p"),
    )
    last = F.size("__p") - 1
    ends = F.filter(F.sequence(F.lit(0), last), lambda i: F.get(F.col("__p"), i)["target"] | (i == last))
    each = pieces.select("conv_id", "__p", F.explode(ends).alias("example"))
    own = F.get(F.col("__p"), F.col("example"))
    formatted = F.array_join(F.transform(F.slice("__p", 1, F.col("example") + 1), lambda x: x["piece"]), "")
    return each.select(
        "conv_id", "example", formatted.alias("formatted"), own["target"].alias("__target"),
        own["head"].alias("__head"), own["body"].alias("__body"), F.length(own["piece"]).alias("__own"),
    ).select(
        "conv_id", "example", "formatted",
        F.when(F.col("__target"), F.length("formatted") - F.col("__own") + F.col("__head")).alias("loss_start"),
        F.when(F.col("__target"), F.col("__body")).alias("loss_chars"),
    )


def read_back(formatted: Column) -> Column:
    """Array of struct(role, text) from a formatted example."""
    parts = F.filter(F.split(formatted, r"<\|im_start\|>"), lambda p: p != "")
    return F.transform(parts, lambda p: F.struct(
        unescaped(F.substring_index(p, SEP, 1)).alias("role"),
        unescaped(F.substring(
            p, F.length(F.substring_index(p, SEP, 1)) + len(SEP) + 1,
            F.length(p) - F.length(F.substring_index(p, SEP, 1)) - len(SEP) - len(END),
        )).alias("text"),
    ))


def digests(examples: DataFrame) -> DataFrame:
    """Per conversation, from the examples only: n_turns and turns_sha256 of the longest one,
    loss_chars and loss_sha256 of all text under the loss masks, formatted_chars and
    n_examples of all examples."""
    loss = unescaped(F.expr("substring(formatted, loss_start + 1, loss_chars)"))
    masked = examples.select("conv_id", "example", "formatted", loss.alias("loss"), F.length("formatted").cast("long").alias("n"))
    joined = masked.groupBy("conv_id").agg(
        F.max_by("formatted", "example").alias("__full"),
        F.sort_array(F.collect_list(F.when(F.col("loss").isNotNull(), F.struct("example", "loss")))).alias("__loss"),
        F.sum("n").alias("formatted_chars"),
        F.count("*").alias("n_examples"),
    ).select(
        "conv_id", read_back(F.col("__full")).alias("__turns"),
        F.array_join(F.transform("__loss", lambda x: x["loss"]), "").alias("__loss"),
        "formatted_chars", "n_examples",
    )
    turns = F.array_join(F.transform("__turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return joined.select(
        "conv_id", F.size("__turns").cast("long").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length("__loss").cast("long").alias("loss_chars"),
        F.sha2("__loss", 256).alias("loss_sha256"),
        "formatted_chars", "n_examples",
    )
