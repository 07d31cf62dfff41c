"""Chat turns as training examples: each reply with all that came before it."""

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.session import compute_once

# The template: what stands before the role, between role and text, and after the text.
START, MESSAGE, END = "<|start|>", "<|message|>", "<|end|>"
# Beside these, strings that tokenizers of other templates take as control tokens: what follows
# the first character. Nothing that follows holds a first character again.
_CONTROL = r"(?:\||/?s>|/?INST\])"
_BARE = rf"([<\[])(?=\\*{_CONTROL})"
_ESCAPED = rf"([<\[])\\(?=\\*{_CONTROL})"


def escape(text: Column) -> Column:
    """The text with one backslash more after the first character of each control string.

    A control string is one whatever number of backslashes stands there already, so that
    `unescape` gives back any text. Other texts stay as they are.
    """
    return F.regexp_replace(text, _BARE, r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1")


def format_examples(
    conversations: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    target_role: str = "assistant",
) -> DataFrame:
    """One row per turn of `target_role`, with all turns before it: conv_id, example (its number
    in the conversation, from 0), n_turns in it, text, and loss_start and loss_end, the code
    points of the reply in the text, end exclusive. Only these are to be trained on.

    Turns after the last reply, or all of them if there is none, are a last example with an
    empty loss span at its end, so that the last example of a conversation holds all of it.
    Turns go by `turn`, nulls first, then by role and text; repeated rows are turns of their
    own. A null role or text is an empty one; rows with a null conv_id are one conversation.
    An empty table gives none; other columns are not read. A conversation is exchanged
    once, and must fit into a value, as its last example does; its examples are built one
    by one.
    """
    empty = F.lit("")
    turns = conversations.select(
        F.col(conv_id).alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role).cast("string"), empty).alias("role"),
            F.coalesce(F.col(text).cast("string"), empty).alias("text"),
        ).alias("said"),
    )
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("said")).alias("said"))
    marked = whole.select(
        "conv_id",
        F.transform("said", lambda s: s["role"] == target_role).alias("reply"),
        F.transform("said", lambda s: F.struct(
            F.concat(F.lit(START), escape(s["role"]), F.lit(MESSAGE)).alias("head"),
            escape(s["text"]).alias("body"),
        )).alias("said"),
    )
    last = F.size("reply") - 1
    ends = F.filter(F.sequence(F.lit(0), last), lambda i: F.get("reply", i) | (i == last))
    each = marked.select("*", F.posexplode(ends).alias("example", "at"))
    own = F.get("said", F.col("at"))["body"]
    before = F.transform(
        F.slice("said", F.lit(1), F.col("at") + 1), lambda s: F.concat(s["head"], s["body"], F.lit(END))
    )
    built = compute_once(
        each.select("conv_id", "example", "at", F.get("reply", F.col("at")).alias("reply"), own.alias("own"), before.alias("before")),
        text=F.array_join("before", ""),
    )
    whole_text = F.char_length("text").cast("bigint")
    end = F.when(F.col("reply"), whole_text - len(END)).otherwise(whole_text)
    return built.select(
        "conv_id",
        F.col("example").cast("bigint").alias("example"),
        (F.col("at") + 1).cast("bigint").alias("n_turns"),
        "text",
        F.when(F.col("reply"), end - F.char_length("own")).otherwise(end).alias("loss_start"),
        end.alias("loss_end"),
    )


def turns_of(text: Column) -> Column:
    """The turns of an example's text, as an array of (role, text)."""
    parts = F.split(text, re.escape(END))
    spoken = F.slice(parts, F.lit(1), F.size(parts) - 1)

    def read(part: Column) -> Column:
        at = F.instr(part, MESSAGE)
        return F.struct(
            unescape(F.substring(part, F.lit(len(START) + 1), at - len(START) - 1)).alias("role"),
            unescape(F.substring(part, at + len(MESSAGE), F.char_length(part))).alias("text"),
        )

    return F.transform(spoken, read)


def trained_text(text: Column, loss_start: Column, loss_end: Column) -> Column:
    """What stands under the loss mask of an example."""
    return unescape(F.substring(text, (loss_start + 1).cast("int"), (loss_end - loss_start).cast("int")))
