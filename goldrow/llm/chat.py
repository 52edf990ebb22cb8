"""Chat formatting in DataFrame expressions only.

The turns of a conversation are collected as structs and sorted. Adjacent turns of one role
become one message: the places where a role starts are filtered out of the turns' places,
and each message takes the slice up to the next start. Messages are written as segments of
text, marked whether they are under the loss mask, and the formatted text is their
concatenation:

    <|im_start|>role LF text <|im_next|> text <|im_end|> LF

Texts stand between marks that begin with ``<|``. Inside of a text, ``<`` and ``|`` with any
number of backslashes between them get one backslash more, so no text can hold a mark, and
taking one away again gives the text back. A role ends at the first line feed; its own line
feeds are written as ``<n``, and what looks like that is escaped in the same way.

A formatted conversation is one value of one row, which holds all of its turns. All steps
are linear in their number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, NEXT, END = "<|im_start|>", "<|im_next|>", "<|im_end|>\n"
#: Role whose texts are under the loss mask.
LEARNED = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    return F.replace(
        F.regexp_replace(role, r"<(\\*)([|n])", r"<\\$1$2"), F.lit("\n"), F.lit("<n")
    )


def unescape_role(role: Column) -> Column:
    lines = F.replace(role, F.lit("<n"), F.lit("\n"))
    return F.regexp_replace(lines, r"<\\(\\*)([|n])", r"<$1$2")


def _segment(text: Column, loss: Column | bool) -> Column:
    loss = loss if isinstance(loss, Column) else F.lit(loss)
    return F.struct(text.alias("text"), loss.alias("loss"))


def _messages(turns: str) -> Column:
    """Merge adjacent turns of one role into structs of a role and texts."""
    places = F.sequence(F.lit(1), F.size(turns))
    begins = (F.lit(1), F.size(turns) + 1)
    role = lambda i: F.element_at(turns, i)["role"]
    starts = F.filter(
        places, lambda i: F.when(i == begins[0], True).otherwise(role(i) != role(i - 1))
    )
    bounds = F.concat(starts, F.array(begins[1]))
    pairs = F.arrays_zip(
        F.slice(bounds, 1, F.size(bounds) - 1).alias("start"),
        F.slice(bounds, 2, F.size(bounds) - 1).alias("stop"),
    )
    return F.transform(
        pairs,
        lambda p: F.struct(
            role(p["start"]).alias("role"),
            F.transform(
                F.slice(turns, p["start"], p["stop"] - p["start"]), lambda t: t["text"]
            ).alias("texts"),
        ),
    )


def _segments(messages: str) -> Column:
    def of_message(m: Column) -> Column:
        learned = m["role"] == LEARNED
        head = _segment(F.concat(F.lit(START), escape_role(m["role"]), F.lit("\n")), False)
        texts = F.flatten(
            F.transform(
                m["texts"],
                lambda t, i: F.when(i == 0, F.array(_segment(escape(t), learned))).otherwise(
                    F.array(_segment(F.lit(NEXT), False), _segment(escape(t), learned))
                ),
            )
        )
        return F.concat(F.array(head), texts, F.array(_segment(F.lit(END), False)))

    return F.flatten(F.transform(messages, of_message))


def format_conversations(
    df: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """Rows (``conversation``, formatted, segments), one per conversation.

    Turns go by ``turn``, a null one first, then by role and text; equal rows stay as often
    as they are there. A null role or text is an empty one, a null conversation is one of
    its own, and an empty table gives an empty result. ``segments`` are structs (text, loss)
    whose texts make up ``formatted``; those with ``loss`` are the texts of the assistant,
    escaped as they stand. Other columns of any name are left out.
    """
    empty = F.lit("")
    rows = df.select(
        F.col(f"`{conversation}`").alias("conversation"),
        F.struct(
            F.col(f"`{turn}`").alias("turn"),
            F.coalesce(F.col(f"`{role}`"), empty).alias("role"),
            F.coalesce(F.col(f"`{text}`"), empty).alias("text"),
        ).alias("t"),
    )
    turns = rows.groupBy("conversation").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    return (
        turns.withColumn("messages", _messages("turns"))
        .withColumn("segments", _segments("messages"))
        .select(
            F.col("conversation").alias(conversation),
            F.array_join(F.col("segments.text"), "").alias("formatted"),
            "segments",
        )
    )


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) that a formatted conversation was made of."""
    messages = F.split(formatted, r"<\|im_start\|>")

    def of_message(m: Column) -> Column:
        role = F.substring_index(m, "\n", 1)
        rest = F.char_length(m) - F.char_length(role) - 1 - len(END)
        body = F.substring(m, F.char_length(role) + 2, rest)
        return F.transform(
            F.split(body, r"<\|im_next\|>"),
            lambda t: F.struct(unescape_role(role).alias("role"), unescape(t).alias("text")),
        )

    # Before the first mark is nothing.
    return F.flatten(F.transform(F.slice(messages, 2, F.size(messages)), of_message))


def read_loss(segments: Column) -> Column:
    """The texts under the loss mask, as they were before they were escaped."""
    learned = F.filter(segments, lambda s: s["loss"])
    return F.transform(learned, lambda s: unescape(s["text"]))
