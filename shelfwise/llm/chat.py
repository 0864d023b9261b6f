"""Chat formatting by event-sourced reconstruction (native).

A log has one row for each event of a message: ``message`` (opening text),
``delta`` (streamed text to append), ``edit`` (new whole text) and
``regenerate`` (forget the text so far). The last edit or regeneration of a
message counts, with what was streamed after it; the messages of a
conversation, in order, are rendered as

    <|im_start|>ROLE\\nTEXT<|im_end|>\\n

with character offsets of every turn and text, and the loss mask on the
assistant's texts. Inside texts and roles a backslash is put into every
``<|`` (``<\\|``, and ``<\\|`` becomes ``<\\\\|``), so no marker can occur
there and the step can be undone; line breaks in roles are written ``\\n``.

Scale: texts move three times: to fold the log by message, to put blocks of
``BLOCK`` messages of a conversation together, and to make the conversation of
its blocks. A conversation with a third of all rows is so spread over many tasks
until its finished blocks meet in the one row that it becomes. The events of
a message are sorted and counted in one task, which spills, and joined
``PARTS`` sequence numbers at a time.

Nulls and edge cases: null texts and roles are empty, an unknown or null
kind counts as ``message``; a null conversation id is a conversation; null
message numbers come first. Events that repeat key and sequence keep a fixed
order (by kind, then text). A log without rows gives no conversations. Other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from shelfwise.llm.common import col

# The template's marks.
START, END = "<|im_start|>", "<|im_end|>"
RESETS = ("edit", "regenerate")
BLOCK = 256          # messages put together at once
PARTS = 4096         # sequence numbers of a message put together at once

def escape(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*)\|", r"<\\$1|")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"<\\(\\*)\|", r"<$1|")


def escape_role(c: Column) -> Column:
    c = F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))
    return escape(c)


def unescape_role(c: Column) -> Column:
    # An even run of backslashes before "n" is text; each pair is one backslash.
    c = F.regexp_replace(unescape(c), r"(?<!\\)((?:\\\\)*)\\n", "$1\n")
    return F.replace(c, F.lit("\\\\"), F.lit("\\"))


def fold(log: DataFrame, keys: list[str]) -> DataFrame:
    """One row per message (``keys``, ``role``, ``text``) of a log with
    ``keys``, ``seq``, ``kind``, ``role`` and ``text``."""
    # What came before the last reset says nothing any more, but may name the role.
    reset = F.max(F.when(F.col("kind").isin(*RESETS), F.col("seq"))).over(Window.partitionBy(*keys))
    dead = F.coalesce(F.col("reset") > F.coalesce(F.col("seq"), F.lit(-1 << 63)), F.lit(False))
    live = log.withColumn("reset", reset).select(
        *keys, "seq", "role",
        F.when(dead | (F.col("kind") == "regenerate"), F.lit("")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("kind").isin(*RESETS), 0).otherwise(1).alias("late"))
    # An edit is the first of its sequence number; of two, the larger text is.
    part = F.floor(F.col("seq") / PARTS).alias("part")
    event = F.struct("seq", "late", F.coalesce("text", F.lit("")).alias("text"))
    some = live.groupBy(*keys, part).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(event)), lambda e: e["text"]), "").alias("text"),
        F.min(F.when(F.col("role").isNotNull(), F.struct("seq", "role"))).alias("role"))
    piece = F.struct("part", "text")
    return some.groupBy(*keys).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(piece)), lambda e: e["text"]), "").alias("text"),
        F.coalesce(F.min("role")["role"], F.lit("")).alias("role"))


def render(messages: DataFrame, conv: str, order: list[str], loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: its id, ``n_turns``, ``formatted`` and ``turns``, an array of
    (``start``, ``text_start``, ``text_end``, ``loss``) in characters of ``formatted``.

    ``order``: the columns that sort a conversation's messages; the first is an integer."""
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    m = messages.select(
        col(conv).alias("conv"), F.floor(F.col(order[0]) / BLOCK).alias("block"),
        F.struct(*order).alias("at"), head.alias("head"), escape(F.col("text")).alias("body"),
        (F.col("role") == loss_role).alias("loss"))
    m = m.withColumns({"head_n": F.char_length("head"), "body_n": F.char_length("body"),
                       "shown": F.concat("head", "body", F.lit(END + "\n"))})
    m = m.withColumn("n", F.col("head_n") + F.col("body_n") + len(END) + 1)
    upto = Window.partitionBy("conv", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    m = m.withColumn("start", F.coalesce(F.sum("n").over(upto), F.lit(0)).cast("long"))
    turn = F.struct("at", "shown", "start", (F.col("start") + F.col("head_n")).alias("text_start"),
                    (F.col("start") + F.col("head_n") + F.col("body_n")).alias("text_end"), "loss")
    blocks = (m.groupBy("conv", "block")
              .agg(F.sort_array(F.collect_list(turn)).alias("t"), F.sum("n").alias("n"))
              .select("conv", "block", "n", F.array_join(F.transform("t", lambda x: x["shown"]), "").alias("shown"),
                      F.transform("t", lambda x: F.struct(x["start"], x["text_start"], x["text_end"], x["loss"])).alias("t")))
    upto = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("base", F.coalesce(F.sum("n").over(upto), F.lit(0)).cast("long"))
    moved = F.transform("t", lambda x: F.struct(
        (x["start"] + F.col("base")).alias("start"), (x["text_start"] + F.col("base")).alias("text_start"),
        (x["text_end"] + F.col("base")).alias("text_end"), x["loss"].alias("loss")))
    whole = (blocks.select("conv", F.struct("block", "shown", moved.alias("t")).alias("b"))
             .groupBy("conv").agg(F.sort_array(F.collect_list("b")).alias("b")))
    return whole.select(
        F.col("conv").alias(conv), F.size(F.flatten(F.col("b.t"))).cast("long").alias("n_turns"),
        F.array_join(F.col("b.shown"), "").alias("formatted"), F.flatten(F.col("b.t")).alias("turns"))


def read_back(formatted: DataFrame) -> DataFrame:
    """``formatted`` with ``said`` (array of ``role``, ``text``) and ``loss_texts`` (what the
    mask covers, unescaped), both taken from the columns ``formatted`` and ``turns`` alone."""
    parts = F.slice(F.split("formatted", r"<\|im_start\|>", -1), 2, F.size("turns"))

    def masked(part: Column, turn: Column) -> Column:
        skip = turn["text_start"] - turn["start"] - len(START)
        return F.substring(part, (skip + 1).cast("int"), (turn["text_end"] - turn["text_start"]).cast("int"))

    def said(part: Column) -> Column:
        role = F.substring_index(part, "\n", 1)
        n = F.char_length(part) - F.char_length(role) - 1 - len(END) - 1
        return F.struct(unescape_role(role).alias("role"),
                        unescape(F.substring(part, F.char_length(role) + 2, n)).alias("text"))

    rows = formatted.withColumn("parts", parts)
    both = F.arrays_zip("parts", "turns")
    return rows.select(
        *formatted.columns, F.transform("parts", said).alias("said"),
        F.transform(F.filter(both, lambda x: x["turns"]["loss"]),
                    lambda x: unescape(masked(x["parts"], x["turns"]))).alias("loss_texts"))


def format_log(log: DataFrame, conv: str = "conv_id", message: str = "message", copy: str | None = None,
               seq: str = "seq", kind: str | None = "kind", role: str = "role", text: str = "text") -> DataFrame:
    """Fold and render a log of events (see the module). ``copy`` tells messages of one number apart."""
    blank = F.lit(None).cast(T.StringType())
    plain = log.select(
        col(conv).alias("conv"), col(message).cast("long").alias("message"),
        (col(copy) if copy else F.lit(0)).cast("long").alias("copy"), col(seq).cast("long").alias("seq"),
        (col(kind) if kind else blank).alias("kind"), col(role).cast("string").alias("role"),
        col(text).cast("string").alias("text"))
    return render(fold(plain, ["conv", "message", "copy"]), "conv", ["message", "copy"]) \
        .withColumnRenamed("conv", conv)


def turns_as_log(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text") -> DataFrame:
    """A table of finished turns as a log: each row opens a message of its own.
    Rows of one turn are told apart by ``copy``, in the order of role and text."""
    w = Window.partitionBy("conv_id", "message").orderBy("role", "text")
    return (turns.select(col(conv).alias("conv_id"), col(turn).alias("message"), col(turn).alias("seq"),
                         F.lit("message").alias("kind"), col(role).alias("role"), col(text).alias("text"))
            .withColumn("copy", F.row_number().over(w)))
