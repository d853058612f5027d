"""Event-sourced chat reconstruction and formatting (DataFrame functions only).

A log holds events of conversations: ``message`` starts or restates a turn,
``delta`` appends to it, ``edit`` replaces its text, ``regenerate`` clears it
for the deltas that follow.  Events are partitioned by conversation and turn,
sorted by sequence number and folded into the final message.  The fold is
associative, so long logs are folded in chunks of the sequence first and a
turn's chunks after that; conversations are rendered in parts of
``TURNS`` turns.  No task ever holds a whole long conversation.

Template: ``[INST]role[/INST]text</s>`` per turn.  Inside roles and texts
backslash, ``<`` and ``[`` are written ``\\b``, ``\\l`` and ``\\q``, so no text
can hold a control string, and reading them back is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playlens.llm.common import pick

#: Sequence numbers folded together, and turns rendered together.
CHUNK = 1024
TURNS = 256

_OPEN, _MID, _END = "[INST]", "[/INST]", "</s>"


def escape(c: Column) -> Column:
    for raw, code in (("\\", "\\b"), ("<", "\\l"), ("[", "\\q")):
        c = F.replace(c, F.lit(raw), F.lit(code))
    return c


def unescape(c: Column) -> Column:
    for raw, code in (("<", "\\l"), ("[", "\\q"), ("\\", "\\b")):
        c = F.replace(c, F.lit(code), F.lit(raw))
    return c


def _fold(events: Column) -> Column:
    """Fold sorted (order, reset, role, text) into one (reset, role, text)."""
    zero = F.struct(F.lit(False).alias("reset"), F.lit(None).cast("string").alias("role"), F.lit("").alias("text"))
    return F.aggregate(events, zero, lambda acc, e: F.struct(
        (acc["reset"] | e["reset"]).alias("reset"),
        F.coalesce(e["role"], acc["role"]).alias("role"),
        F.when(e["reset"], e["text"]).otherwise(F.concat(acc["text"], e["text"])).alias("text")))


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages ``(conv_id, turn, sub, role, text)`` of a log with
    columns ``conv_id, turn, sub, seq, kind, role, text``.

    ``sub`` parts messages that share a turn number.  Null text is empty; a
    null or unknown kind counts as ``message``; a null role keeps the role so
    far; events of equal ``seq`` apply in order of kind, role and text; events
    without a turn form a turn of their own, sorted first.
    """
    kind = F.lower(F.coalesce("kind", F.lit("message")))
    e = events.select(
        "conv_id", "turn", "sub", F.coalesce(F.floor(F.col("seq") / CHUNK), F.lit(-1)).alias("chunk"),
        F.struct("seq", kind.alias("kind"), (kind != "delta").alias("reset"), "role",
                 F.when(kind == "regenerate", "").otherwise(F.coalesce("text", F.lit(""))).alias("text")).alias("e"))
    chunks = (e.groupBy("conv_id", "turn", "sub", "chunk").agg(F.array_sort(F.collect_list("e")).alias("all"))
              .withColumn("f", _fold(F.col("all"))))
    return (chunks.groupBy("conv_id", "turn", "sub")
            .agg(F.array_sort(F.collect_list(F.struct("chunk", "f.reset", "f.role", "f.text"))).alias("all"))
            .withColumn("f", _fold(F.col("all")))
            .select("conv_id", "turn", "sub", "f.role", "f.text"))


def render(messages: DataFrame) -> DataFrame:
    """Rows ``(conv_id, part, formatted, loss_spans)``: the parts of a
    conversation in order make its formatted text; ``loss_spans`` are
    ``(start, length)`` in characters of the part, one per assistant turn,
    covering its escaped text.  A null role is rendered as empty."""
    role = escape(F.coalesce("role", F.lit("")))
    head = F.concat(F.lit(_OPEN), role, F.lit(_MID))
    one = messages.select(
        "conv_id", F.coalesce(F.floor(F.col("turn") / TURNS), F.lit(-1)).alias("part"),
        F.struct("turn", "sub", head.alias("head"), escape(F.coalesce("text", F.lit(""))).alias("text"),
                 (F.coalesce("role", F.lit("")) == "assistant").alias("learn")).alias("m"))
    parts = one.groupBy("conv_id", "part").agg(F.array_sort(F.collect_list("m")).alias("ms"))
    spans = F.aggregate(
        "ms", F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")),
        lambda acc, m: F.struct(
            (acc["at"] + F.length(m["head"]) + F.length(m["text"]) + len(_END)).alias("at"),
            F.when(m["learn"], F.concat(acc["spans"], F.array(F.struct(
                (acc["at"] + F.length(m["head"])).alias("start"), F.length(m["text"]).alias("length")))))
            .otherwise(acc["spans"]).alias("spans")))["spans"]
    return parts.select("conv_id", "part", F.array_join(F.transform(
        "ms", lambda m: F.concat(m["head"], m["text"], F.lit(_END))), "").alias("formatted"), spans.alias("loss_spans"))


def format_events(events: DataFrame) -> DataFrame:
    """Fold a log and render it; an empty log gives no rows."""
    return render(fold_events(events))


def read_back(formatted: DataFrame) -> DataFrame:
    """``(conv_id, part, turns, loss)``: the (role, text) turns and the texts
    under the loss mask, unescaped, read from the rendered parts alone."""
    pieces = F.filter(F.split("formatted", _END), lambda p: p != "")
    turns = F.transform(pieces, lambda p: F.transform(F.split(p, r"\[/?INST\]"), unescape))
    return formatted.select(
        "conv_id", "part", F.length("formatted").alias("chars"),
        F.transform(turns, lambda t: F.struct(F.get(t, F.lit(1)).alias("role"), F.get(t, F.lit(2)).alias("text"))).alias("turns"),
        F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["length"]))).alias("loss"))


def events_of(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A table of finished turns as a log of ``message`` events; rows that
    share conversation and turn stay apart, in order of role and text."""
    slim = pick(rows, conv_id=conv, turn=turn, role=role, text=text)
    sub = F.row_number().over(Window.partitionBy("conv_id", "turn").orderBy("role", "text"))
    return slim.withColumn("sub", sub).withColumn("seq", F.col("turn")).withColumn("kind", F.lit("message"))
