"""Chat formatting: conversations as marked-up text, and one training example per assistant turn.

An example is a prefix of its conversation's text: all turns before the reply are context, and only the reply is
trainable. Examples are therefore spans of the text, which is stored once; the size of the output follows the
input however many turns a conversation has. ``example_texts`` writes the examples out.

A turn is ``<turn ROLE>\\nTEXT</turn>\\n``. Inside roles and texts ``\\``, ``<`` and ``>`` are written ``\\b``, ``\\l`` and
``\\g``, so no text can contain a mark, and the escapes can be undone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, HEAD_END, CLOSE = "<turn ", ">\n", "</turn>\n"


def escape(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l")), F.lit(">"), F.lit("\\g"))


def unescape(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("\\l"), F.lit("<")), F.lit("\\g"), F.lit(">")), F.lit("\\b"), F.lit("\\"))


def format_conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", reply_role: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted`` and ``examples``, an array with one entry per reply.

    An entry has ``example`` (from 0), ``context_chars`` (length of the prefix before the reply, its turn's mark
    included) and ``loss_chars``: the loss mask covers characters ``context_chars + 1`` to
    ``context_chars + loss_chars`` of ``formatted``. Turns are in the order of ``turn`` (null first), ties by role and
    text; repeated rows are repeated turns. Null roles and texts are empty, null ids form one conversation. A
    conversation is one row, so it has to fit a task; that is the only limit on its turns.
    """
    cols = turns.select(
        F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    marked = cols.select(
        "conv_id",
        F.struct(
            "turn",
            "role",
            "text",
            F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(HEAD_END)).alias("head"),
            escape(F.col("text")).alias("body"),
        ).alias("t"),
    )
    ordered = marked.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    start = F.struct(F.lit(0).cast("long").alias("pos"), F.lit(0).alias("replies"), F.array().cast("array<struct<example:int,context_chars:long,loss_chars:long>>").alias("examples"))

    def advance(acc: Column, t: Column) -> Column:
        head_end = acc["pos"] + F.length(t["head"])
        body = F.length(t["body"]).cast("long")
        reply = t["role"] == reply_role
        entry = F.array(F.struct(acc["replies"].alias("example"), head_end.alias("context_chars"), body.alias("loss_chars")))
        return F.struct(
            (head_end + body + len(CLOSE)).alias("pos"),
            (acc["replies"] + reply.cast("int")).alias("replies"),
            F.when(reply, F.concat(acc["examples"], entry)).otherwise(acc["examples"]).alias("examples"),
        )

    return ordered.select(
        "conv_id",
        F.concat_ws("", F.transform("t", lambda t: F.concat(t["head"], t["body"], F.lit(CLOSE)))).alias("formatted"),
        F.aggregate("t", start, advance)["examples"].alias("examples"),
    )


def explode_examples(formatted: DataFrame) -> DataFrame:
    """One row per reply: ``conv_id, example, context_chars, loss_chars, target``; ``target`` is the escaped reply, read from the text."""
    spans = F.transform(
        "examples", lambda e: e.withField("target", F.substring("formatted", (e["context_chars"] + 1).cast("int"), e["loss_chars"].cast("int")))
    )
    return formatted.select("conv_id", F.inline(spans))


def example_texts(formatted: DataFrame) -> DataFrame:
    """The examples written out: ``conv_id, example, context, target``. The bytes grow with the square of a conversation's turns."""
    e = formatted.select("conv_id", "formatted", F.inline("examples"))
    return e.select(
        "conv_id",
        "example",
        F.expr("substring(formatted, 1, CAST(context_chars AS INT))").alias("context"),
        F.expr("substring(formatted, CAST(context_chars + 1 AS INT), CAST(loss_chars AS INT))").alias("target"),
    )


def parse_turns(formatted: Column) -> Column:
    """Array of ``(role, text)`` read back from a formatted conversation."""
    blocks = F.filter(F.split(formatted, CLOSE), lambda b: b != "")

    def turn(b: Column) -> Column:
        role = F.substring_index(b, HEAD_END, 1)
        body = F.substring(b, F.length(role) + len(HEAD_END) + 1, F.length(b))
        return F.struct(unescape(F.substring(role, F.lit(len(OPEN) + 1), F.length(role))).alias("role"), unescape(body).alias("text"))

    return F.transform(blocks, turn)


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """What can be read back, per conversation: ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``.

    ``formatted_chars`` counts the code points of the formatted conversation, which all its examples share.
    """
    back = parse_turns(F.col("formatted"))
    turns = formatted.select(
        "conv_id",
        F.size(back).cast("long").alias("n_turns"),
        F.sha2(F.concat_ws("", F.transform(back, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))), 256).alias("turns_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        F.transform(
            "examples", lambda e: F.struct(e["example"].alias("example"), F.substring("formatted", (e["context_chars"] + 1).cast("int"), e["loss_chars"].cast("int")).alias("target"))
        ).alias("replies"),
    )
    each = turns.select("conv_id", "n_turns", "turns_sha256", "formatted_chars", F.inline_outer("replies"))
    reply = F.struct("example", unescape(F.col("target")).alias("text"))
    # the rows are still dealt by conv_id, so bringing the examples back together needs no second shuffle
    joined = each.groupBy("conv_id").agg(
        F.first("n_turns").alias("n_turns"),
        F.first("turns_sha256").alias("turns_sha256"),
        F.first("formatted_chars").alias("formatted_chars"),
        F.concat_ws("", F.transform(F.array_sort(F.collect_list(reply)), lambda r: r["text"])).alias("loss"),
    )
    return joined.select("conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
