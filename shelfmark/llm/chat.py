r"""Chat formatting with Spark expressions alone.

The turns of a conversation are collected as structs and sorted by (turn, role, text);
an aggregate over the array merges adjacent turns of one role into a block; the blocks
are written out as::

    ### role: first text</part>second text</turn>\n

Inside roles and texts the control strings are broken by backslashes, and backslashes
doubled, so that reading back is exact: ``\`` to ``\\``, ``#`` before another ``#`` to
``#\``, ``<`` before ``/`` to ``<\``; in roles also ``:`` to ``\:``. ``spans`` is the loss
mask: start and length, in code points, of each assistant text as it stands escaped.

Defined results: a null text or role is an empty one; a null turn comes before all
others; turns that tie stand in order of role and text; repeated rows are repeated
turns; a null conv_id is a conversation; conversations without rows do not exist. Extra
columns are ignored. A formatted conversation is one value, so the turns of one
conversation do meet in a task; conversations do not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART, TURN, MARK = "</part>", "</turn>\n", "### "
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    marks = F.regexp_replace(doubled, "#(?=#)", r"#\\")
    return F.regexp_replace(marks, "<(?=/)", r"<\\")


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(":"), F.lit("\\:"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_conversations(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``conv_id``, ``formatted`` and ``spans`` (start from 1, length) per conversation."""
    one = F.struct(
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    sorted_turns = F.sort_array(F.collect_list(one))
    grouped = turns.groupBy(F.col(conv_id).alias("conv_id")).agg(sorted_turns.alias("turns"))
    block = "array<struct<role:string,texts:array<string>>>"

    def merge(blocks: Column, t: Column) -> Column:
        last = F.try_element_at(blocks, F.lit(-1))
        alone = F.struct(t["role"].alias("role"), F.array(t["text"]).alias("texts"))
        joined = F.struct(last["role"].alias("role"), F.concat(last["texts"], F.array(t["text"])).alias("texts"))
        same = last.isNotNull() & (last["role"] == t["role"])
        return F.when(
            same, F.concat(F.slice(blocks, F.lit(1), F.greatest(F.size(blocks) - 1, F.lit(0))), F.array(joined))
        ).otherwise(F.concat(blocks, F.array(alone)))

    blocks = F.aggregate("turns", F.array().cast(block), merge)

    def piece(value: Column, loss: Column) -> Column:
        return F.struct(value.alias("text"), loss.alias("loss"))

    def pieces(b: Column) -> Column:
        head = piece(F.concat(F.lit(MARK), escape_role(b["role"]), F.lit(": ")), F.lit(False))
        body = F.transform(
            b["texts"],
            lambda t, i: F.array(
                piece(F.when(i > 0, F.lit(PART)).otherwise(F.lit("")), F.lit(False)), piece(escape(t), b["role"] == LOSS_ROLE)
            ),
        )
        return F.concat(F.array(head), F.flatten(body), F.array(piece(F.lit(TURN), F.lit(False))))

    written = grouped.select("conv_id", blocks.alias("blocks")).select(
        "conv_id", F.flatten(F.transform("blocks", pieces)).alias("pieces")
    )
    span = "array<struct<start:int,length:int>>"
    start = F.struct(F.lit(1).alias("at"), F.array().cast(span).alias("spans"))

    def advance(state: Column, p: Column) -> Column:
        size = F.length(p["text"])
        found = F.array(F.struct(state["at"].alias("start"), size.alias("length")))
        return F.struct(
            (state["at"] + size).alias("at"),
            F.when(p["loss"], F.concat(state["spans"], found)).otherwise(state["spans"]).alias("spans"),
        )

    return written.select(
        "conv_id",
        F.concat_ws("", F.transform("pieces", lambda p: p["text"])).alias("formatted"),
        F.aggregate("pieces", start, advance)["spans"].alias("spans"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns (``role``, ``text``) that a formatted conversation was made from."""
    blocks = F.filter(F.split(formatted, F.lit(TURN), -1), lambda b: b != "")
    header = r"(?s)^### ((?:[^:\\]|\\.)*): (.*)$"

    def turns(b: Column) -> Column:
        role = unescape(F.regexp_extract(b, header, 1))
        body = F.regexp_extract(b, header, 2)
        return F.transform(
            F.split(body, F.lit(PART), -1), lambda t: F.struct(role.alias("role"), unescape(t).alias("text"))
        )

    return F.flatten(F.transform(blocks, turns))


def loss_text(formatted: Column, spans: Column) -> Column:
    """Everything under the loss mask, unescaped, one after the other."""
    return F.concat_ws("", F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"], s["length"]))))


def conversation_digest(chats: DataFrame) -> DataFrame:
    """What can be read back from ``formatted`` and ``spans``, as counts and digests."""
    read = chats.select(
        "conv_id",
        read_turns(F.col("formatted")).alias("turns"),
        loss_text(F.col("formatted"), F.col("spans")).alias("loss"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    told = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )
