"""Chat formatting with typed content parts, and its exact reading back."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed marks of the template.
START, SEP, END = "<|start|>", "<|sep|>", "<|end|>"
#: What an ordinary text may not hold unescaped: the marks of this template and of common others.
CONTROL = r"([<\[])(?=\|[^|>\s]{1,40}\|>|/?s>|/?INST\]|</?SYS>>|/?SYS>>)"
ESC = "␛"  # escape sign; itself written ESC + "0", a broken control string has ESC + "1" after its first character

PART = "struct<type:string,text:string,ref:string,tokens:int>"
KINDS = ("image", "audio", "document")


def escape(text: Column) -> Column:
    """Make control strings harmless; ``unescape`` gives back exactly the same text."""
    return F.regexp_replace(F.replace(text, F.lit(ESC), F.lit(ESC + "0")), CONTROL, "$1" + ESC + "1")


def unescape(text: str) -> str:
    return text.replace(ESC + "1", "").replace(ESC + "0", ESC)


def visit(part: Column, index: Column, turn: Column) -> Column:
    """One visitor for all kinds of parts: rendered string, attachment reference (or null) and expanded tokens.

    Text: itself, escaped. Image, audio, document: a placeholder numbered by turn and part. Unknown kinds: their text.
    """
    kind = F.lower(F.coalesce(part["type"], F.lit("text")))
    attached = kind.isin(*KINDS)
    mark = F.concat(F.lit("<|"), kind, F.lit("_"), turn.cast("string"), F.lit("_"), index.cast("string"), F.lit("|>"))
    return F.struct(
        F.when(attached, mark).otherwise(escape(F.coalesce(part["text"], F.lit("")))).alias("out"),
        F.when(attached, F.struct(index.alias("part"), kind.alias("kind"), part["ref"].alias("ref"), mark.alias("mark"))).alias("attachment"),
        F.when(attached, F.greatest(F.coalesce(part["tokens"], F.lit(0)), F.lit(0))).otherwise(F.lit(0)).alias("tokens"),
    )


def text_part(text: Column) -> Column:
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("tokens")))


def format_turns(turns: DataFrame, parts: str | None = None) -> DataFrame:
    """One row per turn: its formatted string, which pieces carry loss, its attachments and their expanded tokens.

    ``turns`` has conv_id, turn, role, and text or a column ``parts`` of typed content parts. Null role, text or parts
    are empty; a null turn sorts first; repeated rows are repeated turns, ordered by turn, role and text. The strings
    of a conversation, one after the other, are its formatted text. Columns: conv_id, turn, role, head, body, tail (formatted
    is their concatenation), in_loss (the body of an assistant turn), attachments, attachment_tokens. A projection: a
    conversation of any size is never gathered here. Other columns are not read.
    """
    column = turns[parts] if parts else text_part(turns["text"])
    seen = F.transform(F.coalesce(column, F.array().cast(f"array<{PART}>")), lambda p, i: visit(p, i, F.coalesce(F.col("turn"), F.lit(0))))
    role = F.coalesce("role", F.lit(""))
    return (
        turns.withColumn("seen__", seen)
        .select(
            "conv_id",
            "turn",
            role.alias("role"),
            F.concat(F.lit(START), escape(role), F.lit(SEP)).alias("head"),
            F.array_join(F.transform("seen__", lambda x: x["out"]), "").alias("body"),
            F.lit(END).alias("tail"),
            (role == "assistant").alias("in_loss"),
            F.filter(F.transform("seen__", lambda x: x["attachment"]), lambda x: x.isNotNull()).alias("attachments"),
            F.aggregate("seen__", F.lit(0).cast("bigint"), lambda a, x: a + x["tokens"]).alias("attachment_tokens"),
        )
    )


def digests(formatted: DataFrame) -> DataFrame:
    """Read formatted turns back: one row per conversation with digests of roles, texts and the text under the loss mask.

    Rows are dealt by conversation and sorted, then read as a stream: a task holds one turn and two running digests,
    whatever the size of a conversation (a digest of a whole conversation has to be taken in its order).
    """
    text = F.concat("head", "body", "tail").alias("formatted")
    rows = (
        formatted.select("conv_id", "turn", "role", "body", text, "in_loss")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "body")
        .select("conv_id", "formatted", "in_loss")
    )
    kind = formatted.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"

    def run(batches):
        state, none, names = None, object(), [x.split()[0] for x in schema.split(", ")]
        at, id_type = none, pa.int64()
        for batch in batches:
            out, id_type = [], batch.column(0).type
            for conv, line, loss in zip(*(c.to_pylist() for c in batch.columns)):
                if at is none or conv != at:
                    if state:
                        out.append(state)
                    at, state = conv, [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                head, _, rest = line[len(START) :].partition(SEP)
                role, said = unescape(head), unescape(rest[: -len(END)])
                state[1] += 1
                state[2].update(f"{role}\n{said}\n".encode())
                if loss:
                    state[3] += len(said)
                    state[4].update(said.encode())
                state[5] += len(line)
            if out:
                yield table(out, names, id_type)
        if state:
            yield table([state], names, id_type)

    def table(rows, names, id_type):
        cols = [[r[0] for r in rows], [r[1] for r in rows], [r[2].hexdigest() for r in rows], [r[3] for r in rows], [r[4].hexdigest() for r in rows], [r[5] for r in rows]]
        kinds = [id_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

    return rows.mapInArrow(run, schema)
