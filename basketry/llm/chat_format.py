"""Chat formatting with Spark expressions: turns are collected as structs, sorted, neighbours of one role merged, and rendered.

The template:  <|im_start|>ROLE<|im_sep|>TEXT<|im_next|>TEXT<|im_end|>  and a line feed after each message. A message holds
the neighbouring turns of one role. Inside roles and texts every ``<|`` becomes ``<\\|`` (one backslash more for each there
already), so a control string in a text never reads as one and the way back is exact.

Conversations of any length are first formatted by blocks of turns, so that no turn row of a long one meets all others;
only the rendered blocks of a conversation come together.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, NEXT, END = "<|im_start|>", "<|im_sep|>", "<|im_next|>", "<|im_end|>\n"
BLOCK = 512


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def _rendered(turns: str) -> Column:
    """Pieces of sorted turns, each with its runs outside and under the loss mask. The first turn's opening and the last one's end depend on the neighbours and are added later."""
    return F.expr(f"""transform({turns}, (t, i) -> struct(
        t.role AS role,
        CASE WHEN i = 0 THEN '' WHEN {turns}[i - 1].role = t.role THEN '{NEXT}' ELSE concat('{END.strip()}', '\\n', '{START}', t.role, '{SEP}') END AS opening,
        t.text AS text))""")


def format_chats(turns: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """``conv_id, formatted, loss_runs, n_messages``: one row for each conversation of ``turns`` (``conv_id, turn, role, text``).

    ``loss_runs`` are the lengths, in code points, of the parts of ``formatted`` that are outside and under the loss mask
    by turns, beginning outside; each text of ``trained_role`` is one part under it. Turns are ordered by turn (nulls
    first), then role, then text, so ties and repeated rows are kept and come out alike every time. A null role or text is
    empty. A null conversation id is a conversation of its own. Only the four columns are read.
    """
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), escape(role).alias("role"), escape(text).alias("text"))
    blocks = rows.groupBy("conv_id", F.floor(F.col("turn") / BLOCK).alias("block")).agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    blocks = blocks.withColumn("pieces", _rendered("turns")).select(
        "conv_id",
        F.struct(
            "block",
            F.expr("pieces[0].role").alias("first_role"),
            F.expr("element_at(pieces, -1).role").alias("last_role"),
            F.expr("array_join(transform(pieces, p -> concat(p.opening, p.text)), '')").alias("body"),
            F.expr(f"size(filter(pieces, p -> p.opening LIKE '%{START}%'))").alias("changes"),
            F.expr("transform(pieces, p -> struct(char_length(p.opening) AS outside, char_length(p.text) AS inside, p.role AS role))").alias("runs"),
        ).alias("b"),
    )
    whole = blocks.groupBy("conv_id").agg(F.sort_array(F.collect_list("b")).alias("bs"))
    joints = F.expr(f"""transform(bs, (b, i) -> CASE WHEN i > 0 AND bs[i - 1].last_role = b.first_role THEN '{NEXT}'
        ELSE concat(CASE WHEN i > 0 THEN concat('{END.strip()}', '\\n') ELSE '' END, '{START}', b.first_role, '{SEP}') END)""")
    whole = whole.withColumn("joints", joints)
    spelled = F.expr("flatten(transform(bs, (b, i) -> transform(b.runs, (r, j) -> struct(r.outside + IF(j = 0, char_length(joints[i]), 0) AS outside, r.inside AS inside, r.role AS role))))")
    return whole.withColumn("runs", spelled).withColumn("trained", escape(F.lit(trained_role))).select(
        "conv_id",
        F.concat(F.expr("array_join(transform(bs, (b, i) -> concat(joints[i], b.body)), '')"), F.lit(END)).alias("formatted"),
        F.expr(f"""concat(flatten(transform(runs, r -> IF(r.role = trained, array(r.outside, r.inside), array(r.outside + r.inside, 0)))), array({len(END)}))""").alias("loss_runs"),
        F.expr(f"aggregate(bs, 0L, (n, b) -> n + b.changes) + size(filter(joints, j -> j LIKE '%{START}%'))").cast("long").alias("n_messages"),
    )


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The turns (role, text) of a formatted conversation."""
    out = []
    for message in formatted.split(START)[1:]:
        role, body = message[: -len(END)].split(SEP, 1)
        out += [(unescape(role), unescape(text)) for text in body.split(NEXT)]
    return out


def masked(formatted: str, loss_runs: list[int]) -> list[str]:
    """The texts under the loss mask, unescaped. Parts of no length are told from turns outside by nothing, and add nothing."""
    at, out = 0, []
    for i, n in enumerate(loss_runs):
        if i % 2 and n:
            out.append(unescape(formatted[at : at + n]))
        at += n
    return out


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_messages long"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for conv, formatted, runs, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            turns, loss = read_back(formatted), "".join(masked(formatted, runs))
            told = "".join(f"{role}\n{text}\n" for role, text in turns)
            rows.append((conv, len(turns), hashlib.sha256(told.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(formatted), n))
        names = [c.split()[0] for c in DIGEST.split(", ")]
        types = [pa.string() if c.endswith("string") else pa.int64() for c in DIGEST.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)


def digests(formatted: DataFrame) -> DataFrame:
    """What ``format_chats`` wrote, read back from the formatted text and its mask, as counts and SHA-256 digests."""
    return formatted.select(F.col("conv_id").cast("long").alias("conv_id"), "formatted", "loss_runs", "n_messages").mapInArrow(_digests, DIGEST)
