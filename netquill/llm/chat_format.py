"""Operator 2, chat formatting by multi-party perspective rotation, in DataFrame functions only.

For every participant of a conversation the dialogue is rendered once with that speaker as the
assistant: own turns become ``assistant`` segments, with training mask 1; turns of others become
``user`` segments that carry the speaker's name, mask 0; ``system`` turns stay context in every
perspective, mask 0, and are nobody's perspective.

The result has one row for each conversation, perspective and turn, with the rendered segment, its mask
and its place (turn number, speaker, hash of the text); the segments of a perspective in order of
``place`` are the dialogue. Text and names cannot forge a marker: a bar is added to every ``<|`` in
them, and taking one from every ``<||`` gives them back. So a conversation
of any length, even one that holds a third of all rows, stays many small rows and is never gathered in
one task. :func:`dialogues` joins the segments into one string and a list of masked character spans for
conversations that are known to be small.

Defined results for odd input: rows with a null conv_id belong to no conversation and are left out; a
null or blank role is the speaker ``unknown``; roles are compared trimmed of white space and in lower
case, with one space for white space inside; a null text
renders as an empty turn; turns without a number come first, repeated numbers are ordered by role and
text, and equal rows share a place; a conversation with system turns alone gives no rows; an empty
table gives an empty table; other columns are not read.

Scale: participants are counted with map-side combine, written, and joined back by conv_id, where the
engine splits a hot conversation; rows grow with turns times participants, which the task asks for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netquill.llm.common import table, written

OPEN, CLOSE = "<|turn|>", "<|end|>"


def _escaped(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("<||"))


def _speaker(role: Column) -> Column:
    name = F.lower(F.trim(F.regexp_replace(role, r"[\x20\x09-\x0D]+", " ")))
    return F.when(name.isNull() | (name == ""), F.lit("unknown")).otherwise(name)


def rotate(conversations: DataFrame) -> DataFrame:
    """(conv_id, perspective, place, turn, speaker, segment, mask, n_chars) for every perspective."""
    turns = conversations.filter("conv_id is not null").select(
        "conv_id", "turn", _speaker(F.col("role")).alias("speaker"), F.coalesce("text", F.lit("")).alias("text")
    )
    people = written(
        turns.filter("speaker != 'system'").select("conv_id", F.col("speaker").alias("perspective")).distinct(),
        "chat_people",
    )
    own = F.col("speaker") == F.col("perspective")
    header = (
        F.when(own, F.lit("assistant"))
        .when(F.col("speaker") == "system", F.lit("system"))
        .otherwise(F.concat(F.lit("user name="), _escaped(F.col("speaker"))))
    )
    place = F.struct(
        F.coalesce(F.col("turn").cast("long"), F.lit(-(1 << 62))).alias("turn"), "speaker", F.sha2("text", 256).alias("text")
    )
    return turns.join(people, "conv_id").select(
        "conv_id",
        "perspective",
        place.alias("place"),
        "turn",
        "speaker",
        F.concat(F.lit(OPEN), header, F.lit("\n"), _escaped(F.col("text")), F.lit(CLOSE)).alias("segment"),
        own.cast("int").alias("mask"),
        F.length("text").alias("n_chars"),
    )


def dialogues(segments: DataFrame) -> DataFrame:
    """(conv_id, perspective, dialogue, spans): segments joined in order, and the character spans
    (start, end) that count for training. For conversations of bounded size."""
    grouped = segments.groupBy("conv_id", "perspective").agg(
        F.array_sort(F.collect_list(F.struct("place", "segment", "mask"))).alias("s")
    )
    spans = F.aggregate(
        "s",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans")),
        lambda a, x: F.struct(
            (a.at + F.length(x.segment)).alias("at"),
            F.when(
                x["mask"] == 1,
                F.concat(a.spans, F.array(F.struct(a.at.alias("start"), (a.at + F.length(x.segment)).alias("end")))),
            )
            .otherwise(a.spans)
            .alias("spans"),
        ),
        lambda a: a.spans,
    )
    return grouped.select(
        "conv_id", "perspective", F.array_join(F.transform("s", lambda x: x.segment), "").alias("dialogue"), spans.alias("spans")
    )


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, perspective, turn, speaker, text_sha256 (these three are the place), segment, mask and n_chars
    of every conversation, perspective and turn."""
    out = rotate(table(spark, sf_dir, "conversations"))
    return out.select("conv_id", "perspective", "turn", "speaker", F.col("place.text").alias("text_sha256"), "segment", "mask", "n_chars")


ORACLE_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(nullif(lower(trim(regexp_replace(role, '[\x20\x09-\x0D]+', ' ', 'g'))), ''), 'unknown') AS speaker, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), p AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> 'system')
SELECT t.conv_id, p.perspective, t.turn, t.speaker, sha256(t.text) AS text_sha256,
       '<|turn|>' || CASE WHEN t.speaker = p.perspective THEN 'assistant' WHEN t.speaker = 'system' THEN 'system'
                     ELSE 'user name=' || replace(t.speaker, '<|', '<||') END || chr(10) || replace(t.text, '<|', '<||') || '<|end|>' AS segment,
       CAST(t.speaker = p.perspective AS INTEGER) AS mask, CAST(length(t.text) AS INTEGER) AS n_chars
FROM t JOIN p ON t.conv_id = p.conv_id
"""
