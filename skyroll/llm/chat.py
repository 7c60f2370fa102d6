"""Operator 2, chat formatting by perspective rotation, in DataFrame expressions only.

Every participant of a conversation gets the dialogue with themselves as the
assistant and all others as users with a name. A rendered dialogue is its
segments, one a message, put together in order of seq; each row says where its
segment starts in that text and which part of it is to be learned. So a
conversation of any length stays spread over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyroll.llm.common import gapless_starts, table

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
#: Speakers that set the scene rather than take part, and the name of a speaker that is null.
SCENE, UNNAMED = ("system",), "unknown"
FIRST_TURN = -(2**63)


def rotate(df: DataFrame, conv: str = "conv_id", turn: str = "turn", speaker: str = "role", text: str = "text", scene: tuple[str, ...] = SCENE) -> DataFrame:
    """One row per conversation, participant and message.

    Columns: ``conv``, perspective (the participant), seq (from 0), role, name,
    segment, start, mask_from, mask_to. Offsets are code points of the whole
    rendered dialogue; the mask covers the text and end mark of the
    participant's own messages and is empty for others. Messages are in order of
    turn (null first) and, within one, of a hash of speaker and text. Speakers
    in ``scene`` keep their role in every perspective and have none of their own;
    a conversation of only those has no rows. A null speaker is "unknown", a null
    text empty, null conversations are one; repeated messages are repeated; other
    columns are ignored; an empty table gives no rows.
    """
    who = F.coalesce(df[speaker].cast("string"), F.lit(UNNAMED))
    said = F.coalesce(df[text].cast("string"), F.lit(""))
    messages = df.select(
        df[conv].alias("_conv"),
        F.coalesce(F.concat(F.lit("="), df[conv].cast("string")), F.lit("")).alias("_group"),
        F.coalesce(df[turn].cast("long"), F.lit(FIRST_TURN)).alias("_turn"),
        who.alias("_who"),
        said.alias("_said"),
        F.crc32(F.concat_ws("\n", who, said).cast("binary")).alias("_tie"),
    )
    participants = messages.where(~F.col("_who").isin(*scene)).select("_group", F.col("_who").alias("perspective")).distinct()
    rows = messages.join(participants, "_group")
    role = F.when(F.col("_who").isin(*scene), F.col("_who")).when(F.col("_who") == F.col("perspective"), F.lit("assistant")).otherwise(F.lit("user"))
    rows = rows.withColumn("role", role).withColumn("name", F.when(F.col("role") == "user", F.col("_who")))
    head = F.concat(F.lit(OPEN), F.col("role"), F.coalesce(F.concat(F.lit(" name="), F.col("name")), F.lit("")), F.lit("\n"))
    rows = rows.withColumn("_head", head).withColumn("segment", F.concat("_head", "_said", F.lit(CLOSE)))
    rows = rows.withColumn("_size", F.char_length("segment")).withColumn("_one", F.lit(1))
    placed = gapless_starts(rows, ["_group", "perspective"], "_turn", {"start": "_size", "seq": "_one"}, tie="_tie", then=("_who", "_said"))
    own = F.col("role") == "assistant"
    return placed.select(
        F.col("_conv").alias(conv),
        "perspective",
        "seq",
        "role",
        "name",
        "segment",
        "start",
        F.when(own, F.col("start") + F.char_length("_head")).otherwise(F.col("start")).alias("mask_from"),
        F.when(own, F.col("start") + F.col("_size") - 1).otherwise(F.col("start")).alias("mask_to"),
    )


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations from every participant's side."""
    return rotate(table(spark, sf_dir, "conversations"))


#: Ties of a turn by the crc32 of speaker and text, byte by byte with a table made from its polynomial.
OP2_SQL = """
WITH RECURSIVE bits(i, k, c) AS (
  SELECT i::BIGINT, 0, i::BIGINT FROM range(256) t(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8
),
crc_table AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
named AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS who, coalesce(text, '') AS said FROM conversations),
m AS (
  SELECT conv_id, turn, who, said, xor(list_reduce(
    list_concat([4294967295::BIGINT], list_transform(range(1, length(hx) // 2 + 1), lambda i: ('0x' || substr(hx, 2 * i - 1, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) AS tie
  FROM (SELECT *, hex(encode(who || chr(10) || said)) AS hx FROM named), crc_table
),
p AS (SELECT DISTINCT conv_id, who AS perspective FROM m WHERE who <> 'system'),
r AS (
  SELECT m.*, perspective,
    CASE WHEN who = 'system' THEN 'system' WHEN who = perspective THEN 'assistant' ELSE 'user' END AS role
  FROM m JOIN p ON m.conv_id IS NOT DISTINCT FROM p.conv_id
),
h AS (
  SELECT *, CASE WHEN role = 'user' THEN who END AS name,
    '<|im_start|>' || role || CASE WHEN role = 'user' THEN ' name=' || who ELSE '' END || chr(10) AS head
  FROM r
),
s AS (SELECT *, head || said || '<|im_end|>' || chr(10) AS segment FROM h),
o AS (
  SELECT *, row_number() OVER w - 1 AS seq, coalesce(sum(length(segment)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM s WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, tie, who, said)
)
SELECT conv_id, perspective, seq, role, name, segment, start,
  CASE WHEN role = 'assistant' THEN start + length(head) ELSE start END AS mask_from,
  CASE WHEN role = 'assistant' THEN start + length(segment) - 1 ELSE start END AS mask_to
FROM o
"""
