"""Operator 3, sharding: jump consistent hashing puts stable keys into shards without a ring table."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from skyroll.llm.common import checkpointed, gapless_starts, ship, table

#: Stands for a null key, both for hashing and for order (nulls come first).
NULL_KEY = -(2**63)
#: Repeated rows are written back in pieces of so many.
PIECE = 10_000


def jump_hash(keys: np.ndarray, n_shards: int) -> np.ndarray:
    """Shard of each 64-bit key (Lamping and Veach 2014), for all keys at once."""
    state = keys.astype(np.uint64, copy=True)
    shard = np.zeros(len(state), dtype=np.int64)
    jump = np.zeros(len(state), dtype=np.int64)
    live = np.arange(len(state))
    while len(live):
        shard[live] = jump[live]
        state[live] = state[live] * np.uint64(2862933555777941757) + np.uint64(1)
        draw = (state[live] >> np.uint64(33)).astype(np.float64) + 1
        jump[live] = ((shard[live] + 1) * (2147483648.0 / draw)).astype(np.int64)
        live = live[jump[live] < n_shards]
    return shard


def shard_of(key, n_shards: int):
    """Column: jump hash of a long column."""

    @F.pandas_udf(LongType())
    def udf(values: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(values.to_numpy(np.int64), n_shards))

    return udf(F.coalesce(key, F.lit(NULL_KEY)))


def assign_shards(df: DataFrame, n_shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key, size, text_crc32, law, shard, slot, grown_shard.

    The key and the number of shards alone decide the shard, so adding a shard
    moves rows only into the new one. ``size`` is the text's UTF-8 bytes plus 8.
    ``slot`` counts the rows of a shard from 0 without gaps by (key, text_crc32,
    size). A null key counts as the smallest long, a null text as empty. Rows
    that repeat in key, crc and size take neighbouring slots. An empty table
    gives no rows; other columns are ignored.
    """
    ship(df.sparkSession)
    content = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(
        F.col(key).cast("long").alias("_key"),
        (F.octet_length(content).cast("long") + 8).alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"),
    )
    merged = rows.groupBy("_key", "size", "text_crc32").agg(F.count(F.lit(1)).alias("_n"))
    placed = merged.select(
        "*",
        F.coalesce("_key", F.lit(NULL_KEY)).alias("_order"),
        shard_of(F.col("_key"), n_shards).cast("int").alias("shard"),
        shard_of(F.col("_key"), n_shards + 1).cast("int").alias("grown_shard"),
    )
    started = gapless_starts(checkpointed(placed), ["shard"], "_order", {"_start": "_n"}, tie="text_crc32", then=("size",))
    zero = F.lit(0).cast("long")
    pieces = started.withColumn("_from", F.explode(F.sequence(zero, F.col("_n") - 1, F.lit(PIECE).cast("long"))))
    most = F.least(F.col("_n"), F.col("_from") + PIECE) - 1
    # a row repeated very often leaves its pieces to several tasks
    spread = pieces.repartition("_key", "text_crc32", "_from")
    return spread.withColumn("_i", F.explode(F.sequence(F.col("_from"), most))).select(
        F.col("_key").alias(key),
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        (F.col("_start") + F.col("_i")).alias("slot"),
        "grown_shard",
    )


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into 24 shards."""
    return assign_shards(table(spark, sf_dir, "documents"), 24)


#: Jump hash by a recursive query; crc32 byte by byte with a table made from its polynomial.
OP3_SQL = """
WITH RECURSIVE bits(i, k, c) AS (
  SELECT i::BIGINT, 0, i::BIGINT FROM range(256) t(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8
),
crc_table AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
keys AS (
  SELECT DISTINCT doc_id,
    CASE WHEN coalesce(doc_id, -9223372036854775808) < 0
      THEN coalesce(doc_id, -9223372036854775808)::HUGEINT + 18446744073709551616 ELSE doc_id::HUGEINT END AS h0
  FROM documents
),
jumps(doc_id, n, h, b, j) AS (
  SELECT doc_id, n, h0, -1::BIGINT, 0::BIGINT FROM keys, (VALUES (24), (25)) s(n)
  UNION ALL
  SELECT doc_id, n, h2, j, floor((j + 1) * (2147483648.0::DOUBLE / ((h2 // 8589934592) + 1)::DOUBLE))::BIGINT
  FROM (SELECT *, (h * 2862933555777941757 + 1) % 18446744073709551616 AS h2 FROM jumps WHERE j < n)
),
shards AS (
  SELECT doc_id, max(j) FILTER (WHERE n = 24 AND j < 24) AS shard, max(j) FILTER (WHERE n = 25 AND j < 25) AS grown_shard
  FROM jumps GROUP BY doc_id
),
sized AS (
  SELECT doc_id, (strlen(coalesce(text, '')) + 8)::BIGINT AS size,
    xor(list_reduce(
      [4294967295::BIGINT] || list_transform(range(strlen(coalesce(text, ''))),
        lambda i: ('0x' || substr(hx, 2 * i + 1, 2))::BIGINT),
      lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) AS text_crc32
  FROM (SELECT *, hex(encode(coalesce(text, ''))) AS hx FROM documents), crc_table
)
SELECT s.doc_id, s.size, s.text_crc32, 'key' AS law, k.shard::INT AS shard,
  row_number() OVER (PARTITION BY k.shard ORDER BY s.doc_id NULLS FIRST, s.text_crc32, s.size) - 1 AS slot,
  k.grown_shard::INT AS grown_shard
FROM sized s JOIN shards k ON s.doc_id IS NOT DISTINCT FROM k.doc_id
"""
