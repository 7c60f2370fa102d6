"""Kafka row contract: keyed publish (producer / backfill side) and reads.

No Kafka client jar ships with this environment, so these stay thin: they build
the exact rows Spark's Kafka source/sink exchanges (``key, value, topic,
partition, offset, timestamp``); tests drive the same contract through files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyroll.functions.text import event_key
from skyroll.operators.parse import strip_space
from skyroll.functions.time import iso_text


def _json_value(c: Column) -> Column:
    """A column as a JSON literal (string quoted and escaped, NULL as null)."""
    return F.regexp_extract(F.to_json(F.array(c)), r"^\[(.*)\]$", 1)


def enrich_line(line: Column, fields: dict[str, Column]) -> Column:
    """The original JSON object text with ``fields`` appended as its last keys.
    Readers that keep the last of duplicate keys (Python ``json``, Spark
    ``from_json``) see the new values, and every other field is forwarded as is."""
    s = strip_space(line)
    add = [F.concat(F.lit(f'"{k}":'), _json_value(v)) for k, v in fields.items()]
    tail = F.concat_ws(",", *add)
    empty = s.rlike(r"^\{\s*\}$")
    return F.when(empty, F.concat(F.lit("{"), tail, F.lit("}"))).otherwise(
        F.concat(F.regexp_replace(s, r"\}$", ""), F.lit(","), tail, F.lit("}")))


def publish_rows(parsed: DataFrame, extra_fields: dict[str, Column] | None = None) -> DataFrame:
    """Keyed messages for parsed observations: key ``station|iso(dt)``. The
    value is the original line with the resolved ``station`` (and tags such as
    ``ingestion_mode``) set, as the source system forwards the enriched
    object; without a ``line`` column the typed fields are serialised instead."""
    extra = dict(extra_fields or {})
    key = event_key(F.col("station"), F.col("dt")).cast("binary").alias("key")
    if "line" in parsed.columns:
        value = enrich_line(F.col("line"), {"station": F.col("station"), **extra})
        return parsed.select(key, value.cast("binary").alias("value"))
    fields = [F.col(c) for c in parsed.columns if c not in ("dt", "arrival", "station_dir", "file_name")]
    fields = [iso_text(F.col("dt")).alias("dt")] + fields
    for name, v in extra.items():
        fields.append(v.alias(name))
    return parsed.select(key, F.to_json(F.struct(*fields)).cast("binary").alias("value"))


def write_kafka(messages: DataFrame, servers: str, topic: str) -> None:
    """Batch publish; the Spark Kafka sink is idempotent-producer capable and a
    failed write fails the job, so marks are saved only after it returns."""
    (messages.write.format("kafka").option("kafka.bootstrap.servers", servers)
     .option("topic", topic).option("kafka.acks", "all")
     .option("kafka.enable.idempotence", "true").save())


def read_kafka_range(spark: SparkSession, servers: str, topic: str, starting: str = "earliest",
                     ending: str = "latest") -> DataFrame:
    """Batch read of an offset range (``startingOffsets``/``endingOffsets`` may be
    JSON per partition, the batch twin of an explicit partition assignment)."""
    return (spark.read.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic).option("startingOffsets", starting)
            .option("endingOffsets", ending).load())


def assign_stream(spark: SparkSession, servers: str, assignment_json: str, starting_json: str) -> DataFrame:
    """Stream from explicit partitions and start offsets (``assign``)."""
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("assign", assignment_json).option("startingOffsets", starting_json).load())
