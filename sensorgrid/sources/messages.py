"""Live messages in the layout of Spark's Kafka source
(``key, value, topic, partition, offset, timestamp``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sensorgrid import schemas
from sensorgrid.functions.once import fields_once, with_once

REQUIRED = ("sensor_id", "count", "ts")


def kafka_stream(
    spark: SparkSession, servers: str, topic: str, starting: str = "earliest", **options: str
) -> DataFrame:
    """Kafka topic as a stream; needs the Kafka connector on the class path."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    return reader.options(**options).load()


def _text(value: str) -> Column:
    return F.col(value).cast("string")


def with_reject_reason(messages: DataFrame, value: str = "value") -> DataFrame:
    """Adds ``reject_reason``: NULL for a JSON object that holds all required keys (a key
    with a null value counts as present)."""
    keys = F.json_object_keys(_text(value))
    missing = F.array_except(F.array(*[F.lit(k) for k in REQUIRED]), keys)
    reason = F.when(keys.isNull(), F.lit("not an object")).when(
        F.size(missing) > 0, F.concat(F.lit("missing "), F.array_join(missing, ","))
    )
    return with_once(messages, reason.alias("reject_reason"))


def split_valid(messages: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Valid messages, and the rejected ones with their reason."""
    checked = with_reject_reason(messages, value)
    valid = checked.where(F.col("reject_reason").isNull()).drop("reject_reason")
    return valid, checked.where(F.col("reject_reason").isNotNull())


def decode(messages: DataFrame, value: str = "value") -> DataFrame:
    """Message fields beside the broker columns."""
    parsed = F.from_json(_text(value), schemas.MESSAGE)
    return fields_once(messages, ["partition", "offset", "timestamp"], parsed)


def has_time() -> Column:
    return F.coalesce(F.col("ts"), F.lit(0)) != 0


def is_sample() -> Column:
    return F.col("sensor_id").isNotNull() & F.col("count").try_cast("double").isNotNull()


def accepted(decoded: DataFrame) -> DataFrame:
    """Messages that count in an aggregate, with a numeric ``count``."""
    return decoded.where(has_time() & is_sample()).withColumn(
        "count", F.col("count").cast("double")
    )


def enrich(messages: DataFrame, now: Column | None = None) -> DataFrame:
    """Archive rows: message fields, broker position and processing time in epoch ms."""
    return decode(messages).select(
        "sensor_id",
        "count",
        "ts",
        "src",
        "ingest_ts",
        F.col("partition").cast("int").alias("kafka_partition"),
        F.col("offset").cast("bigint").alias("kafka_offset"),
        F.unix_millis("timestamp").alias("kafka_timestamp"),
        F.unix_millis(now if now is not None else F.current_timestamp()).alias("dumper_timestamp"),
    )
