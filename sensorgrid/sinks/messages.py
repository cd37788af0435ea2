"""Outgoing messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def encode(readings: DataFrame, src: Column, now: Column | None = None) -> DataFrame:
    """Kafka rows ``key, value``: the key is the sensor id, so one sensor stays on one
    partition; the value holds no derived fields.  Write with
    ``.write.format("kafka")`` or ``.writeStream.format("kafka")``."""
    sent = now if now is not None else F.current_timestamp()
    payload = F.struct(
        F.col("sensor_id").cast("string").alias("sensor_id"),
        F.col("count").alias("count"),
        F.unix_millis("ts").alias("ts"),
        src.alias("src"),
        F.unix_millis(sent).alias("ingest_ts"),
    )
    return readings.select(
        F.col("sensor_id").cast("string").alias("key"),
        F.to_json(payload, {"ignoreNullFields": "false"}).alias("value"),
    )
