"""Continuous archive of valid messages as JSON lines, one folder per day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from sensorgrid.functions import epoch_ms_to_ts, local_date
from sensorgrid.sources.messages import split_valid


def archive_lines(messages: DataFrame, tz: str, date_from: str = "processing") -> DataFrame:
    """``value, dump_date`` of the valid messages.

    The payload keeps all its fields, known or not, on one line: valid JSON has line breaks only
    between its tokens, where a blank says the same.  Broker position and processing time are
    appended to the object.  ``date_from`` is ``processing`` (the day of archiving) or
    ``event`` (the day of the message).
    """
    valid, _ = split_valid(messages)
    body = F.btrim(F.translate(F.col("value").cast("string"), "\r\n\t", "   "))
    now = F.current_timestamp()
    if date_from == "processing":
        at: Column = now
    elif date_from == "event":
        at = epoch_ms_to_ts(F.get_json_object(body, "$.ts").try_cast("bigint"))
    else:
        raise ValueError(f"unknown archive date: {date_from}")
    meta = F.to_json(
        F.struct(
            F.col("partition").alias("kafka_partition"),
            F.col("offset").alias("kafka_offset"),
            F.unix_millis(F.col("timestamp")).alias("kafka_timestamp"),
            F.unix_millis(now).alias("dumper_timestamp"),
        )
    )
    opened = F.substring(body, F.lit(1), F.length(body) - 1)
    return valid.select(
        F.concat(opened, F.lit(","), F.substring(meta, F.lit(2), F.length(meta))).alias("value"),
        local_date(at, tz).alias("dump_date"),
    )


def archive_stream(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    tz: str,
    date_from: str = "processing",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Starts the archive.  The file sink's commit log makes a restart append exactly the
    messages that are not yet archived."""
    return (
        archive_lines(messages, tz, date_from)
        .writeStream.format("text")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy("dump_date")
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start()
    )
