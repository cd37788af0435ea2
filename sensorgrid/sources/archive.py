"""Message archives: JSON lines, one or more files per day, below a common prefix."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sensorgrid import schemas
from sensorgrid.functions import epoch_ms_to_ts, normalize_sensor_id
from sensorgrid.functions.once import fields_once
from sensorgrid.sources.dated import between_dates

#: Names of archive files: those of daily dumps, and those that Spark's text sink writes.
PATTERN = "*.{json,txt}"


def _options(reader, pattern: str):
    return reader.option("pathGlobFilter", pattern).option("recursiveFileLookup", True)


def read_archive(
    spark: SparkSession, prefix: str, pattern: str = PATTERN, since: date | None = None, until: date | None = None
) -> DataFrame:
    """Raw archived messages with their ``file_path``.  Lines that are not JSON objects keep
    their text in ``_corrupt`` and stop nothing; empty files and blank lines give no rows.

    With ``since`` or ``until``, files whose path names a date outside are not opened.
    """
    lines = between_dates(_options(spark.read, pattern).text(prefix), since, until)
    parsed = F.from_json(
        F.col("value"),
        schemas.ARCHIVED_MESSAGE,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": schemas.CORRUPT},
    )
    rows = lines.where(F.trim("value") != "").select(
        F.col("_metadata.file_path").alias("file_path"), "value"
    )
    return fields_once(rows, ["file_path"], parsed)


def _reject_reason() -> Column:
    return (
        F.when(F.col(schemas.CORRUPT).isNotNull(), "not an object")
        .when(F.coalesce(F.col("ts"), F.lit(0)) == 0, "no time")
        .when(normalize_sensor_id(F.col("sensor_id")).isNull(), "no sensor")
    )


def archive_rejects(messages: DataFrame) -> DataFrame:
    """Archived messages that are no readings, with their ``reason``."""
    return messages.withColumn("reason", _reject_reason()).where("reason is not null")


def as_readings(messages: DataFrame, source: str = "archive") -> DataFrame:
    """Archived messages in the layout of readings; those of ``archive_rejects`` are left out.

    Later offsets win.  Messages without an offset come before all others; equal offsets, of
    different partitions or dumps, are told apart by dump date, partition and time.
    """
    dumped = F.regexp_extract(F.col("file_path"), r"^.*(\d{4}-\d{2}-\d{2})", 1)
    place = F.lpad(F.coalesce(F.col("kafka_partition"), F.lit(0)).cast("string"), 9, "0")
    return messages.where(_reject_reason().isNull()).select(
        epoch_ms_to_ts(F.col("ts")).alias("ts"),
        normalize_sensor_id(F.col("sensor_id")).alias("sensor_id"),
        F.col("count").try_cast("double").alias("count"),
        F.lit(source).alias("source"),
        F.coalesce(F.col("kafka_offset"), F.lit(-1)).alias("seq"),
        F.concat_ws("/", dumped, place, F.lpad(F.col("ts").cast("string"), 16, "0")).alias("tie"),
    )


def empty_readings(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], schemas.READINGS)


def archive_files(spark: SparkSession, prefix: str, pattern: str = PATTERN) -> DataFrame:
    """One row per archive file: ``path, file_name, size`` (file contents are not read)."""
    listing = _options(spark.read.format("binaryFile"), pattern).load(prefix)
    return listing.select(
        "path",
        F.substring_index("path", "/", -1).alias("file_name"),
        F.col("length").alias("size"),
    )


def yesterday(as_of: date | None = None) -> date:
    return (as_of or date.today()) - timedelta(days=1)


def select_by_date(files: DataFrame, target: date | None = None, name: str = "file_name") -> DataFrame:
    """Files of one date: the exact archive name, or, if there is none, any name that
    contains the date."""
    day = F.lit(str(target or yesterday()))
    exact: Column = F.col(name) == F.concat(F.lit("kafka-dump-"), day, F.lit(".json"))
    has_exact = files.where(exact).limit(1).select(F.count(F.lit(1)).alias("n")).scalar() > 0
    return files.where(F.when(has_exact, exact).otherwise(F.contains(F.col(name), day)))


def validate_files(spark: SparkSession, prefix: str, pattern: str = PATTERN) -> DataFrame:
    """``path, file_name, size, valid``: a file is valid if it is not empty and its first line
    is blank or JSON.  Spark lists no empty files, so those are absent and never valid.

    Only the first block of each file is looked at.  A verdict per line instead of the line
    itself is carried to the aggregate, so it keeps fixed-size buffers and sorts nothing.
    """
    lines = _options(spark.read.format("text"), pattern).load(prefix)
    text = F.trim("value")
    first = (
        lines.where(F.col("_metadata.file_block_start") == 0)
        .select(
            F.col("_metadata.file_path").alias("file_path"),
            ((text == "") | F.try_parse_json(text).isNotNull()).alias("ok"),
            F.monotonically_increasing_id().alias("n"),
        )
        .groupBy("file_path")
        .agg(F.min_by("ok", "n").alias("ok"))
    )
    files = archive_files(spark, prefix, pattern)
    key = F.regexp_replace(F.col("file_path"), r"^file:/+", "file:/")
    return (
        files.withColumn("key", F.regexp_replace("path", r"^file:/+", "file:/"))
        .join(first.withColumn("key", key), "key", "left")
        .select(
            "path",
            "file_name",
            "size",
            ((F.col("size") > 0) & F.coalesce(F.col("ok"), F.lit(False))).alias("valid"),
        )
    )


def archive_stats(archived: DataFrame) -> DataFrame:
    """Per ``dump_date``: messages, files and the last broker offset.

    ``archived`` has ``dump_date, file_name, kafka_offset``.
    """
    return archived.groupBy("dump_date").agg(
        F.count(F.lit(1)).alias("messages"),
        F.count_distinct("file_name").alias("files"),
        F.max("kafka_offset").alias("last_offset"),
    )
