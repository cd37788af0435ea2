"""Nested history documents: ``{date: {sensor: {file name: {count, timestamp}}}}``.

The time of a record is carried in its file name.  ``read_history`` reads files in byte ranges
(``pieces``), so one file may hold all dates; documents that are rows of a table are parsed in one
piece each.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sensorgrid.functions import (
    epoch_ms_to_ts,
    filename_epoch_lenient,
    filename_epoch_strict,
    local_wall,
    normalize_sensor_id,
)
from sensorgrid.functions.once import with_once
from sensorgrid.sources.dated import between_dates
from sensorgrid.sources.pieces import history_parts


def read_documents(
    spark: SparkSession, path: str, since: date | None = None, until: date | None = None
) -> DataFrame:
    """One row ``value`` per JSON file below ``path``.

    With ``since`` or ``until``, files whose path names a date outside are not opened; files
    without a date in their path always are.
    """
    files = (
        spark.read.option("pathGlobFilter", "*.json")
        .option("recursiveFileLookup", True)
        .text(path, wholetext=True)
    )
    return between_dates(files, since, until)


def file_records(spark: SparkSession, path: str, since: date | None = None, until: date | None = None) -> DataFrame:
    """``history_records`` of all files below ``path``, read in byte ranges (runs jobs)."""
    parts = history_parts(spark, path, since, until)
    return _parsed(parts.select("date", "sensor", "filename", F.col("text").alias("_t3"), F.col("reason").alias("_r3")))


def read_history(
    spark: SparkSession, path: str, source: str = "history", since: date | None = None, until: date | None = None
) -> DataFrame:
    return _readings(file_records(spark, path, since, until).where("reason is null"), source)


def read_history_rejects(spark: SparkSession, path: str, since: date | None = None, until: date | None = None) -> DataFrame:
    """What ``read_history`` leaves out, as ``history_rejects``."""
    return _rejects(file_records(spark, path, since, until))


_LEVEL = "map<string,string>"
_RECORD = "struct<count: string, timestamp: array<int>>"


def history_records(docs: DataFrame, value: str = "value") -> DataFrame:
    """``date, sensor, filename, record, reason``: every record of every document, and every part
    that is none.

    ``reason`` is NULL for usable records; a document that does not parse, a cut off one for
    example, gives one row.  Empty documents and levels hold no records.  A document whose parts
    all have the expected shape is parsed at once; of others each level is parsed on its own, so a
    part of another shape costs that part and nothing beside it.
    """
    shape = F.from_json("_text", f"map<string,map<string,map<string,{_RECORD}>>>").alias("_dates")
    rows = with_once(docs.select(F.col(value).alias("_text")), shape)
    full = lambda fits: lambda m: m.isNotNull() & F.forall(F.map_values(m), fits)
    regular = F.coalesce(full(full(full(lambda r: r.isNotNull())))(F.col("_dates")), F.lit(False))

    def entries(m: Column, inner) -> Column:
        return F.flatten(F.transform(F.map_entries(m), lambda e: inner(e["key"], e["value"])))

    none = F.lit(None).cast("string")
    flat = entries(F.col("_dates"), lambda date_, sensors: entries(sensors, lambda sensor, files: F.transform(
        F.map_entries(files), lambda e: F.struct(date_.alias("date"), sensor.alias("sensor"), e["key"].alias("filename"), e["value"].alias("_record"), none.alias("_rest"))
    )))
    odd = F.array(F.struct(none.alias("date"), none.alias("sensor"), none.alias("filename"), F.lit(None).cast(_RECORD).alias("_record"), F.col("_text").alias("_rest")))
    found = rows.withColumn("_regular", regular).select(F.inline(F.when(F.col("_regular"), flat).otherwise(odd)))
    return _by_level(found)


def _by_level(found: DataFrame) -> DataFrame:
    """Records of regular documents as they are, and the texts ``_rest`` of others, level by level."""
    done = F.col("_record").isNotNull()
    level = lambda text: F.from_json(text, _LEVEL)
    rows = with_once(found, level("_rest").alias("_dates"))
    whole = rows.select(
        "_record", "sensor", "filename", F.col("date").alias("_date"), done.alias("_done"),
        F.when(~done & F.col("_dates").isNull(), "document is not an object").alias("_r1"), F.explode_outer("_dates").alias("date", "_t1"),
    ).where("_done or _r1 is not null or date is not null")
    days = with_once(whole, level("_t1").alias("_sensors")).select(
        "_record", "_done", "filename", F.coalesce("_date", "date").alias("date"), F.col("sensor").alias("_sensor"),
        F.coalesce("_r1", F.when(~F.col("_done") & F.col("_sensors").isNull(), "date is not an object")).alias("_r2"),
        F.explode_outer("_sensors").alias("sensor", "_t2"),
    ).where("_done or _r2 is not null or sensor is not null")
    sensors = with_once(days, level("_t2").alias("_files")).select(
        "_record", "_done", "date", F.coalesce("_sensor", "sensor").alias("sensor"), F.col("filename").alias("_name"),
        F.coalesce("_r2", F.when(~F.col("_done") & F.col("_files").isNull(), "sensor is not an object")).alias("_r3"),
        F.explode_outer("_files").alias("filename", "_t3"),
    ).where("_done or _r3 is not null or filename is not null")
    rows = with_once(
        sensors.select("_done", "date", "sensor", F.coalesce("_name", "filename").alias("filename"), "_r3", "_t3", F.col("_record").alias("_known")),
        F.from_json("_t3", _RECORD).alias("_parsed"),
    )
    none = ~F.col("_done") & (~F.coalesce(F.trim(F.col("_t3")).startswith("{"), F.lit(False)) | F.col("_parsed").isNull())
    reason = F.coalesce("_r3", F.when(none, "record is not an object"))
    return _checked(rows.withColumn("_record", F.coalesce("_known", "_parsed")), reason)


def _parsed(sensors: DataFrame) -> DataFrame:
    """Records from their text ``_t3``; rows with a reason ``_r3`` already are passed on."""
    fields = F.from_json("_t3", _RECORD).alias("_record")
    rows = with_once(sensors, fields, F.trim(F.col("_t3")).startswith("{").alias("_object"))
    none = ~F.coalesce("_object", F.lit(False)) | F.col("_record").isNull()
    return _checked(rows, F.coalesce("_r3", F.when(none, "record is not an object")))


def _checked(rows: DataFrame, reason: Column) -> DataFrame:
    count = F.col("_record.count")
    wrong = F.when(count.isNotNull() & count.try_cast("double").isNull(), "count is not a number")
    return rows.select(
        "date", "sensor", "filename",
        F.struct(count.try_cast("double").alias("count"), F.col("_record.timestamp").alias("timestamp")).alias("record"),
        F.coalesce(reason, wrong).alias("reason"),
    )


def _rejects(rows: DataFrame) -> DataFrame:
    late = F.when(filename_epoch_lenient(F.col("filename")).isNull(), "no time in the file name").when(
        normalize_sensor_id(F.col("sensor")).isNull(), "no sensor"
    )
    reason = F.coalesce(F.col("reason"), late)
    return rows.select("date", "sensor", "filename", reason.alias("reason")).where("reason is not null")


def history_rejects(docs: DataFrame, value: str = "value") -> DataFrame:
    """Side output: ``date, sensor, filename, reason`` of everything ``flatten_history`` leaves out."""
    return _rejects(history_records(docs, value))


def _records(docs: DataFrame, value: str) -> DataFrame:
    return history_records(docs, value).where("reason is null").drop("reason")


def _readings(records: DataFrame, source: str) -> DataFrame:
    epoch, sensor = filename_epoch_lenient(F.col("filename")), normalize_sensor_id(F.col("sensor"))
    return records.select("filename", "record", epoch.alias("epoch_ms"), sensor.alias("sensor_id")).where(
        "epoch_ms is not null and sensor_id is not null"
    ).select(
        epoch_ms_to_ts(F.col("epoch_ms")).alias("ts"),
        "sensor_id",
        F.coalesce(F.col("record.count"), F.lit(0.0)).alias("count"),
        F.lit(source).alias("source"),
        F.col("epoch_ms").alias("seq"),
        F.col("filename").alias("tie"),
    )


def flatten_history(docs: DataFrame, value: str = "value", source: str = "history") -> DataFrame:
    """Readings of all documents; what is left out is in ``history_rejects``.

    A missing count is 0; ``node_007`` is sensor 7.  ``seq`` is the epoch value; records of equal
    time and sensor are told apart by ``tie``, the file name.
    """
    return _readings(_records(docs, value), source)


def flatten_strict(
    docs: DataFrame, tz: str, value: str = "value", keep_skipped: bool = False
) -> DataFrame:
    """Records for replay: ``timestamp`` must be ``[hour, minute]`` and the name must hold a
    13-digit epoch.  With ``keep_skipped`` rejected records stay, with ``ok = false``."""
    clock: Column = F.col("record.timestamp")
    epoch = filename_epoch_strict(F.col("filename"))
    rows = _records(docs, value).select(
        "date",
        F.col("sensor").alias("sensor_id"),
        "filename",
        F.col("record.count").alias("count"),
        F.get(clock, 0).alias("hour"),
        F.get(clock, 1).alias("minute"),
        epoch.alias("unix_timestamp_ms"),
        F.date_format(local_wall(epoch_ms_to_ts(epoch), tz), "yyyy-MM-dd HH:mm:ss").alias(
            "datetime"
        ),
        ((F.coalesce(F.size(clock), F.lit(0)) == 2) & epoch.isNotNull()).alias("ok"),
    )
    return rows if keep_skipped else rows.where("ok").drop("ok")
