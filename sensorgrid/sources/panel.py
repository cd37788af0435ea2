"""Wide panels (one column per sensor) as long rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

TIME_COLUMNS = ("timestamp", "time")
CALENDAR_COLUMNS = ("date", "weekday")


def sensor_columns(wide: DataFrame, time_col: str) -> list[str]:
    return [c for c in wide.columns if c != time_col and c not in CALENDAR_COLUMNS]


def find_time_column(wide: DataFrame) -> str:
    for name in TIME_COLUMNS:
        if name in wide.columns:
            return name
    raise ValueError(f"no time column among {TIME_COLUMNS}")


def wide_to_long(wide: DataFrame, id_type: str = "bigint") -> DataFrame:
    """``bucket, sensor_id, value`` with one row per cell, of both forms of ``wide_panel``."""
    time_col = find_time_column(wide)
    if {"block", "sensors"} <= set(wide.columns) and wide.schema["sensors"].dataType.simpleString() == "array<string>":
        held = [c for c in wide.columns if c not in (time_col, "block", "sensors")]
        values = F.slice(F.array(*held), 1, F.size("sensors"))
        return wide.select(
            F.col(time_col).alias("bucket"), F.inline(F.arrays_zip(F.col("sensors").alias("id"), values.alias("v")))
        ).select("bucket", F.col("id").cast(id_type).alias("sensor_id"), F.col("v").cast("double").alias("value"))
    sensors = sensor_columns(wide, time_col)
    return wide.unpivot([time_col], sensors, "sensor_id", "value").select(
        F.col(time_col).alias("bucket"),
        F.col("sensor_id").cast(id_type).alias("sensor_id"),
        F.col("value").cast("double").alias("value"),
    )


def read_wide_panel(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    return wide_to_long(spark.read.parquet(path), id_type)
