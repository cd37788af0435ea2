"""From raw readings to a regular panel.

``cells(sensor_id, bucket, value)`` holds observed cells only.  A dense panel adds the null
cells of every observed bucket; those are generated from the gaps between observed cells, so
no product of buckets and sensors is ever joined.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from sensorgrid.functions import floor_to, iso_weekday, local_date, time_of_day
from sensorgrid.operators.indexing import canonical_nodes

#: Sensors of a wide row; more are laid out in blocks of so many.
WIDTH = 1000


def history_window(readings: DataFrame, as_of: datetime, days: int | None) -> DataFrame:
    """Readings of the last ``days`` before ``as_of``; all of them if days is None or 0."""
    if not days:
        return readings
    return readings.where(F.col("ts") >= F.lit(as_of) - F.make_interval(days=F.lit(days)))


def union_readings(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def dedup_last(readings: DataFrame, sources: tuple[str, ...] = ("history", "archive")) -> DataFrame:
    """One reading per ``(ts, sensor_id)``: the one of the last source in ``sources``, and
    within a source the one of the highest ``seq``, then of the highest ``tie`` (if there is such
    a column), then of the highest count.  Other sources rank below all of them.

    The order is total, so the result does not depend on the order of rows.  An aggregate with
    small buffers, so duplicates are reduced before the shuffle and a key with very many copies
    is no problem.
    """
    place = F.coalesce(*[F.when(F.col("source") == s, i) for i, s in enumerate(sources, start=1)], F.lit(0))
    tie = [F.col("tie")] if "tie" in readings.columns else []
    rank = F.struct(place.alias("place"), "seq", *tie, F.col("count").alias("amount"))
    best = F.max_by(F.struct("count", "source", "seq"), rank).alias("best")
    label = F.when(F.col("best.source").isin(*sources), F.col("best.source")).otherwise("other")
    return readings.where("seq is not null").groupBy("ts", "sensor_id").agg(best).select(
        "ts", "sensor_id", "best.count", label.alias("source"), "best.seq"
    )


def resample(readings: DataFrame, interval: str, tz: str) -> DataFrame:
    """``cells``: mean count per local-time bucket and sensor."""
    return (
        readings.select("sensor_id", floor_to(F.col("ts"), interval, tz).alias("bucket"), "count")
        .groupBy("sensor_id", "bucket")
        .agg(F.avg("count").alias("value"), F.count("count").alias("samples"))
    )


def time_of_day_filter(cells: DataFrame, tz: str, start: str, end: str) -> DataFrame:
    """Buckets whose local time of day lies in ``[start, end]`` (``"HH:MM"``)."""

    def seconds(text: str) -> int:
        hours, minutes = text.split(":")
        return int(hours) * 3600 + int(minutes) * 60

    return cells.where(
        time_of_day(F.col("bucket"), tz).between(seconds(start), seconds(end))
    )


def with_calendar(df: DataFrame, tz: str, time: str = "bucket") -> DataFrame:
    """Adds ``local_date``, ISO ``weekday`` and ``tod`` (seconds since local midnight)."""
    day = local_date(F.col(time), tz)
    return df.withColumns(
        {
            "local_date": day,
            "weekday": iso_weekday(day),
            "tod": time_of_day(F.col(time), tz),
        }
    )


def bucket_index(cells: DataFrame, tz: str) -> DataFrame:
    """The observed buckets: ``bucket, local_date, weekday, tod, pos, day_first, day_last``.

    ``pos`` numbers the buckets over the whole period; a day covers the positions
    ``day_first .. day_last``.  The table has one row per bucket, whatever the data volume: the
    buckets of a day are collected as a set before the shuffle, and only the table of days is
    ordered in one task.
    """
    before = Window.orderBy("local_date").rowsBetween(Window.unboundedPreceding, -1)
    days = (
        cells.groupBy(local_date(F.col("bucket"), tz).alias("local_date"))
        .agg(F.sort_array(F.collect_set("bucket")).alias("_buckets"))
        .withColumn("day_first", F.coalesce(F.sum(F.size("_buckets")).over(before), F.lit(0)))
    )
    return days.select(
        "local_date",
        iso_weekday(F.col("local_date")).alias("weekday"),
        "day_first",
        (F.col("day_first") + F.size("_buckets") - 1).alias("day_last"),
        F.posexplode("_buckets").alias("_i", "bucket"),
    ).select(
        "bucket",
        "local_date",
        "weekday",
        time_of_day(F.col("bucket"), tz).alias("tod"),
        (F.col("day_first") + F.col("_i")).alias("pos"),
        "day_first",
        "day_last",
    )


def sensors(cells: DataFrame) -> DataFrame:
    return cells.select("sensor_id").distinct()


def dense_panel(cells: DataFrame, buckets: DataFrame) -> DataFrame:
    """``sensor_id, bucket, value``: every observed bucket of every observed sensor."""
    from sensorgrid.operators.gaps import find_gaps, gap_cells

    observed = cells.where("value IS NOT NULL").select("sensor_id", "bucket", "value")
    missing = gap_cells(find_gaps(cells, buckets), buckets).select(
        "sensor_id", "bucket", F.lit(None).cast("double").alias("value")
    )
    return observed.unionByName(missing)


def wide_panel(
    cells: DataFrame, columns: list | None = None, key: str = "sensor_id", value: str = "value", width: int = WIDTH
) -> DataFrame:
    """Export form: one row per bucket, one column per sensor in text order (runs jobs).

    Without ``columns`` all sensors of the cells are taken.  If they are more than ``width``, there is
    a row per bucket and block of sensors: ``timestamp, block, sensors`` and the columns ``c0, c1, ..``
    of the sensors listed in ``sensors``, so the plan does not grow with the sensors and their names
    do not pass the driver.  Raises if the cells hold a sensor that is not listed.
    """
    ids = cells.select(F.col(key).cast("string").alias(key)).where(F.col(key).isNotNull()).distinct()
    if columns is None:
        columns = [row[0] for row in ids.limit(width + 1).collect()]
        if len(columns) > width:
            return _wide_blocks(cells, ids, key, value, width)
    else:
        listed = cells.sparkSession.createDataFrame([(str(c),) for c in columns], f"`{key}` string")
        extra = ids.join(listed, key, "left_anti").limit(5).collect()
        if extra:
            raise ValueError(f"sensors that are not among the columns: {[row[0] for row in extra]}")
    names = sorted({str(c) for c in columns})
    return (
        cells.select("bucket", F.col(key).cast("string").alias(key), value)
        .groupBy("bucket")
        .pivot(key, names)
        .agg(F.avg(value))
        .withColumnRenamed("bucket", "timestamp")
    )


def _wide_blocks(cells: DataFrame, ids: DataFrame, key: str, value: str, width: int) -> DataFrame:
    place = F.floor(F.col("pos") / width).cast("int")
    order = canonical_nodes(ids, key).select(
        F.col("node_id").alias(key), place.alias("block"), (F.col("pos") % width).cast("int").alias("slot")
    )
    listed = F.transform(F.array_sort(F.collect_list(F.struct("slot", key))), lambda x: x[key])
    names = order.groupBy("block").agg(listed.alias("sensors"))
    top = order.agg(F.max("block").alias("b")).first().b
    rows = cells.select("bucket", F.col(key).cast("string").alias(key), F.col(value).alias("value")).join(order, key)
    # Every bucket has a row in every block, also where none of its sensors has a cell.
    blank = cells.select("bucket").distinct().select(
        "bucket", F.explode(F.sequence(F.lit(0), F.lit(top))).alias("block"),
        F.lit(None).cast("int").alias("slot"), F.lit(None).cast("double").alias("value"),
    )
    rows = rows.select("bucket", "block", "slot", "value").unionByName(blank)
    # One shuffle of the cells; the wide buffers of the pivot are made after it.
    wide = rows.repartition("bucket", "block").groupBy("bucket", "block").pivot("slot", list(range(width))).agg(F.avg("value"))
    wide = wide.toDF("timestamp", "block", *[f"c{i}" for i in range(width)])
    return wide.join(names, "block").select("timestamp", "block", "sensors", *wide.columns[2:])
