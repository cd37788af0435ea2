"""Operators that depend on the order of records, without one task per key.

A key may hold a large share of all records, so every order is evaluated in bounded pieces:
first inside a piece, then over a table with one row per piece.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sensorgrid.functions import floor_to, parse_duration

PIECE = 100_000
HOUR_MS = 3_600_000


def running_max(
    df: DataFrame, key: str, order: str, value: Column, out: str, inclusive: bool = True, piece: int = PIECE
) -> DataFrame:
    """Adds the maximum of ``value`` over the records of ``key`` up to this one.

    ``order`` is a unique non-negative integer within the key (a broker offset); a piece
    covers ``piece`` consecutive order values.
    """
    rows = df.withColumns({"_v": value, "_piece": F.floor(F.col(order) / piece)})
    per_piece = rows.groupBy(key, "_piece").agg(F.max("_v").alias("_max"))
    before = Window.partitionBy(key).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_piece.select(key, "_piece", F.max("_max").over(before).alias("_carry"))
    last = 0 if inclusive else -1
    inside = (
        Window.partitionBy(key, "_piece").orderBy(order).rowsBetween(Window.unboundedPreceding, last)
    )
    return (
        rows.withColumn("_inside", F.max("_v").over(inside))
        .join(carry, [key, "_piece"])
        .withColumn(out, F.greatest("_inside", "_carry"))
        .drop("_v", "_piece", "_inside", "_carry")
    )


def monotone_buckets(messages: DataFrame, interval: str, tz: str) -> DataFrame:
    """Bucket each message is counted in when buckets never reopen: a late message joins the
    bucket that is open on its partition.  Messages without a time are left out."""
    timed = messages.where(F.coalesce(F.col("ts"), F.lit(0)) != 0)
    own = floor_to(F.timestamp_millis("ts"), interval, tz)
    return running_max(
        timed.withColumn("own_bucket", own), "partition", "offset", F.col("own_bucket"), "bucket"
    ).withColumn("late", F.col("bucket") > F.col("own_bucket"))


def late_rows(messages: DataFrame, interval: str, tz: str, delay: str) -> DataFrame:
    """Messages whose bucket was closed when they arrived: it ends no later than the highest
    earlier time on the partition minus ``delay``."""
    timed = messages.where(F.coalesce(F.col("ts"), F.lit(0)) != 0)
    end = F.unix_millis(floor_to(F.timestamp_millis("ts"), interval, tz)) + parse_duration(interval) // 1000
    seen = running_max(timed, "partition", "offset", F.col("ts"), "_seen", inclusive=False)
    return seen.where(end <= F.col("_seen") - parse_duration(delay) // 1000).drop("_seen")


def replay_schedule(readings: DataFrame, speed: float = 20.0) -> DataFrame:
    """Replay plan by time stamp: ``ts_ms, records, gap_ms, sleep_s, simulated_s, replay_s``.

    Records of one time stamp are sent together after ``sleep_s``.  The order is taken inside
    each hour (at most 3.6 million distinct stamps) and across hours on a table of hours.
    """
    if speed <= 0:
        raise ValueError("speed must be positive")
    stamps = (
        readings.groupBy(F.unix_millis("ts").alias("ts_ms"))
        .agg(F.count(F.lit(1)).alias("records"))
        .withColumn("_hour", F.floor(F.col("ts_ms") / HOUR_MS))
    )
    hours = stamps.groupBy("_hour").agg(F.max("ts_ms").alias("_last"), F.min("ts_ms").alias("_first"))
    chain = Window.orderBy("_hour")
    carry = hours.select(
        "_hour",
        F.lag("_last").over(chain).alias("_before"),
        F.min("_first").over(chain.rowsBetween(Window.unboundedPreceding, 0)).alias("_start"),
    )
    inside = Window.partitionBy("_hour").orderBy("ts_ms")
    previous = F.coalesce(F.col("_prev"), F.col("_before"))
    gap = F.coalesce(F.col("ts_ms") - previous, F.lit(0))
    simulated = (F.col("ts_ms") - F.col("_start")) / F.lit(1000.0)
    return (
        stamps.withColumn("_prev", F.lag("ts_ms").over(inside))
        .join(carry, "_hour")
        .select(
            "ts_ms",
            "records",
            gap.alias("gap_ms"),
            (gap / F.lit(1000.0) / F.lit(speed)).alias("sleep_s"),
            simulated.alias("simulated_s"),
            (simulated / F.lit(speed)).alias("replay_s"),
        )
    )


def span_stats(readings: DataFrame, speed: float = 20.0) -> DataFrame:
    """Records, first and last time, span in hours and estimated replay time in minutes."""
    span_ms = F.unix_millis("last_ts") - F.unix_millis("first_ts")
    return readings.agg(
        F.count(F.lit(1)).alias("records"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")
    ).select(
        "*",
        (span_ms / F.lit(3_600_000.0)).alias("span_hours"),
        (span_ms / F.lit(60_000.0) / F.lit(speed)).alias("replay_minutes"),
    )


def ordered_readings(readings: DataFrame) -> DataFrame:
    """Total order by time; sensor and ``seq`` break ties, so equal times still spread over
    range partitions."""
    return readings.orderBy("ts", "sensor_id", "seq")
