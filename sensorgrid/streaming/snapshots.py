"""Live snapshots: event-time buckets, the durable last-N window and the scoring trigger."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from sensorgrid.functions import epoch_ms_to_ts, parse_duration, round_half_even
from sensorgrid.operators.snapshots import last_n_snapshots, window_ready
from sensorgrid.sources.messages import accepted
from sensorgrid.staging import delete, names_in

SNAPSHOT_COLUMNS = "window_start TIMESTAMP, node_id STRING, flow DOUBLE, num_samples BIGINT"
SNAPSHOT_SCHEMA = f"{SNAPSHOT_COLUMNS}, batch_id BIGINT"


def _interval(text: str) -> str:
    return f"{parse_duration(text) // 1_000_000} seconds"


def snapshot_stream(
    decoded: DataFrame, interval: str = "5m", delay: str = "0 seconds", offset: str = "0 seconds"
) -> DataFrame:
    """``window_start, node_id, flow, num_samples`` of closed buckets (append mode).

    A bucket is closed when a message later than its end plus ``delay`` has been seen; later
    rows of it are dropped and counted by Spark.  ``offset`` shifts bucket borders for zones
    whose offset is no multiple of the interval.
    """
    rows = accepted(decoded).withColumn("event_time", epoch_ms_to_ts(F.col("ts")))
    return (
        rows.withWatermark("event_time", delay)
        .groupBy(
            F.window("event_time", _interval(interval), startTime=offset).alias("w"),
            F.col("sensor_id").cast("string").alias("node_id"),
        )
        .agg(F.avg("count").alias("mean"), F.count(F.lit(1)).alias("num_samples"))
        .select(
            F.col("w.start").alias("window_start"),
            "node_id",
            round_half_even(F.col("mean"), 2).alias("flow"),
            "num_samples",
        )
    )


def batches(spark: SparkSession, path: str) -> list[int]:
    """Batch ids with a folder below ``path``, in order."""
    found = [name.removeprefix("batch_id=") for name in names_in(spark, path) if name.startswith("batch_id=")]
    return sorted(int(name) for name in found)


def push_batch(path: str, keep: int) -> Callable[[DataFrame, int], None]:
    """Writes a batch to the table of snapshots, and the ``keep`` newest windows to the window
    table.  A repeated batch starts from the same state and replaces its own folders, so a retry
    never doubles rows; the state before it is kept for that, older ones are deleted."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{path}/snapshots/batch_id={batch_id}")
        pushed = spark.read.schema(SNAPSHOT_COLUMNS).parquet(f"{path}/snapshots/batch_id={batch_id}")
        earlier = [b for b in batches(spark, f"{path}/window") if b < batch_id]
        rows = pushed
        if earlier:
            state = spark.read.schema(SNAPSHOT_COLUMNS).parquet(f"{path}/window/batch_id={earlier[-1]}")
            rows = state.unionByName(pushed)
        last_n_snapshots(_not_cleared(spark, path, rows), keep).write.mode("overwrite").parquet(
            f"{path}/window/batch_id={batch_id}"
        )
        for old in earlier[:-1]:
            delete(spark, f"{path}/window/batch_id={old}")

    return write


def write_snapshots(
    snapshots: DataFrame,
    path: str,
    checkpoint: str,
    after_batch: Callable[[SparkSession, str, int], None] | None = None,
    trigger: dict | None = None,
    keep: int = 12,
) -> StreamingQuery:
    """Appends closed buckets to the table below ``path``, keeps the ``keep`` newest windows in a
    table of their own, and then calls ``after_batch``.  The work of a batch is bounded by the
    batch and these windows, however long the stream has run."""
    push = push_batch(path, keep)

    def run(batch: DataFrame, batch_id: int) -> None:
        push(batch, batch_id)
        if after_batch is not None:
            after_batch(batch.sparkSession, path, batch_id)

    return (
        snapshots.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .foreachBatch(run)
        .start()
    )


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _not_cleared(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    cleared = _read(spark, f"{path}/cleared", "upto TIMESTAMP")
    limit = cleared.agg(F.max("upto").alias("u")).scalar()
    return rows.where(limit.isNull() | (F.col("window_start") > limit))


def read_window(spark: SparkSession, path: str, n: int | None = 12) -> DataFrame:
    """Snapshot rows of the ``n`` newest windows that were not cleared, from the window table, so
    at most of those that the writer keeps; with None of all windows ever pushed."""
    if n is None:
        rows = _read(spark, f"{path}/snapshots", SNAPSHOT_SCHEMA).drop("batch_id")
    else:
        newest = batches(spark, f"{path}/window")[-1:]
        rows = _read(spark, f"{path}/window/batch_id={newest[0] if newest else 'none'}", SNAPSHOT_COLUMNS)
    rows = _not_cleared(spark, path, rows)
    return rows if n is None else last_n_snapshots(rows, n)


def clear_window(spark: SparkSession, path: str) -> None:
    """Forgets all windows pushed so far: a marker is written, no file is deleted."""
    newest = read_window(spark, path, 1).agg(F.max("window_start").alias("upto"))
    newest.where("upto IS NOT NULL").write.mode("append").parquet(f"{path}/cleared")


def score_latest(
    forecaster: Callable[[DataFrame], DataFrame], n: int = 12
) -> Callable[[SparkSession, str, int], None]:
    """Hook for ``write_snapshots``: if ``n`` windows are there, writes the forecast for the
    newest one as ``predictions/batch_id=<id>`` and deletes those of earlier batches.

    It reads the window table, not the batch, so a restarted query scores at once when the
    window was already full.  Readers take the row with the highest time stamp.
    """

    def run(spark: SparkSession, path: str, batch_id: int) -> None:
        window = read_window(spark, path, n)
        if window_ready(window, n).first()["ready"]:
            forecaster(window).write.mode("overwrite").parquet(
                f"{path}/predictions/batch_id={batch_id}"
            )
            for old in batches(spark, f"{path}/predictions"):
                if old < batch_id:
                    delete(spark, f"{path}/predictions/batch_id={old}")

    return run
