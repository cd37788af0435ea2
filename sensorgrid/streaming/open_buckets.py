"""Snapshots of buckets that never reopen: late messages join the open bucket.

The streaming form of ``monotone_buckets`` followed by ``snapshots``.  Each partition of the topic has
one open bucket, the highest seen so far.  A message belongs to the open bucket even if its own
time is earlier, so none is dropped and no watermark is needed; a bucket is closed, and pushed, when a
message of a later one arrives on its partition.

The state between micro-batches is small and kept in a table of its own: the open bucket of each
partition, and the sums of the sensors that reported in it.  Inside a micro-batch the order of a
partition is evaluated in pieces (``running_max``), so a partition with most of the messages is
no single task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from sensorgrid.functions import round_half_even
from sensorgrid.operators.sequence import monotone_buckets
from sensorgrid.sources.messages import is_sample
from sensorgrid.staging import delete, release, stage
from sensorgrid.streaming.snapshots import batches, push_batch

#: Sums of the open buckets.  A row without a sensor marks the open bucket of its partition.
OPEN_SCHEMA = "partition INT, bucket TIMESTAMP, node_id STRING, total DOUBLE, num_samples BIGINT"


def add_messages(state: DataFrame, messages: DataFrame, interval: str, tz: str) -> DataFrame:
    """``state`` after ``messages``: sums of all buckets, those that are closed now included."""
    open_now = state.groupBy("partition").agg(F.max("bucket").alias("_open"))
    placed = monotone_buckets(messages, interval, tz).join(F.broadcast(open_now), "partition", "left")
    # One row a partition of the topic is broadcast.
    bucket = F.greatest("bucket", "_open")
    value = F.when(is_sample(), F.col("count").try_cast("double"))
    sums = placed.groupBy(
        F.col("partition").cast("int").alias("partition"), bucket.alias("bucket"),
        F.when(value.isNotNull(), F.col("sensor_id").cast("string")).alias("node_id"),
    ).agg(F.coalesce(F.sum(value), F.lit(0.0)).alias("total"), F.count(value).alias("num_samples"))
    return state.unionByName(sums).groupBy("partition", "bucket", "node_id").agg(
        F.sum("total").alias("total"), F.sum("num_samples").alias("num_samples")
    )


def split_open(sums: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Snapshot rows of the closed buckets, and the state of the open ones."""
    newest = sums.groupBy("partition").agg(F.max("bucket").alias("_open"))
    rows = sums.join(F.broadcast(newest), "partition")
    closed = rows.where("bucket < _open and num_samples > 0").select(
        F.col("bucket").alias("window_start"), "node_id",
        round_half_even(F.col("total") / F.col("num_samples"), 2).alias("flow"), "num_samples",
    )
    return closed, rows.where("bucket = _open").drop("_open")


def open_bucket_stream(
    decoded: DataFrame,
    path: str,
    checkpoint: str,
    interval: str = "5m",
    tz: str = "UTC",
    after_batch: Callable[[SparkSession, str, int], None] | None = None,
    trigger: dict | None = None,
    keep: int = 12,
    initial: DataFrame | None = None,
) -> StreamingQuery:
    """Pushes closed buckets of a message stream as ``write_snapshots`` does, and keeps the open ones.

    Offsets of a partition must grow from one micro-batch to the next, as a broker's do, and the
    messages of a sensor come on one partition, as keyed messages do; a sensor on two of them has
    a snapshot row for each.  ``initial`` is a state (``read_open``) to start from where there is none
    below ``path``.  A repeated micro-batch starts from the state before it and replaces its own
    folders, so a failure between push and commit neither loses nor doubles a message.
    """
    push = push_batch(path, keep)

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        earlier = [b for b in batches(spark, f"{path}/open") if b < batch_id]
        if earlier:
            state = spark.read.schema(OPEN_SCHEMA).parquet(f"{path}/open/batch_id={earlier[-1]}")
        else:
            state = initial if initial is not None else spark.createDataFrame([], OPEN_SCHEMA)
        sums = stage(add_messages(state, batch, interval, tz), "open-buckets")
        closed, still_open = split_open(sums)
        still_open.write.mode("overwrite").parquet(f"{path}/open/batch_id={batch_id}")
        push(closed, batch_id)
        release(sums)
        for old in earlier[:-1]:
            delete(spark, f"{path}/open/batch_id={old}")
        if after_batch is not None:
            after_batch(spark, path, batch_id)

    return (
        decoded.writeStream.option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .foreachBatch(run)
        .start()
    )


def read_open(spark: SparkSession, path: str) -> DataFrame:
    """The state of the open buckets below ``path``; empty if there is none."""
    newest = batches(spark, f"{path}/open")[-1:]
    if not newest:
        return spark.createDataFrame([], OPEN_SCHEMA)
    return spark.read.schema(OPEN_SCHEMA).parquet(f"{path}/open/batch_id={newest[0]}")
