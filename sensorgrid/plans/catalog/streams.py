"""Structured Streaming jobs over the events table as a file source.

Each query runs its stream to the end of the available data and returns the written table.
"""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F

from sensorgrid import sources
from sensorgrid.functions import from_utc_wall
from sensorgrid.operators import forecast as fc
from sensorgrid.plans.catalog import tables as t
from sensorgrid.plans.catalog.registry import query
from sensorgrid.staging import names_in, new_path, release, stage
from sensorgrid.streaming import (
    archive_stream,
    clear_window,
    open_bucket_stream,
    read_open,
    read_window,
    score_latest,
    snapshot_stream,
    write_snapshots,
)

ONCE = {"availableNow": True}
DELAY = "1 hour"


def message_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = t.table(spark, sf_dir, "events").schema
    rows = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf_dir)
        .withColumns({"ts": from_utc_wall(F.col("ts")), "k": F.get_json_object("props", "$.k").cast("int")})
    )
    return t.messages(spark, sf_dir, rows)


def _run_snapshots(spark: SparkSession, sf_dir: str, after_batch=None) -> str:
    path = new_path(spark, "live")
    stream = snapshot_stream(sources.decode(message_stream(spark, sf_dir)), "5m", DELAY)
    run = write_snapshots(stream, path, f"{path}/checkpoint", after_batch, ONCE)
    run.awaitTermination()
    return path


def _run_in_parts(spark: SparkSession, sf_dir: str, after_batch=None) -> str:
    """The events arrive as files of a few days each, one per micro-batch; the query is stopped
    after the first half of them and started again on the same checkpoint.  Many tasks read the
    table, and the one that writes a file gets only its rows."""
    path, inbox = new_path(spark, "live"), new_path(spark, "inbox")
    rows = t.table(spark, sf_dir, "events")
    for part in (F.day("ts") <= 15, F.day("ts") > 15):
        for days in range(3):
            rows.where(part & (F.floor((F.day("ts") - 1) / 5) % 3 == days)).repartition(1).write.mode("append").parquet(inbox)
        arriving = (
            spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(inbox)
            # Few tasks read a file; its messages are built and parsed by all.
            .repartition("event_id").withColumns({"ts": from_utc_wall(F.col("ts")), "k": F.get_json_object("props", "$.k").cast("int")})
        )
        stream = snapshot_stream(sources.decode(t.messages(spark, sf_dir, arriving)), "5m", DELAY)
        write_snapshots(stream, path, f"{path}/checkpoint", after_batch, ONCE).awaitTermination()
    return path


# Buckets that end no later than the highest message time minus the delay.
_CLOSED = """(SELECT * FROM (SELECT time_bucket(INTERVAL '5 minutes', make_timestamp(ms * 1000)) AS window_start,
    sensor AS node_id, CAST(format('{:.2f}', avg(num)) AS DOUBLE) AS flow, count(*) AS num_samples
    FROM usable GROUP BY 1, 2) WHERE window_start + INTERVAL 5 MINUTE <=
    (SELECT make_timestamp(max(ms) * 1000) - INTERVAL 1 HOUR FROM usable))"""


@query("snapshot_stream", f"SELECT * FROM {_CLOSED}", ("usable",))
def snapshots(spark, sf_dir):
    return read_window(spark, _run_snapshots(spark, sf_dir), None)


@query(
    "archive_stream",
    """SELECT CASE WHEN k = 5 THEN DATE '1970-01-01' ELSE CAST(stamp + INTERVAL 7 HOUR AS DATE) END AS dump_date,
        CAST(part AS INTEGER) AS kafka_partition, off AS kafka_offset,
        sensor AS sensor_id, txt AS count, ms AS ts FROM msgs WHERE k > 2""",
    ("msgs",),
)
def archive(spark, sf_dir):
    path = new_path(spark, "archive")
    run = archive_stream(
        message_stream(spark, sf_dir), f"{path}/data", f"{path}/checkpoint", t.TZ, "event", ONCE
    )
    run.awaitTermination()
    found = F.regexp_extract("file_path", "dump_date=([0-9-]+)", 1)
    rows = sources.read_archive(spark, f"{path}/data")
    return rows.select(
        F.to_date(found).alias("dump_date"), "kafka_partition", "kafka_offset", "sensor_id", "count", "ts"
    )


_SCORED = f"""(SELECT w AS timestamp, l.node_id, l.pos, CAST(h AS INTEGER) AS horizon,
    least(120.0, greatest(0.0, coalesce(s.flow, 0))) AS flow
    FROM (SELECT max(window_start) AS w FROM {_CLOSED}) CROSS JOIN linked l CROSS JOIN range(1, 4) r(h)
    LEFT JOIN {_CLOSED} s ON s.window_start = w AND s.node_id = l.node_id)"""


@query(
    "window_retention",
    f"""SELECT window_start, node_id, flow, num_samples FROM {_CLOSED}
        WHERE window_start IN (SELECT DISTINCT window_start FROM {_CLOSED} ORDER BY 1 DESC LIMIT 12)""",
    ("usable",),
)
def window_retention(spark, sf_dir):
    """The window table after many micro-batches: twelve windows and no more."""
    path = _run_in_parts(spark, sf_dir)
    if len(names_in(spark, f"{path}/window")) > 2:
        raise RuntimeError("old window tables were not deleted")
    return read_window(spark, path, 100)


@query("score_restart", f"SELECT * FROM {_SCORED}", ("usable", "linked"))
def score_restart(spark, sf_dir):
    """The one stored prediction after a restart in the middle of the stream."""
    nodes = stage(t.linked_nodes(spark, sf_dir), "nodes")
    hook = score_latest(lambda window: fc.forecast_persistence(window, nodes, steps=3, interval="5m", low=0, high=120))
    path = _run_in_parts(spark, sf_dir, hook)
    return spark.read.parquet(f"{path}/predictions").select("timestamp", "node_id", "pos", "horizon", "flow")


@query("score_stream", f"SELECT * FROM {_SCORED}", ("usable", "linked"))
def score(spark, sf_dir):
    nodes = stage(t.linked_nodes(spark, sf_dir), "nodes")
    hook = score_latest(lambda window: fc.forecast_persistence(window, nodes, steps=3, interval="5m", low=0, high=120))
    path = _run_snapshots(spark, sf_dir, hook)
    stored = spark.read.parquet(f"{path}/predictions")
    newest = stored.agg(F.max("timestamp").alias("m")).scalar()
    return (
        stored.where(F.col("timestamp") == newest)
        .select("timestamp", "node_id", "pos", "horizon", "flow")
        .distinct()
    )


PARTS = 6


def _by_offset(spark: SparkSession, sf_dir: str, path: str, after_batch=None, first=0, last=PARTS, initial=None, faults=0) -> None:
    """The messages arrive as one file per range of offsets, each a micro-batch; the query is
    stopped and started again half way, and also after each of so many faults.  Many tasks read the
    messages, and the one that writes a file gets only its rows."""
    inbox = new_path(spark, "inbox")
    rows = stage(t.messages(spark, sf_dir), "arriving")
    width = rows.agg(F.max("offset").alias("m")).first().m // PARTS + 1
    for part in range(first, last):
        rows.where(F.floor(F.col("offset") / width) == part).repartition(1).write.mode("append").parquet(inbox)
        while part in (first + (last - first) // 2, last - 1):
            arriving = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(inbox)
            run = open_bucket_stream(sources.decode(arriving), path, f"{path}/checkpoint-{first}", "5m", t.TZ, after_batch, ONCE, initial=initial)
            try:
                run.awaitTermination()
                break
            except StreamingQueryException:
                faults -= 1
                if faults < 0:
                    raise
    release(rows)


# Buckets in which late messages are counted with the open one, but for those still open.
_MONOTONE = """(SELECT window_start, sensor AS node_id, CAST(format('{:.2f}', avg(num)) AS DOUBLE) AS flow, count(*) AS num_samples
    FROM (SELECT *, max(window_start) OVER (PARTITION BY part) AS newest FROM (
        SELECT *, max(time_bucket(INTERVAL '5 minutes', make_timestamp(ms * 1000)))
            OVER (PARTITION BY part ORDER BY off ROWS UNBOUNDED PRECEDING) AS window_start FROM timed))
    WHERE window_start < newest AND sensor IS NOT NULL AND num IS NOT NULL GROUP BY 1, 2)"""


@query("open_bucket_stream", f"SELECT * FROM {_MONOTONE}", ("timed",))
def open_buckets(spark, sf_dir):
    """Late messages join the open bucket; six micro-batches, a restart after the fourth."""
    path = new_path(spark, "live")
    _by_offset(spark, sf_dir, path)
    return read_window(spark, path, None)


@query("open_bucket_handover", f"SELECT * FROM {_MONOTONE}", ("timed",))
def open_bucket_handover(spark, sf_dir):
    """A new query, with a checkpoint and tables of its own, takes the open buckets of the one before
    as its initial state."""
    paths = [new_path(spark, "live") for _ in range(2)]
    _by_offset(spark, sf_dir, paths[0], last=3)
    _by_offset(spark, sf_dir, paths[1], first=3, initial=read_open(spark, paths[0]))
    return read_window(spark, paths[0], None).unionByName(read_window(spark, paths[1], None))


@query("push_commit_fault", f"SELECT * FROM {_MONOTONE}", ("timed",))
def push_commit_fault(spark, sf_dir):
    """The third micro-batch fails after its push and before its commit, once; it is repeated."""
    path, failed = new_path(spark, "live"), []

    def fail_once(session: SparkSession, _: str, batch_id: int) -> None:
        if batch_id == 2 and not failed:
            failed.append(batch_id)
            raise RuntimeError("between push and commit")

    _by_offset(spark, sf_dir, path, fail_once, faults=1)
    if not failed:
        raise RuntimeError("nothing failed")
    return read_window(spark, path, None)


@query(
    "window_cleared",
    f"""SELECT window_start, node_id, flow, num_samples FROM {_MONOTONE} WHERE window_start IN (
        SELECT DISTINCT window_start FROM {_MONOTONE} WHERE window_start > (
            SELECT max(window_start) FROM (SELECT window_start, max(window_start) OVER (PARTITION BY part) AS newest FROM (
                SELECT part, max(time_bucket(INTERVAL '5 minutes', make_timestamp(ms * 1000)))
                    OVER (PARTITION BY part ORDER BY off ROWS UNBOUNDED PRECEDING) AS window_start
                FROM timed WHERE off // ((SELECT max(off) FROM msgs) // {PARTS} + 1) < 3)) WHERE window_start < newest)
        ORDER BY 1 DESC LIMIT 12)""",
    ("timed", "msgs"),
)
def window_cleared(spark, sf_dir):
    """The window after half of the messages is cleared; what is pushed later fills it again."""
    paths = [new_path(spark, "live") for _ in range(2)]
    _by_offset(spark, sf_dir, paths[0], last=3)
    state = stage(read_open(spark, paths[0]), "open")
    clear_window(spark, paths[0])
    if not read_window(spark, paths[0]).isEmpty():
        raise RuntimeError("the window was not cleared")
    _by_offset(spark, sf_dir, paths[0], first=3, initial=state)
    return read_window(spark, paths[0])
