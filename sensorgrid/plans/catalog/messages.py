"""Live messages, their archive, snapshots and the alignment of the last-N window."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from sensorgrid import sinks, sources
from sensorgrid.functions import local_date, to_utc_wall
from sensorgrid.operators import evaluate as ev
from sensorgrid.operators import forecast as fc
from sensorgrid.operators import sequence as sq
from sensorgrid.operators import snapshots as sn
from sensorgrid.plans.catalog import tables as t
from sensorgrid.plans.catalog.registry import query
from sensorgrid.staging import new_path, stage
from sensorgrid.streaming import archive_lines

HOUR = "1h"


def decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.decode(t.messages(spark, sf_dir))


def snapshot_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly snapshots, written once like the durable table they stand for."""
    return stage(sn.snapshots(decoded(spark, sf_dir), HOUR, t.TZ), "snapshots")


_DECODED = """CAST(part AS INTEGER) AS partition, off AS "offset", stamp AS timestamp,
    CASE WHEN k > 1 THEN sensor END AS sensor_id, CASE WHEN k > 2 THEN txt END AS count,
    CASE WHEN k > 1 THEN ms END AS ts, CASE WHEN k > 1 THEN 'e_' || event_id END AS src,
    CASE WHEN k > 1 THEN epoch_us(stamp) // 1000 END AS ingest_ts"""


@query("decode_messages", f"SELECT {_DECODED} FROM msgs", ("msgs",))
def decode_messages(spark, sf_dir):
    return decoded(spark, sf_dir)


@query(
    "validate_messages",
    """SELECT CAST(part AS INTEGER) AS partition, off AS "offset",
        CASE WHEN k IN (0, 1) THEN 'not an object' WHEN k = 2 THEN 'missing count' END AS reject_reason
        FROM msgs""",
    ("msgs",),
)
def validate_messages(spark, sf_dir):
    return sources.with_reject_reason(t.messages(spark, sf_dir)).select("partition", "offset", "reject_reason")


@query(
    "accept_messages",
    'SELECT CAST(part AS INTEGER) AS partition, off AS "offset", sensor AS sensor_id, num AS count, ms AS ts FROM usable',
    ("usable",),
)
def accept_messages(spark, sf_dir):
    return sources.accepted(decoded(spark, sf_dir)).select("partition", "offset", "sensor_id", "count", "ts")


@query(
    "enrich_messages",
    """SELECT sensor AS sensor_id, txt AS count, ms AS ts, 'e_' || event_id AS src,
        epoch_us(stamp) // 1000 AS ingest_ts, CAST(part AS INTEGER) AS kafka_partition,
        off AS kafka_offset, epoch_us(stamp) // 1000 AS kafka_timestamp,
        1735689600000 AS dumper_timestamp FROM msgs WHERE k > 2""",
    ("msgs",),
)
def enrich_messages(spark, sf_dir):
    valid, _ = sources.split_valid(t.messages(spark, sf_dir))
    return sources.enrich(valid, now=F.timestamp_millis(F.lit(1735689600000)))


@query(
    "encode_messages",
    """SELECT CAST(user_id AS VARCHAR) AS key, '{"sensor_id":"' || user_id || '","count":' || value
        || ',"ts":' || epoch_us(ts) // 1000 || ',"src":"e_' || event_id || '","ingest_ts":1735689600000}'
        AS value FROM events""",
)
def encode_messages(spark, sf_dir):
    rows = t.events(spark, sf_dir).withColumnsRenamed({"user_id": "sensor_id", "value": "count"})
    src = F.concat(F.lit("e_"), F.col("event_id").cast("string"))
    return sinks.encode(rows, src, now=F.timestamp_millis(F.lit(1735689600000)))


@query(
    "scan_jsonl_archive",
    """SELECT make_timestamp(ms * 1000) AS ts, CASE WHEN k <> 7 THEN user_id END AS sensor_id,
        num AS count, off AS seq, 'archive' AS source FROM msgs WHERE k > 2 AND k NOT IN (5, 7)""",
    ("msgs",),
)
def scan_jsonl_archive(spark, sf_dir):
    path = new_path(spark, "archive")
    lines = archive_lines(t.messages(spark, sf_dir), t.TZ, date_from="event")
    lines.write.partitionBy("dump_date").text(path)
    return sources.as_readings(sources.read_archive(spark, path)).drop("tie")


@query(
    "archive_rejects",
    """SELECT off AS kafka_offset, CASE WHEN k = 5 THEN 'no time' ELSE 'no sensor' END AS reason
        FROM msgs WHERE k IN (5, 7)""",
    ("msgs",),
)
def archive_rejects(spark, sf_dir):
    path = new_path(spark, "archive")
    archive_lines(t.messages(spark, sf_dir), t.TZ, date_from="event").write.partitionBy("dump_date").text(path)
    return sources.archive_rejects(sources.read_archive(spark, path)).select("kafka_offset", "reason")


@query(
    "archive_roundtrip",
    """SELECT make_timestamp(ms * 1000) AS ts, user_id AS sensor_id, num AS count, off AS seq
        FROM msgs WHERE k > 2 AND k NOT IN (5, 7)""",
    ("msgs",),
)
def archive_roundtrip(spark, sf_dir):
    """Messages with line breaks inside and behind them, archived, landed twice and read."""
    text = F.regexp_replace(F.col("value").cast("string"), ',"ts"', ',\n "ts"')
    rows = t.messages(spark, sf_dir).withColumn("value", F.concat(text, F.lit("\n")).cast("binary"))
    dumped, landed = new_path(spark, "archive"), new_path(spark, "landed")
    archive_lines(rows, t.TZ, date_from="event").write.partitionBy("dump_date").text(dumped)
    files = sources.validate_files(spark, dumped)
    lines = spark.read.option("recursiveFileLookup", True).text(dumped)
    path = F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:/")
    for _ in range(2):
        sinks.land_archives(lines.select(path.alias("path"), "value"), files, landed)
    return sources.as_readings(sources.read_archive(spark, landed)).select("ts", "sensor_id", "count", "seq")


@query(
    "archive_stats",
    """SELECT CAST(CASE WHEN k = 5 THEN DATE '1970-01-01' ELSE CAST(stamp + INTERVAL 7 HOUR AS DATE) END
        AS DATE) AS dump_date, count(*) AS messages, count(DISTINCT part) AS files,
        max(off) AS last_offset FROM msgs WHERE k > 2 GROUP BY 1""",
    ("msgs",),
)
def archive_stats(spark, sf_dir):
    valid, _ = sources.split_valid(t.messages(spark, sf_dir))
    rows = sources.enrich(valid).select(
        local_date(F.timestamp_millis("ts"), t.TZ).alias("dump_date"),
        F.concat(F.lit("kafka-dump-"), F.col("kafka_partition").cast("string")).alias("file_name"),
        "kafka_offset",
    )
    return sources.archive_stats(rows)


_FILES = """(SELECT CASE event_type WHEN 'click' THEN 'kafka-dump-' || d || '.json'
        WHEN 'view' THEN 'kafka-dump-' || d || 'x.json'
        WHEN 'error' THEN 'backup-' || d || '.json' ELSE event_type || '.json' END AS file_name,
        count(*) AS size FROM (SELECT event_type, strftime(ts, '%Y-%m-%d') AS d FROM events) GROUP BY 1)"""


def file_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive listing derived from the events: one file per kind and day, sized by its rows."""
    day = F.date_format("ts", "yyyy-MM-dd")
    name = (
        F.when(F.col("event_type") == "click", F.concat(F.lit("kafka-dump-"), day, F.lit(".json")))
        .when(F.col("event_type") == "view", F.concat(F.lit("kafka-dump-"), day, F.lit("x.json")))
        .when(F.col("event_type") == "error", F.concat(F.lit("backup-"), day, F.lit(".json")))
        .otherwise(F.concat("event_type", F.lit(".json")))
    )
    return (
        t.table(spark, sf_dir, "events").groupBy(name.alias("file_name")).agg(F.count(F.lit(1)).alias("size"))
    )


@query("archive_select", f"SELECT * FROM {_FILES} WHERE file_name = 'kafka-dump-2024-01-15.json'")
def archive_select(spark, sf_dir):
    return sources.select_by_date(file_list(spark, sf_dir), date(2024, 1, 15))


@query(
    "archive_select_fallback",
    f"SELECT * FROM {_FILES} WHERE file_name NOT LIKE 'kafka-dump-____-__-__.json' AND contains(file_name, '2024-01-15')",
)
def archive_select_fallback(spark, sf_dir):
    files = file_list(spark, sf_dir).where("file_name <> 'kafka-dump-2024-01-15.json'")
    return sources.select_by_date(files, date(2024, 1, 15))


@query(
    "archive_partition",
    f"""SELECT file_name, CASE WHEN regexp_matches(file_name, '^kafka-dump-[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}\\.json$')
        THEN substr(file_name, 12, 10) ELSE 'unknown' END AS partition FROM {_FILES}""",
)
def archive_partition(spark, sf_dir):
    files = file_list(spark, sf_dir)
    return files.select("file_name", sinks.partition_key(F.col("file_name")).alias("partition"))


@query(
    "ingest_summary",
    f"""SELECT count(*) AS files, count(*) FILTER (WHERE ok) AS landed, count(*) FILTER (WHERE NOT ok) AS errors,
        CAST(sum(size) FILTER (WHERE ok) AS BIGINT) AS bytes,
        round(count(*) FILTER (WHERE ok) * 100.0 / count(*), 6) AS success_pct
        FROM (SELECT *, file_name LIKE 'kafka-dump-%' AS ok FROM {_FILES})""",
)
def ingest_summary(spark, sf_dir):
    return sinks.ingest_summary(file_list(spark, sf_dir), F.startswith("file_name", F.lit("kafka-dump-")))


@query(
    "archive_validate",
    """SELECT CAST(stamp + INTERVAL 7 HOUR AS DATE) AS dump_date,
        day(stamp + INTERVAL 7 HOUR) % 7 <> 0 AS valid FROM msgs GROUP BY 1, 2""",
    ("msgs",),
)
def archive_validate(spark, sf_dir):
    """Files of every seventh day hold no JSON."""
    path = new_path(spark, "dumps")
    day = local_date(F.col("timestamp"), t.TZ)
    rows = t.messages(spark, sf_dir).select(
        F.when(F.day(day) % 7 == 0, F.concat(F.lit("broken "), F.col("offset").cast("string")))
        .otherwise(F.to_json(F.struct("offset")))
        .alias("value"),
        day.alias("dump_date"),
    )
    rows.write.partitionBy("dump_date").text(path)
    checked = sources.validate_files(spark, path)
    found = F.regexp_extract("path", "dump_date=([0-9-]+)", 1)
    return checked.groupBy(F.to_date(found).alias("dump_date")).agg(F.bool_and("valid").alias("valid"))


_SNAP_5M = """SELECT time_bucket(INTERVAL '5 minutes', make_timestamp(ms * 1000)) AS window_start,
    sensor AS node_id, CAST(format('{:.2f}', avg(num)) AS DOUBLE) AS flow, count(*) AS num_samples
    FROM usable GROUP BY 1, 2"""


@query("snapshot_agg", _SNAP_5M, ("usable",))
def snapshot_agg(spark, sf_dir):
    return sn.snapshots(decoded(spark, sf_dir), "5m", t.TZ)


@query(
    "snapshot_totals",
    """SELECT time_bucket(INTERVAL '5 minutes', make_timestamp(ms * 1000)) AS window_start,
        count(DISTINCT CASE WHEN num IS NOT NULL THEN sensor END) AS total_nodes,
        count(*) AS num_messages,
        count(*) FILTER (WHERE num IS NOT NULL AND sensor IS NOT NULL) AS num_valid
        FROM timed GROUP BY 1""",
    ("timed",),
)
def snapshot_totals(spark, sf_dir):
    return sn.snapshot_totals(decoded(spark, sf_dir), "5m", t.TZ)


_MONOTONE = """(SELECT *, max(own) OVER (PARTITION BY part ORDER BY off ROWS UNBOUNDED PRECEDING) AS bucket,
    max(ms) OVER (PARTITION BY part ORDER BY off ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen
    FROM (SELECT *, time_bucket(INTERVAL '5 minutes', make_timestamp(ms * 1000)) AS own FROM timed))"""


@query(
    "monotone_buckets",
    f"""SELECT CAST(part AS INTEGER) AS partition, off AS "offset", own AS own_bucket, bucket,
        bucket > own AS late FROM {_MONOTONE}""",
    ("timed",),
)
def monotone_buckets(spark, sf_dir):
    return sq.monotone_buckets(decoded(spark, sf_dir), "5m", t.TZ).select(
        "partition", "offset", "own_bucket", "bucket", "late"
    )


@query(
    "late_rows",
    f"""SELECT CAST(part AS INTEGER) AS partition, off AS "offset", ms AS ts FROM {_MONOTONE}
        WHERE epoch_us(own) // 1000 + 300000 <= seen - 3600000""",
    ("timed",),
)
def late_rows(spark, sf_dir):
    return sq.late_rows(decoded(spark, sf_dir), "5m", t.TZ, "1h").select("partition", "offset", "ts")


_LAST = "(SELECT DISTINCT window_start FROM snaps ORDER BY 1 DESC LIMIT 12)"


@query(
    "last_n_snapshots",
    f"SELECT window_start, node_id, flow, num_samples FROM snaps WHERE window_start IN {_LAST}",
    ("snaps",),
)
def last_n_snapshots(spark, sf_dir):
    return sn.last_n_snapshots(snapshot_table(spark, sf_dir))


@query(
    "window_ready",
    f"""SELECT count(*) AS current, count(*) >= 12 AS ready,
        round((epoch(max(window_start)) - epoch(min(window_start))) / 60.0, 6) AS span_minutes FROM {_LAST}""",
    ("snaps",),
)
def window_ready(spark, sf_dir):
    return sn.window_ready(snapshot_table(spark, sf_dir))


@query(
    "window_metadata",
    """SELECT max(window_start) AS last_update, 12 AS window_size,
        max(window_start) AS snapshot_timestamp FROM snaps""",
    ("snaps",),
)
def window_metadata(spark, sf_dir):
    return sn.window_metadata(snapshot_table(spark, sf_dir))


@query("discover_nodes", "SELECT DISTINCT node_id FROM snaps", ("snaps",))
def discover_nodes(spark, sf_dir):
    return sn.discover_nodes(snapshot_table(spark, sf_dir))


_ALIGNED = """SELECT w.window_start, l.pos, coalesce(s.flow, 0) AS flow,
        (SELECT count(*) FROM snaps u WHERE u.window_start = w.window_start
            AND NOT EXISTS (SELECT 1 FROM linked m WHERE m.node_id = u.node_id)) AS unknown,
        (SELECT count(*) FROM linked m WHERE NOT EXISTS (SELECT 1 FROM snaps u
            WHERE u.window_start = w.window_start AND u.node_id = m.node_id)) AS missing
        FROM (SELECT DISTINCT window_start FROM snaps) w CROSS JOIN linked l
        LEFT JOIN snaps s ON s.window_start = w.window_start AND s.node_id = l.node_id"""


@query("align_to_nodes", _ALIGNED, ("snaps", "linked"))
def align_to_nodes(spark, sf_dir):
    return sn.align_long(snapshot_table(spark, sf_dir), stage(t.linked_nodes(spark, sf_dir), "nodes"))


@query("input_blocks", _ALIGNED, ("snaps", "linked"))
def input_blocks(spark, sf_dir):
    """The stored form, in small blocks, taken apart again."""
    rows = sn.input_blocks(snapshot_table(spark, sf_dir), stage(t.linked_nodes(spark, sf_dir), "nodes"), 64)
    flow = F.transform(F.sequence(F.lit(0), F.col("flows.size") - 1), lambda i: F.coalesce(
        F.get("flows.values", F.array_position("flows.indices", i).cast("int") - 1), F.lit(0.0)))
    return rows.select("window_start", "block", "unknown", "missing", F.posexplode(flow).alias("i", "flow")).select(
        "window_start", (F.col("block") * 64 + F.col("i")).alias("pos"), "flow", "unknown", "missing"
    )


@query("aligned_arrays", _ALIGNED, ("snaps", "linked"))
def aligned_arrays(spark, sf_dir):
    """The export form, an array per window, taken apart again."""
    aligned = sn.align_to_nodes(snapshot_table(spark, sf_dir), stage(t.linked_nodes(spark, sf_dir), "nodes"))
    return aligned.select(
        "window_start", F.posexplode("flows").alias("pos", "flow"), "unknown", "missing"
    ).withColumn("pos", F.col("pos").cast("bigint"))


@query(
    "unknown_sensors",
    """SELECT window_start, count(*) AS unknown FROM snaps
        WHERE NOT EXISTS (SELECT 1 FROM linked m WHERE m.node_id = snaps.node_id) GROUP BY 1""",
    ("snaps", "linked"),
)
def unknown_sensors(spark, sf_dir):
    return sn.unknown_sensors(snapshot_table(spark, sf_dir), t.linked_nodes(spark, sf_dir))


@query(
    "missing_sensors",
    """SELECT w.window_start, count(*) AS missing FROM (SELECT DISTINCT window_start FROM snaps) w
        CROSS JOIN linked l LEFT JOIN snaps s ON s.window_start = w.window_start AND s.node_id = l.node_id
        WHERE s.node_id IS NULL GROUP BY 1""",
    ("snaps", "linked"),
)
def missing_sensors(spark, sf_dir):
    return sn.missing_sensors(snapshot_table(spark, sf_dir), t.linked_nodes(spark, sf_dir))


_PERSIST = """(SELECT w AS timestamp, w + INTERVAL 1 HOUR * h AS target_ts, l.node_id, l.pos,
    CAST(h AS INTEGER) AS horizon, least(120.0, greatest(0.0, coalesce(s.flow, 0))) AS flow
    FROM (SELECT max(window_start) AS w FROM snaps) CROSS JOIN linked l CROSS JOIN range(1, 13) r(h)
    LEFT JOIN snaps s ON s.window_start = w AND s.node_id = l.node_id)"""


def persistence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fc.forecast_persistence(
        snapshot_table(spark, sf_dir), t.linked_nodes(spark, sf_dir), steps=12, interval=HOUR, low=0, high=120
    )


@query("forecast_persistence", f"SELECT * FROM {_PERSIST}", ("snaps", "linked"))
def forecast_persistence(spark, sf_dir):
    return persistence(spark, sf_dir)


@query(
    "format_predictions",
    f"SELECT timestamp, node_id, flow FROM {_PERSIST} WHERE horizon = 1",
    ("snaps", "linked"),
)
def format_predictions(spark, sf_dir):
    return sn.format_predictions(persistence(spark, sf_dir)).select(
        "timestamp", F.explode("data").alias("node_id", "flow")
    )


@query(
    "prediction_stats",
    f"""SELECT count(flow) AS n, round(avg(flow), 6) AS mean, round(stddev_pop(flow), 6) AS std,
        min(flow) AS min, max(flow) AS max FROM {_PERSIST}""",
    ("snaps", "linked"),
)
def prediction_stats(spark, sf_dir):
    return ev.prediction_stats(persistence(spark, sf_dir))


@query(
    "latest_prediction",
    """SELECT 'ok' AS status, strftime(window_start, '%Y-%m-%dT%H:%M:%S') AS timestamp, node_id, flow
        FROM snaps WHERE window_start = (SELECT max(window_start) FROM snaps)""",
    ("snaps",),
)
def latest_prediction(spark, sf_dir):
    """Every snapshot is stored as a prediction payload; the newest one is served."""
    stored = (
        snapshot_table(spark, sf_dir)
        .groupBy("window_start")
        .agg(F.map_from_entries(F.collect_list(F.struct("node_id", "flow"))).alias("data"))
        .select(
            F.col("window_start").alias("timestamp"),
            F.to_json(
                F.struct(
                    F.date_format(to_utc_wall(F.col("window_start")), "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
                    "data",
                )
            ).alias("payload"),
        )
    )
    return sources.latest_prediction(stored).select(
        "status", "timestamp", F.explode("data").alias("node_id", "flow")
    )
