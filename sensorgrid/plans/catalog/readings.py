"""Scans, projections and the resampled panel."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from sensorgrid import functions as fn
from sensorgrid.operators import panel as p
from sensorgrid.operators import quality as q
from sensorgrid.operators import sequence as s
from sensorgrid.operators.indexing import canonical_nodes
from sensorgrid.plans.catalog import tables as t
from sensorgrid.plans.catalog.registry import query
from sensorgrid.sources import flatten_history, flatten_strict, history_rejects, read_history, read_history_rejects, read_wide_panel
from sensorgrid.staging import move, names_in, new_path, stage

AS_OF = datetime(2024, 1, 25, tzinfo=timezone.utc)


def _file_name():
    """File names of all kinds: most end in the epoch, some hide it or have none."""
    ms = F.unix_millis("ts").cast("string")
    head = F.concat(F.lit("h"), F.col("event_id").cast("string"), F.lit("_"))
    return (
        F.when(F.col("k") < 5, F.concat(head, F.lit("nostamp.txt")))
        .when(F.col("k") < 10, F.concat(head, ms, F.lit("_x.txt")))
        .when(F.col("k") < 15, F.concat(F.lit("h"), F.col("event_id").cast("string"), F.lit("-"), ms, F.lit(".dat")))
        .otherwise(F.concat(head, ms, F.lit(".txt")))
    )


_NAMES = """(SELECT *, CASE WHEN k < 5 THEN 'h' || event_id || '_nostamp.txt'
    WHEN k < 10 THEN 'h' || event_id || '_' || (epoch_us(ts) // 1000) || '_x.txt'
    WHEN k < 15 THEN 'h' || event_id || '-' || (epoch_us(ts) // 1000) || '.dat'
    ELSE 'h' || event_id || '_' || (epoch_us(ts) // 1000) || '.txt' END AS filename FROM ev)"""


def nested_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as nested history documents of at most 1000 records."""
    rows = t.events(spark, sf_dir).select(
        fn.local_date(F.col("ts"), t.TZ).cast("string").alias("date"),
        F.col("user_id").cast("string").alias("sensor"),
        F.floor(F.col("event_id") / 1000).alias("chunk"),
        F.struct(
            _file_name().alias("key"),
            F.struct(
                F.when(F.col("k") % 10 != 9, F.col("value")).alias("count"),
                F.when(
                    F.col("k") % 10 != 8,
                    F.array(
                        F.floor(fn.time_of_day(F.col("ts"), t.TZ) / 3600).cast("int"),
                        F.floor(fn.time_of_day(F.col("ts"), t.TZ) % 3600 / 60).cast("int"),
                    ),
                ).alias("timestamp"),
            ).alias("value"),
        ).alias("record"),
    )
    files = F.map_from_entries(F.collect_list("record"))
    return rows.groupBy("date", "sensor", "chunk").agg(
        F.to_json(
            F.map_from_arrays(
                F.array(F.first("date")),
                F.array(F.map_from_arrays(F.array(F.first("sensor")), F.array(files))),
            )
        ).alias("value")
    ).select("value")


@query(
    "scan_nested_history",
    f"""SELECT date_trunc('millisecond', ts) AS ts, user_id AS sensor_id,
        CASE WHEN k % 10 = 9 THEN 0 ELSE value END AS count
        FROM {_NAMES} WHERE k >= 15""",
    ("ev",),
)
def scan_nested_history(spark, sf_dir):
    return flatten_history(nested_documents(spark, sf_dir)).select("ts", "sensor_id", "count")


def _history_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document with all dates as ``date, sensor, record, value``, a line of text per record and each
    record of many kinds.

    The lines in the order of the first three are a whole document but for its last brace; one of 50
    records holds an object and a brace in a string.  No row holds more than a record.
    """
    rows = t.events(spark, sf_dir).select(
        fn.local_date(F.col("ts"), t.TZ).cast("string").alias("date"), F.col("user_id").cast("string").alias("sensor"), _file_name().alias("name"),
        F.when(F.col("k") % 10 != 9, F.col("value")).alias("count"), "event_id",
    )
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('": '))
    odd = F.when(F.col("event_id") % 50 == 0, ', "more": {"brace": "}{\\"", "list": [1, {}]}').otherwise("")
    number = F.when(F.col("count").isNull(), "").otherwise(F.concat(F.lit('"count": '), F.col("count").cast("string"), F.lit(", ")))
    record = F.concat(quoted(F.col("name")), F.lit("{"), number, F.lit('"camera": "c"'), odd, F.lit("}"))
    rows = rows.select("date", "sensor", record.alias("record")).where("date is not null and sensor is not null and record is not null")
    # Where a sensor and a date begin and end.
    own = Window.partitionBy("date", "sensor").orderBy("record")
    days = rows.groupBy("date").agg(F.min("sensor").alias("head"), F.max("sensor").alias("tail"))
    days = days.withColumn("open", F.concat(F.when(F.col("date") == days.agg(F.min("date").alias("m")).scalar(), "{").otherwise(", "), quoted(F.col("date")), F.lit("{")))
    placed = rows.withColumns({"first": F.row_number().over(own) == 1, "last": F.lead("record").over(own).isNull()}).join(days, "date")
    begin = F.when(~F.col("first"), ", ").otherwise(
        F.concat(F.when(F.col("sensor") == F.col("head"), F.col("open")).otherwise(", "), quoted(F.col("sensor")), F.lit("{"))
    )
    end = F.when(~F.col("last"), "").when(F.col("sensor") == F.col("tail"), "}}").otherwise("}")
    return placed.select("date", "sensor", "record", F.concat(begin, "record", end).alias("value"))


@query(
    "scan_history_ranges",
    f"""SELECT date_trunc('millisecond', ts) AS ts, user_id AS sensor_id,
        CASE WHEN k % 10 = 9 THEN 0 ELSE value END AS count
        FROM {_NAMES} WHERE k >= 15""",
    ("ev",),
)
def scan_history_ranges(spark, sf_dir):
    """A single file with all dates, read in many byte ranges."""
    path = new_path(spark, "history")
    lines = _history_lines(spark, sf_dir)
    none = F.lit(None).cast("string")
    end = spark.range(1).select(F.lit("9999").alias("date"), none.alias("sensor"), none.alias("record"), F.lit("}").alias("value"))
    # One file is the point of this query: its task sorts lines, which may spill, and does nothing else.
    lines.unionAll(end).repartition(1).sortWithinPartitions("date", "sensor", "record").select("value").write.text(path)
    for name in names_in(spark, path):
        if name.startswith("part-"):
            move(spark, f"{path}/{name}", f"{path}/all.json")
    before = {name: spark.conf.get(name, None) for name in _SMALL_RANGES}
    for name, size in _SMALL_RANGES.items():
        spark.conf.set(name, size)
    try:
        return stage(read_history(spark, path).select("ts", "sensor_id", "count"), "read-history")
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


_SMALL_RANGES = {"spark.sql.files.maxPartitionBytes": "200k", "spark.sql.files.openCostInBytes": "0"}


#: Kinds of broken parts, by the event's number.
_BROKEN = {0: "record is not an object", 1: "count is not a number", 2: "date is not an object", 3: "document is not an object"}


@query(
    "history_rejects",
    "SELECT outcome, count(*) AS n FROM (SELECT CASE event_id % 5 "
    + " ".join(f"WHEN {i} THEN '{reason}'" for i, reason in _BROKEN.items())
    + " END AS outcome FROM events UNION ALL SELECT 'read' FROM events WHERE event_id % 5 <> 3)"
    " WHERE outcome IS NOT NULL GROUP BY 1",
)
def rejects(spark, sf_dir):
    """A document per event: four of five hold a broken part beside a good record or are cut off."""
    name = F.concat(F.lit('"s_'), F.unix_millis("ts").cast("string"), F.lit('.txt":'))
    good = F.concat(F.lit('"2":{'), name, F.lit('{"count":'), F.col("value").cast("string"), F.lit("}}"))
    kind = F.col("event_id") % 5
    first = F.when(kind == 0, '"1":{"x":5},').when(kind == 1, '"1":{"x":{"count":"many"}},').otherwise("")
    last = F.when(kind == 2, '},"extra":3}').when(kind == 3, "}").otherwise("}}")
    docs = t.events(spark, sf_dir).select(F.concat(F.lit('{"2024-01-01":{'), first, good, last).alias("value"))
    outcomes = history_rejects(docs).select(F.col("reason").alias("outcome")).unionAll(
        flatten_history(docs).select(F.lit("read").alias("outcome"))
    )
    return outcomes.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@query(
    "dedup_ties",
    """SELECT ts, sensor_id, count, source, seq FROM (SELECT *, row_number() OVER (PARTITION BY ts, sensor_id
        ORDER BY CASE source WHEN 'archive' THEN 1 ELSE 0 END DESC, seq DESC, tie DESC, count DESC) AS rn
        FROM (SELECT ts, sensor_id, count, source, seq // 100000 AS seq, CAST(seq % 7 AS VARCHAR) AS tie FROM readings)) WHERE rn = 1""",
    ("readings",),
)
def dedup_ties(spark, sf_dir):
    """Most readings of a key share their ``seq``, some also their ``tie``; rows come shuffled."""
    rows = t.readings(spark, sf_dir).withColumn("tie", (F.col("seq") % 7).cast("string"))
    rows = rows.withColumn("seq", F.floor(F.col("seq") / 100000)).repartition(5, F.xxhash64("seq", "count"))
    return p.dedup_last(rows)


@query(
    "scan_nested_strict",
    f"""SELECT strftime(ts + INTERVAL 7 HOUR, '%Y-%m-%d') AS date,
        CAST(user_id AS VARCHAR) AS sensor_id, filename,
        CASE WHEN k % 10 = 9 THEN NULL ELSE value END AS count,
        CAST(hour(ts + INTERVAL 7 HOUR) AS INTEGER) AS hour,
        CAST(minute(ts + INTERVAL 7 HOUR) AS INTEGER) AS minute,
        (epoch_us(ts) // 1000) AS unix_timestamp_ms,
        strftime(ts + INTERVAL 7 HOUR, '%Y-%m-%d %H:%M:%S') AS datetime
        FROM {_NAMES} WHERE k >= 5 AND k % 10 <> 8""",
    ("ev",),
)
def scan_nested_strict(spark, sf_dir):
    return flatten_strict(nested_documents(spark, sf_dir), t.TZ)


@query(
    "scan_nested_skipped",
    """SELECT count(*) FILTER (WHERE k < 5 OR k % 10 = 8) AS skipped,
        count(*) FILTER (WHERE k >= 5 AND k % 10 <> 8) AS kept FROM ev""",
    ("ev",),
)
def scan_nested_skipped(spark, sf_dir):
    rows = flatten_strict(nested_documents(spark, sf_dir), t.TZ, keep_skipped=True)
    return rows.agg(F.count_if(~F.col("ok")).alias("skipped"), F.count_if("ok").alias("kept"))


@query(
    "filename_ts_lenient",
    f"""SELECT event_id, TRY_CAST(replace(string_split(filename, '_')[-1], '.txt', '') AS BIGINT) AS epoch_ms
        FROM {_NAMES}""",
    ("ev",),
)
def filename_ts_lenient(spark, sf_dir):
    ev = t.events(spark, sf_dir)
    return ev.select("event_id", fn.filename_epoch_lenient(_file_name()).alias("epoch_ms"))


@query(
    "filename_ts_strict",
    f"SELECT event_id, CASE WHEN k < 5 THEN NULL ELSE (epoch_us(ts) // 1000) END AS epoch_ms FROM {_NAMES}",
    ("ev",),
)
def filename_ts_strict(spark, sf_dir):
    ev = t.events(spark, sf_dir)
    return ev.select("event_id", fn.filename_epoch_strict(_file_name()).alias("epoch_ms"))


@query(
    "normalize_sensor_id",
    """SELECT event_id, CASE WHEN k % 4 IN (0, 1) THEN user_id END AS sensor_id FROM ev""",
    ("ev",),
)
def normalize_sensor_id(spark, sf_dir):
    user = F.col("user_id").cast("string")
    kind = F.col("k") % 4
    raw = (
        F.when(kind == 0, user)
        .when(kind == 1, F.concat(F.lit("node_"), F.lpad(user, 6, "0")))
        .when(kind == 2, F.concat(F.lit("cam-"), user))
        .otherwise(F.lit("node_"))
    )
    return t.events(spark, sf_dir).select("event_id", fn.normalize_sensor_id(raw).alias("sensor_id"))


@query(
    "epoch_to_local",
    """SELECT event_id, make_timestamp((epoch_us(ts) // 1000) * 1000) AS ts,
        make_timestamp((epoch_us(ts) // 1000) * 1000) + INTERVAL 7 HOUR AS local_ts FROM events""",
)
def epoch_to_local(spark, sf_dir):
    ts = fn.epoch_ms_to_ts(F.unix_millis("ts"))
    return t.events(spark, sf_dir).select(
        "event_id", ts.alias("ts"), fn.local_wall(ts, t.TZ).alias("local_ts")
    )


@query(
    "history_window",
    "SELECT ts, sensor_id, count, seq FROM readings WHERE ts >= TIMESTAMP '2024-01-05 00:00:00'",
    ("readings",),
)
def history_window(spark, sf_dir):
    return p.history_window(t.readings(spark, sf_dir), AS_OF, 20).select("ts", "sensor_id", "count", "seq")


@query(
    "union_readings",
    """SELECT ts, sensor_id, count, source, seq FROM readings WHERE source = 'history'
        UNION ALL SELECT ts, sensor_id, count, source, seq FROM readings WHERE source = 'archive'""",
    ("readings",),
)
def union_readings(spark, sf_dir):
    rows = t.readings(spark, sf_dir)
    return p.union_readings(rows.where("source = 'history'"), rows.where("source = 'archive'"))


@query("dedup_last", "SELECT ts, sensor_id, count, source, seq FROM latest", ("latest",))
def dedup_last(spark, sf_dir):
    return p.dedup_last(t.readings(spark, sf_dir))


@query("resample", "SELECT sensor_id, bucket, round(value, 6) AS value, samples FROM cells", ("cells",))
def resample(spark, sf_dir):
    return t.cells(spark, sf_dir)


@query(
    "time_of_day_filter",
    """SELECT sensor_id, bucket, round(value, 6) AS value, samples FROM cells
        WHERE hour(bucket + INTERVAL 7 HOUR) BETWEEN 8 AND 22""",
    ("cells",),
)
def time_of_day_filter(spark, sf_dir):
    return p.time_of_day_filter(t.cells(spark, sf_dir), t.TZ, "07:30", "22:30")


@query(
    "calendar_features",
    """SELECT event_id, CAST(ts + INTERVAL 7 HOUR AS DATE) AS local_date,
        CAST(isodow(ts + INTERVAL 7 HOUR) AS INTEGER) AS weekday,
        CAST(floor(epoch(ts + INTERVAL 7 HOUR)) AS BIGINT) % 86400 AS tod FROM events""",
)
def calendar_features(spark, sf_dir):
    rows = p.with_calendar(t.events(spark, sf_dir), t.TZ, "ts")
    return rows.select("event_id", "local_date", "weekday", F.col("tod").cast("bigint").alias("tod"))


@query("dense_panel", "SELECT sensor_id, bucket, round(value, 6) AS value FROM panel", ("panel",))
def dense_panel(spark, sf_dir):
    cells, buckets = t.staged_cells(spark, sf_dir)
    return p.dense_panel(cells, buckets)


CHANNELS = ("click", "error", "purchase", "signup", "view")
_CHANNEL_CELLS = "(SELECT date_trunc('hour', ts) AS timestamp, event_type, value FROM events)"


def _channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly mean per event type: a panel with few, fixed columns."""
    rows = t.events(spark, sf_dir).select(
        "ts", F.col("event_type").alias("sensor_id"), F.col("value").alias("count")
    )
    return p.wide_panel(p.resample(rows, t.INTERVAL, t.TZ), list(CHANNELS))


@query(
    "wide_panel",
    "SELECT timestamp, "
    + ", ".join(f"round(avg(value) FILTER (WHERE event_type = '{c}'), 6) AS {c}" for c in CHANNELS)
    + f" FROM {_CHANNEL_CELLS} GROUP BY timestamp",
)
def wide_panel(spark, sf_dir):
    return _channels(spark, sf_dir)


@query(
    "scan_wide_panel",
    f"""SELECT h.timestamp AS bucket, c.event_type AS sensor_id, round(v.value, 6) AS value
        FROM (SELECT DISTINCT timestamp FROM {_CHANNEL_CELLS}) h
        CROSS JOIN (SELECT DISTINCT event_type FROM events) c
        LEFT JOIN (SELECT timestamp, event_type, avg(value) AS value FROM {_CHANNEL_CELLS}
            GROUP BY 1, 2) v ON v.timestamp = h.timestamp AND v.event_type = c.event_type""",
)
def scan_wide_panel(spark, sf_dir):
    path = new_path(spark, "wide")
    _channels(spark, sf_dir).write.parquet(path)
    return read_wide_panel(spark, path, id_type="string")


@query(
    "wide_panel_sensors",
    "SELECT bucket, sensor_id, round(value, 6) AS value FROM panel",
    ("panel",),
)
def wide_panel_sensors(spark, sf_dir):
    """A column for every sensor, written, read and unpivoted."""
    path = new_path(spark, "wide")
    p.wide_panel(t.staged_cells(spark, sf_dir)[0]).write.parquet(path)
    return read_wide_panel(spark, path)


@query("panel_sensors", "SELECT DISTINCT sensor_id FROM cells", ("cells",))
def panel_sensors(spark, sf_dir):
    return p.sensors(t.cells(spark, sf_dir))


@query(
    "canonical_nodes",
    """SELECT node_id, row_number() OVER (ORDER BY node_id) - 1 AS pos
        FROM (SELECT DISTINCT CAST(user_id AS VARCHAR) AS node_id FROM events)""",
)
def canonical(spark, sf_dir):
    return canonical_nodes(t.table(spark, sf_dir, "events"), "user_id")


@query("ordered_readings", "SELECT ts, sensor_id, count, source, seq FROM readings ORDER BY 1, 2, 5", ("readings",))
def ordered_readings(spark, sf_dir):
    return s.ordered_readings(t.readings(spark, sf_dir))


@query(
    "null_counts",
    """SELECT sensor_id, count(*) AS cells, count(*) FILTER (WHERE value IS NULL) AS nulls
        FROM panel GROUP BY 1""",
    ("panel",),
)
def null_counts(spark, sf_dir):
    cells, buckets = t.staged_cells(spark, sf_dir)
    return q.sparse_null_counts(cells, buckets)


_PCT = """(SELECT sensor_id, count(*) AS cells, count(*) FILTER (WHERE value IS NULL) AS nulls,
    count(*) FILTER (WHERE value IS NULL) * 100.0 / count(*) AS null_pct FROM panel GROUP BY 1)"""


@query(
    "null_pct_by_sensor",
    f"SELECT sensor_id, cells, nulls, round(CAST(null_pct AS DOUBLE), 6) AS null_pct FROM {_PCT}",
    ("panel",),
)
def null_pct_by_sensor(spark, sf_dir):
    cells, buckets = t.staged_cells(spark, sf_dir)
    return q.null_pct_by_sensor(q.sparse_null_counts(cells, buckets))


@query(
    "top_missing",
    f"""SELECT sensor_id, cells, nulls, round(CAST(null_pct AS DOUBLE), 6) AS null_pct FROM {_PCT}
        ORDER BY null_pct DESC, sensor_id LIMIT 5""",
    ("panel",),
)
def top_missing(spark, sf_dir):
    cells, buckets = t.staged_cells(spark, sf_dir)
    return q.top_missing(q.sparse_null_counts(cells, buckets))


@query(
    "health_report",
    """SELECT *, rows < expected_rows_span - 2 AS gap FROM (
        SELECT count(DISTINCT bucket) AS rows, count(DISTINCT sensor_id) AS sensors,
        min(bucket) AS first_bucket, max(bucket) AS last_bucket,
        count(*) FILTER (WHERE value IS NULL) AS nulls,
        round(CAST(count(*) FILTER (WHERE value IS NULL) * 100.0 / count(*) AS DOUBLE), 6) AS sparsity_pct,
        CAST(epoch(max(bucket)) - epoch(min(bucket)) AS BIGINT) // 3600 + 1 AS expected_rows_span,
        count(DISTINCT ld) * ((max(tod) - min(tod)) // 3600 + 1) AS expected_rows_active FROM panel_day)""",
    ("panel_day",),
)
def health_report(spark, sf_dir):
    from sensorgrid.plans.catalog.imputation import daytime

    cells, buckets = daytime(spark, sf_dir)
    return q.health_report(cells, buckets, t.INTERVAL)


@query(
    "span_stats",
    """SELECT count(*) AS records, min(ts) AS first_ts, max(ts) AS last_ts,
        round(((epoch_us(max(ts)) // 1000) - (epoch_us(min(ts)) // 1000)) / 3600000.0, 6) AS span_hours,
        round(((epoch_us(max(ts)) // 1000) - (epoch_us(min(ts)) // 1000)) / 60000.0 / 20.0, 6) AS replay_minutes
        FROM readings""",
    ("readings",),
)
def span_stats(spark, sf_dir):
    return s.span_stats(t.readings(spark, sf_dir))


@query(
    "replay_schedule",
    """SELECT ts_ms, records, gap_ms, round(gap_ms / 1000.0 / 20.0, 6) AS sleep_s,
        round((ts_ms - first_ms) / 1000.0, 6) AS simulated_s,
        round((ts_ms - first_ms) / 1000.0 / 20.0, 6) AS replay_s FROM (
        SELECT ts_ms, records, coalesce(ts_ms - lag(ts_ms) OVER (ORDER BY ts_ms), 0) AS gap_ms,
            min(ts_ms) OVER () AS first_ms
        FROM (SELECT (epoch_us(ts) // 1000) AS ts_ms, count(*) AS records FROM events GROUP BY 1))""",
)
def replay_schedule(spark, sf_dir):
    return s.replay_schedule(t.events(spark, sf_dir), speed=20.0)


@query(
    "scalar_suite",
    """SELECT event_id, contains(event_type, 'ic') AS has_ic,
        regexp_extract(props, '([0-9]+)', 1) AS digits,
        string_split(event_type, 'i')[-1] AS tail, replace(event_type, 'e', 'E') AS swapped,
        trim(' ' || event_type || ' ') AS trimmed,
        concat_ws('/', 'raw', event_type, CAST(user_id AS VARCHAR)) AS key,
        strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso, CAST(time_bucket(INTERVAL '5 minutes', ts) AS TIMESTAMP) AS bucket,
        TRY_CAST(CASE WHEN k % 2 = 0 THEN '2024-01-' || lpad(CAST(k AS VARCHAR), 2, '0') ELSE 'bad' END AS DATE) AS parsed,
        CAST(format('{:.2f}', value / 7) AS DOUBLE) AS rounded,
        round(1 / greatest(value, 1e-6), 6) AS inverse, round(sqrt(value), 6) AS root,
        round(power(value + 1, -0.5), 6) AS inv_sqrt,
        least(120.0, greatest(0.0, value)) AS clipped, round(abs(value - 50), 6) AS distance,
        CASE WHEN value > 100 THEN 'high' WHEN value > 50 THEN 'mid' ELSE 'low' END AS band,
        CAST(coalesce(nullif(k, 0), -1) AS INTEGER) AS k_or,
        len(list_filter(range(k), lambda x: x % 3 = 0)) AS thirds,
        json_extract_string(props, '$.k') AS json_k FROM ev""",
    ("ev",),
)
def scalar_suite(spark, sf_dir):
    ev = t.events(spark, sf_dir)
    text = F.when(
        F.col("k") % 2 == 0, F.concat(F.lit("2024-01-"), F.lpad(F.col("k").cast("string"), 2, "0"))
    ).otherwise("bad")
    return ev.select(
        "event_id",
        F.contains("event_type", F.lit("ic")).alias("has_ic"),
        F.regexp_extract("props", "([0-9]+)", 1).alias("digits"),
        F.substring_index("event_type", "i", -1).alias("tail"),
        F.replace("event_type", F.lit("e"), F.lit("E")).alias("swapped"),
        F.trim(F.concat(F.lit(" "), "event_type", F.lit(" "))).alias("trimmed"),
        F.concat_ws("/", F.lit("raw"), "event_type", F.col("user_id").cast("string")).alias("key"),
        F.date_format(fn.to_utc_wall(F.col("ts")), "yyyy-MM-dd'T'HH:mm:ss").alias("iso"),
        fn.floor_to(F.col("ts"), "5m", t.TZ).alias("bucket"),
        F.try_to_date(text, "yyyy-MM-dd").alias("parsed"),
        fn.round_half_even(F.col("value") / 7, 2).alias("rounded"),
        (1 / F.greatest("value", F.lit(1e-6))).alias("inverse"),
        F.sqrt("value").alias("root"),
        F.pow(F.col("value") + 1, F.lit(-0.5)).alias("inv_sqrt"),
        F.least(F.lit(120.0), F.greatest(F.lit(0.0), "value")).alias("clipped"),
        F.abs(F.col("value") - 50).alias("distance"),
        F.when(F.col("value") > 100, "high").when(F.col("value") > 50, "mid").otherwise("low").alias("band"),
        F.coalesce(F.nullif("k", F.lit(0)), F.lit(-1)).alias("k_or"),
        F.size(
            F.filter(
                F.when(F.col("k") > 0, F.sequence(F.lit(0), F.col("k") - 1)).otherwise(
                    F.array().cast("array<int>")
                ),
                lambda x: x % 3 == 0,
            )
        ).cast("bigint").alias("thirds"),
        F.get_json_object("props", "$.k").alias("json_k"),
    )
