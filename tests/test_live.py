"""Snapshots, alignment and the streaming jobs."""

import json
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sensorgrid import sources
from sensorgrid.operators import forecast as fc
from sensorgrid.operators import snapshots as sn
from sensorgrid.streaming import (
    archive_stream, clear_window, open_bucket_stream, read_open, read_window, score_latest, snapshot_stream, write_snapshots,
)
from tests.helpers import at, utc

ONCE = {"availableNow": True}


def ms(minute):
    return int(at(minute).timestamp() * 1000)


def broker(spark, values):
    rows = [(v if isinstance(v, str) else json.dumps(v), 0, i, at(0)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "value STRING, partition INT, offset BIGINT, timestamp TIMESTAMP")


BAD = [
    "text",
    [1],
    {"sensor_id": "1", "ts": 5},
    {"sensor_id": "1", "count": None, "ts": ms(1)},
    {"sensor_id": "1", "count": "x", "ts": ms(1)},
    {"sensor_id": "1", "count": 4, "ts": 0},
    {"sensor_id": None, "count": 4, "ts": ms(1)},
    {"sensor_id": "node_007", "count": "2.5", "ts": ms(1)},
]


def test_validation_and_acceptance(spark):
    valid, rejected = sources.split_valid(broker(spark, BAD))
    assert sorted(r.offset for r in valid.collect()) == [3, 4, 5, 6, 7]
    assert {r.offset: r.reject_reason for r in rejected.collect()} == {
        0: "not an object", 1: "not an object", 2: "missing count",
    }
    kept = sources.accepted(sources.decode(valid)).collect()
    assert [(r.sensor_id, r["count"]) for r in kept] == [("node_007", 2.5)]


def test_snapshots_match_model(spark):
    values, model, total = [], defaultdict(list), defaultdict(int)
    for i in range(400):
        minute, sensor, count = (i * 7) % 60, i % 9, (i * 13) % 17 / 8
        values.append({"sensor_id": sensor, "count": count, "ts": ms(minute)})
        model[minute // 5 * 5, str(sensor)].append(count)
        total[minute // 5 * 5] += 1
    decoded = sources.decode(broker(spark, values + BAD))
    got = {(utc(r.window_start), r.node_id): (r.flow, r.num_samples) for r in sn.snapshots(decoded, "5m", "+07:00").collect()}
    model[0, "node_007"].append(2.5)
    assert got == {(at(m), s): (round(sum(v) / len(v), 2), len(v)) for (m, s), v in model.items()}
    sums = {utc(r.window_start): (r.num_messages, r.num_valid) for r in sn.snapshot_totals(decoded, "5m", "+07:00").collect()}
    assert sums[at(0)] == (total[0] + 4, total[0] + 1) and sums[at(5)] == (total[5], total[5])


def _snap(spark, rows):
    return spark.createDataFrame(
        [(at(m), n, f, 1) for m, n, f in rows], "window_start TIMESTAMP, node_id STRING, flow DOUBLE, num_samples BIGINT"
    )


@pytest.mark.parametrize("n, ready", [(11, False), (12, True), (14, True)])
def test_last_windows(spark, n, ready):
    snap = _snap(spark, [(5 * i, s, 1.0) for i in range(n) for s in ("1", "2")])
    state = sn.window_ready(snap).first()
    assert state.ready is ready and state.current == min(n, 12)
    assert state.span_minutes == (min(n, 12) - 1) * 5
    kept = {utc(r.window_start) for r in sn.last_n_snapshots(snap).collect()}
    assert kept == {at(5 * i) for i in range(max(0, n - 12), n)}
    assert sn.window_metadata(snap.where("false")).count() == 0


def test_alignment(spark):
    nodes = spark.createDataFrame([("1", 0), ("10", 1), ("2", 2), ("3", 3)], "node_id STRING, pos BIGINT")
    snap = _snap(spark, [(0, "10", 5.0), (0, "3", 7.0), (0, "x", 9.0), (5, "1", 1.0), (10, "x", 2.0), (10, "y", 2.0)])
    got = {utc(r.window_start): (r.flows, r.unknown, r.missing) for r in sn.align_to_nodes(snap, nodes).collect()}
    assert got == {
        at(0): ([0.0, 5.0, 0.0, 7.0], 1, 2),
        at(5): ([1.0, 0.0, 0.0, 0.0], 0, 3),
        at(10): ([0.0] * 4, 2, 4),
    }
    for block in (1, 3, 100):
        long = sn.align_long(snap, nodes, block).orderBy("window_start", "pos").collect()
        assert [(utc(r.window_start), r.pos, r.flow, r.unknown, r.missing) for r in long] == [
            (w, i, f, u, m) for w, (flows, u, m) in sorted(got.items()) for i, f in enumerate(flows)
        ]
        for r in sn.input_blocks(snap, nodes, block).collect():
            flows = [0.0] * r.flows["size"]
            for i, v in zip(r.flows["indices"], r.flows["values"], strict=True):
                flows[i] = v
            assert flows == got[utc(r.window_start)][0][r.block * block : (r.block + 1) * block]
    assert sn.align_long(snap, nodes.limit(0)).count() == 0
    assert {r.unknown for r in sn.unknown_sensors(snap, nodes).collect()} == {1, 2}
    assert {utc(r.window_start): r.missing for r in sn.missing_sensors(snap, nodes).collect()} == {at(0): 2, at(5): 3, at(10): 4}
    forecast = fc.forecast_persistence(snap.where("window_start < '2024-01-01 00:05:00'"), nodes, steps=2)
    first = {r.node_id: r.flow for r in forecast.where("horizon = 2").collect()}
    assert first == {"1": 0.0, "10": 5.0, "2": 0.0, "3": 7.0}
    assert {utc(r.target_ts) for r in forecast.collect()} == {at(5), at(10)}
    data = sn.format_predictions(forecast).first()
    assert data["data"] == first and utc(data.timestamp) == at(0)
    high = fc.forecast_persistence(_snap(spark, [(0, "1", 500.0)]), nodes, steps=1, noise_std=2.0, low=0, high=120)
    assert all(0 <= r.flow <= 120 for r in high.collect())


SCHEMA = "value STRING, partition INT, offset BIGINT, timestamp TIMESTAMP"


def _feed(spark, folder, name, values):
    broker(spark, values).coalesce(1).write.mode("overwrite").parquet(f"{folder}/{name}")


def _stream(spark, folder):
    return spark.readStream.schema(SCHEMA).option("recursiveFileLookup", True).parquet(folder)


def _message(minute, sensor="1", count=4.0):
    return {"sensor_id": sensor, "count": count, "ts": ms(minute)}


def test_snapshot_stream_restarts_and_scores(spark, tmp_path):
    source, table, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    nodes = spark.createDataFrame([("1", 0), ("2", 1)], "node_id STRING, pos BIGINT")
    hook = score_latest(lambda w: fc.forecast_persistence(w, nodes, steps=3), n=3)

    def run():
        decoded = sources.decode(_stream(spark, source))
        query = write_snapshots(snapshot_stream(decoded, "5m", "0 seconds"), table, state, hook, ONCE)
        query.awaitTermination()
        rows = read_window(spark, table, None).collect()
        return {(utc(r.window_start), r.node_id): (r.flow, r.num_samples) for r in rows}

    _feed(spark, source, "a", [_message(1), _message(2, count=6.0), _message(6)])
    assert run() == {(at(0), "1"): (5.0, 2)}  # the bucket of minute 5 is still open
    _feed(spark, source, "b", [_message(7, count=8.0), _message(12, "2"), _message(2, count=99.0)])
    assert run() == {(at(0), "1"): (5.0, 2), (at(5), "1"): (6.0, 2)}  # the late 99 is dropped
    assert run() == {(at(0), "1"): (5.0, 2), (at(5), "1"): (6.0, 2)}  # nothing new, nothing doubled
    assert not (tmp_path / "out" / "predictions").exists()
    _feed(spark, source, "c", [_message(21)])
    assert run()[at(10), "2"] == (4.0, 1)
    scored = spark.read.parquet(f"{table}/predictions").where("horizon = 1").collect()
    assert {(r.node_id, r.flow, utc(r.timestamp)) for r in scored} == {("1", 0.0, at(10)), ("2", 4.0, at(10))}
    clear_window(spark, table)
    assert read_window(spark, table).count() == 0
    _feed(spark, source, "d", [_message(31)])
    assert run() == {(at(20), "1"): (4.0, 1)}
    assert read_window(spark, str(tmp_path / "none")).count() == 0


def test_late_messages_join_the_open_bucket(spark, tmp_path):
    source, table, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    offset = iter(range(1000))

    def feed(name, *values, partition=0):
        rows = [(json.dumps(v), partition, next(offset), at(0)) for v in values]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{source}/{name}")

    def run(folder=table, initial=None, after=None):
        stream = sources.decode(_stream(spark, source))
        open_bucket_stream(stream, folder, f"{state}{folder[-3:]}", "5m", "+07:00", after, ONCE, initial=initial).awaitTermination()
        return {(utc(r.window_start), r.node_id): (r.flow, r.num_samples) for r in read_window(spark, folder, None).collect()}

    def still_open(folder=table):
        return {(r.partition, utc(r.bucket), r.node_id): (r.total, r.num_samples) for r in read_open(spark, folder).collect()}

    feed("a", _message(1), _message(2, count=6.0), _message(6, count=10.0))
    assert run() == {(at(0), "1"): (5.0, 2)}
    assert still_open() == {(0, at(5), "1"): (10.0, 1)}
    # Late by a bucket, by an hour before the start; no sample, but it opens the next bucket.
    feed("b", _message(2, count=20.0), _message(-60, count=30.0), _message(1, "2", 7.0), _message(11, count=None))
    want = {(at(0), "1"): (5.0, 2), (at(5), "1"): (20.0, 3), (at(5), "2"): (7.0, 1)}
    assert run() == want and still_open() == {(0, at(10), None): (0.0, 0)}
    assert run() == want
    # Another partition has a bucket of its own; nothing is closed by it.
    feed("c", _message(3, "9"), _message(8, "9"), {"sensor_id": "9", "count": 1, "ts": 0}, partition=1)
    want[at(0), "9"] = (4.0, 1)
    assert run() == want and still_open() == {(0, at(10), None): (0.0, 0), (1, at(5), "9"): (4.0, 1)}
    failed = []

    def fail_once(session, path, batch_id):
        if not failed:
            failed.append(batch_id)
            raise RuntimeError("between push and commit")

    feed("d", _message(0, count=5.0), _message(30))
    with pytest.raises(Exception, match="between push and commit"):
        run(after=fail_once)
    want[at(10), "1"] = (5.0, 1)
    assert run(after=fail_once) == want and failed
    handed = read_open(spark, table)
    fresh = str(tmp_path / "new")
    source = str(tmp_path / "in2")
    feed("e", _message(1, count=8.0), _message(40))
    assert run(fresh, handed) == {(at(30), "1"): (6.0, 2)}
    assert still_open(fresh)[1, at(5), "9"] == (4.0, 1)


def test_archive_stream_appends_after_restart(spark, tmp_path):
    source, target, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")

    def run():
        archive_stream(_stream(spark, source), target, state, "+07:00", "event", ONCE).awaitTermination()
        return sources.read_archive(spark, target, "*.txt")

    _feed(spark, source, "a", [{**_message(1), "extra": "kept"}, "junk", _message(1100)])
    first = run()
    assert first.count() == 2 and first.where("_corrupt IS NULL").count() == 2
    _feed(spark, source, "b", [_message(2, count=None)])
    again = run()
    assert again.count() == 3
    days = {r[0] for r in again.select(F.regexp_extract("file_path", "dump_date=([0-9-]+)", 1)).collect()}
    assert days == {"2024-01-01", "2024-01-02"}
    text = spark.read.text(target).where("value LIKE '%kept%'").first().value
    line = json.loads(text)
    assert line["extra"] == "kept" and line["kafka_offset"] == 0 and line["dumper_timestamp"] > 0
    with pytest.raises(ValueError):
        archive_stream(_stream(spark, source), target, state, "UTC", "other")
