import random

import pytest
from pyspark.sql import functions as F

from sensorgrid.operators import sequence as sq
from sensorgrid.operators.indexing import canonical_nodes, dense_position
from tests.helpers import at


def test_running_max_over_pieces(spark):
    rng = random.Random(1)
    rows = []
    for key, size in ((0, 300), (1, 40), (2, 1)):  # one key holds most records
        offsets = sorted(rng.sample(range(1000), size))
        rows += [(key, o, rng.randrange(500)) for o in offsets]
    df = spark.createDataFrame(rows, "k INT, o BIGINT, v BIGINT")
    for inclusive in (True, False):
        got = sq.running_max(df, "k", "o", F.col("v"), "m", inclusive, piece=17)
        want, seen = {}, {}
        for k, o, v in rows:
            before = seen.get(k)
            seen[k] = max(v, before) if before is not None else v
            want[k, o] = seen[k] if inclusive else before
        assert {(r.k, r.o): r.m for r in got.collect()} == want


def test_late_message_joins_the_open_bucket(spark):
    minutes = [0, 6, 12, 1, 13, 3]  # the last but two and the last are two buckets late
    rows = [(0, i, int(at(m).timestamp() * 1000)) for i, m in enumerate(minutes)] + [(0, 9, 0), (0, 10, None)]
    df = spark.createDataFrame(rows, "partition INT, offset BIGINT, ts BIGINT")
    got = {r.offset: (r.bucket.minute, r.late) for r in sq.monotone_buckets(df, "5m", "+07:00").collect()}
    assert got == {0: (0, False), 1: (5, False), 2: (10, False), 3: (10, True), 4: (10, False), 5: (10, True)}
    late = {r.offset for r in sq.late_rows(df, "5m", "+07:00", "5m").collect()}
    assert late == {3, 5}


def test_replay_schedule_across_hours(spark):
    minutes = [0, 0, 59, 61, 200]
    df = spark.createDataFrame([(at(m),) for m in minutes], "ts TIMESTAMP")
    got = sorted((r.records, r.gap_ms, r.sleep_s, r.simulated_s) for r in sq.replay_schedule(df, 20.0).collect())
    assert got == [(1, 120000, 6.0, 3660.0), (1, 3540000, 177.0, 3540.0), (1, 8340000, 417.0, 12000.0), (2, 0, 0.0, 0.0)]
    with pytest.raises(ValueError):
        sq.replay_schedule(df, 0)


def test_canonical_order(spark):
    ids = spark.createDataFrame([(i,) for i in range(1200)], "sensor_id BIGINT")
    got = [r.node_id for r in canonical_nodes(ids).orderBy("pos").collect()]
    assert got == sorted(str(i) for i in range(1200))


def test_positions_of_ids_with_a_common_start_and_hashes(spark):
    names = spark.range(500).selectExpr("concat('node_', lpad(cast(id % 250 as string), 5, '0')) AS sensor_id")
    got = canonical_nodes(names).orderBy("pos").collect()
    assert [(r.node_id, r.pos) for r in got] == [(f"node_{i:05d}", i) for i in range(250)]
    hashes = spark.range(300).selectExpr("xxhash64(id) AS node_id")
    rows = dense_position(hashes, ["node_id"]).collect()
    assert [r.node_id for r in sorted(rows, key=lambda r: r.pos)] == sorted(r.node_id for r in rows)
    assert sorted(r.pos for r in rows) == list(range(300))
    assert dense_position(hashes.limit(0), ["node_id"]).collect() == []
