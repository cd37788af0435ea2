import random

import pytest
from pyspark.sql import functions as F

from sensorgrid.operators import gaps, panel, quality
from sensorgrid.sources import wide_to_long
from sensorgrid.staging import stage
from tests.helpers import as_dict, at, cells, index, temporal_model

STEP = 60


def _grid(rows):
    """Adds a sensor that is present in every hour of three days, 8 to 20 h."""
    hours = [d * 1440 + h * STEP for d in range(3) for h in range(8, 21)]
    return rows + [(99, m, 1.0) for m in hours], hours


def _case(seed):
    rng = random.Random(seed)
    _, hours = _grid([])
    rows = []
    for sensor in range(1, 6):
        share = rng.choice([0.05, 0.2, 0.5, 0.9])
        picked = [m for m in hours if rng.random() < share] or [hours[rng.randrange(len(hours))]]
        rows += [(sensor, m, float(rng.randrange(100))) for m in picked]
    return _grid(rows)[0]


@pytest.mark.parametrize("seed", range(4))
def test_temporal_matches_model(spark, seed):
    rows = _case(seed)
    df = cells(spark, rows)
    buckets = index(df)
    limit = 12 if seed % 2 else 4
    got = as_dict(gaps.impute_temporal(df, buckets, limit), ["sensor_id", "bucket"])
    want = {(s, at(m)): v for (s, m), v in temporal_model(rows, limit).items()}
    assert got.keys() == want.keys()
    for key, value in want.items():
        assert got[key] == (None if value is None else pytest.approx(value)), key


def test_run_of_exactly_the_limit(spark):
    _, hours = _grid([])
    short = [(1, hours[0], 5.0), (1, hours[13], 7.0)]  # 12 null cells between them
    long = [(2, hours[0], 5.0), (2, hours[14], 7.0)]  # 13
    rows = _grid(short + long)[0]
    df = cells(spark, rows)
    buckets = index(df)
    runs = gaps.find_gaps(df, buckets)
    found = {(r.sensor_id, r.first_null): r.run for r in runs.collect()}
    assert found[1, 1] == 12 and found[2, 1] == 13
    filled = as_dict(gaps.impute_temporal(df, buckets, 12), ["sensor_id", "bucket"])
    assert filled[1, at(hours[5])] == 5.0
    assert filled[2, at(hours[5])] is None


def test_blank_sensor_and_null_cells(spark):
    rows = _grid([(1, 480, None), (1, 540, None), (2, 480, None), (2, 600, 4.0)])[0]
    df = cells(spark, rows)
    buckets = index(df)
    runs = {(r.sensor_id, r.first_null): r.run for r in gaps.find_gaps(df, buckets).collect()}
    assert runs == {(1, 0): 39, (2, 0): 2, (2, 3): 36}
    dense = panel.dense_panel(df, buckets)
    assert dense.count() == 3 * 39
    assert dense.select("sensor_id", "bucket").distinct().count() == 3 * 39
    counts = {r.sensor_id: (r.cells, r.nulls) for r in quality.null_counts(dense).collect()}
    sparse = {r.sensor_id: (r.cells, r.nulls) for r in quality.sparse_null_counts(df, buckets).collect()}
    assert counts == sparse == {1: (39, 39), 2: (39, 38), 99: (39, 0)}


def test_interpolation_in_time(spark):
    rows = [(1, 0, 0.0), (1, 50, 10.0), (2, 0, 1.0), (2, 10, 1.0), (2, 50, 1.0)]
    df = cells(spark, rows)
    buckets = index(df)
    row = as_dict(gaps.impute_temporal(df, buckets, by="row"), ["sensor_id", "bucket"])
    time = as_dict(gaps.impute_temporal(df, buckets, by="time"), ["sensor_id", "bucket"])
    assert row[1, at(10)] == pytest.approx(5.0)
    assert time[1, at(10)] == pytest.approx(2.0)
    with pytest.raises(ValueError):
        gaps.interpolate("other")


def test_bucket_index_positions(spark):
    rows = [(1, m, 1.0) for m in (2000, 5, 1435, 1440, 0, 3000)]
    got = {
        r.bucket.minute + 60 * r.bucket.hour + 1440 * (r.bucket.day - 1): (r.pos, r.day_first, r.day_last)
        for r in index(cells(spark, rows)).collect()
    }
    assert got == {
        0: (0, 0, 2), 5: (1, 0, 2), 1435: (2, 0, 2), 1440: (3, 3, 4), 2000: (4, 3, 4), 3000: (5, 5, 5),
    }


def test_no_product_of_buckets_and_sensors_in_the_plan(spark):
    df = cells(spark, _case(1))
    plan = gaps.impute_temporal(df, index(df))._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_health_report(spark):
    rows = _grid([(1, 480, 3.0)])[0]
    df = cells(spark, rows)
    got = quality.health_report(df, index(df), "1h").first()
    assert (got["rows"], got.sensors, got.nulls) == (39, 2, 38)
    assert got.expected_rows_span == 61 and got.expected_rows_active == 39 and got.gap


def test_top_missing_breaks_ties_by_id(spark):
    counts = spark.createDataFrame([(i, 10, 5) for i in range(9)], "sensor_id BIGINT, cells BIGINT, nulls BIGINT")
    assert [r.sensor_id for r in quality.top_missing(counts).collect()] == [0, 1, 2, 3, 4]


def test_wide_panel(spark):
    df = cells(spark, [(1, 0, 1.0), (10, 0, 2.0), (2, 5, 3.0)])
    wide = panel.wide_panel(df, [1, 2, 10])
    assert wide.columns == ["timestamp", "1", "10", "2"]
    got = {(r["1"], r["10"], r["2"]) for r in wide.collect()}
    assert got == {(1.0, 2.0, None), (None, None, 3.0)}


def test_wide_panel_of_many_sensors(spark):
    """More sensors than a row holds: blocks of columns, a row per bucket in each, also empty ones."""
    rows = [(s, s % 3, float(s)) for s in range(1, 24)] + [(4, 1, 6.0), (None, 7, 1.0)]
    df = cells(spark, rows).drop("samples")
    wide = stage(panel.wide_panel(df, width=5), "wide")
    assert wide.columns == ["timestamp", "block", "sensors", "c0", "c1", "c2", "c3", "c4"]
    assert {r.block: len(r.sensors) for r in wide.collect()} == {0: 5, 1: 5, 2: 5, 3: 5, 4: 3}
    assert [s for r in wide.where("block < 5").select("block", "sensors").distinct().orderBy("block").collect() for s in r.sensors] == sorted(map(str, range(1, 24)))
    got = {(r.bucket, r.sensor_id): r.value for r in wide_to_long(wide).collect()}
    named = panel.wide_panel(df, list(range(1, 24)))
    assert len(got) == wide_to_long(wide).count() == 4 * 23
    assert got == {(r.bucket, r.sensor_id): r.value for r in wide_to_long(named).collect()}
    plan = panel.wide_panel(df, width=5)._jdf.queryExecution().optimizedPlan().toString()
    assert "c5" not in plan and "CartesianProduct" not in plan
