import json
import random
from datetime import timedelta

import pytest

from sensorgrid.operators import gaps, impute, panel, quality
from sensorgrid.plans.clean import CleanOptions, clean_panel, panel_graph
from sensorgrid.sources import empty_readings, flatten_history
from sensorgrid.staging import stage
from tests.helpers import as_dict, at, cells, edges, index, nodes, temporal_model

HOURS = [d * 1440 + h * 60 for d in range(16) for h in range(6)]


def _rows(seed):
    rng = random.Random(seed)
    rows = [(0, m, float(rng.randrange(50))) for m in HOURS]
    for sensor in range(1, 7):
        share = rng.choice([0.1, 0.3, 0.6])
        rows += [(sensor, m, float(rng.randrange(50))) for m in HOURS if rng.random() < share]
    rows += [(7, HOURS[0], 9.0), (8, HOURS[4], 2.0)]
    return rows


LINKS = [(1, 2, 2.0), (1, 3, 0.0), (2, 3, 1.0), (4, 7, 0.5), (5, 42, 1.0), (1, 1, 3.0)]


def _edges(spark):
    both = [(a, b, 1.0, d) for a, b, d in LINKS] + [(b, a, 1.0, d) for a, b, d in LINKS if a != b]
    return stage(edges(spark, both).coalesce(1), "edges")


def _spatial_model(values, mode):
    adjacent = {}
    for a, b, d in LINKS:
        if a != b and a in range(9) and b in range(9):
            adjacent.setdefault(a, []).append((b, 1 / max(d, 1e-6)))
            adjacent.setdefault(b, []).append((a, 1 / max(d, 1e-6)))
    out = {}
    for (s, m), v in values.items():
        if v is None and s in adjacent:
            near = [(values[n, m], w) for n, w in adjacent[s]]
            num = sum(x * w for x, w in near if x is not None)
            den = sum(w for x, w in near if mode == "all" or x is not None)
            v = num / den if den else None
        out[s, m] = v
    return out


def _weekly_model(values):
    def slot(s, m):
        return s, (m // 1440) % 7, m % 1440

    seen = {}
    for (s, m), v in values.items():
        if v is not None:
            seen.setdefault(slot(s, m), []).append(v)
    return {
        (s, m): v if v is not None or slot(s, m) not in seen else sum(seen[slot(s, m)]) / len(seen[slot(s, m)])
        for (s, m), v in values.items()
    }


def _global_model(values, threshold):
    out = dict(values)
    for sensor in {s for s, _ in values}:
        mine = {k: v for k, v in values.items() if k[0] == sensor}
        known = [v for v in mine.values() if v is not None]
        holes = len(mine) - len(known)
        if holes and holes / len(mine) < threshold and known:
            out.update({k: sum(known) / len(known) for k, v in mine.items() if v is None})
    return out


def _same(got, want):
    assert got.keys() == {(s, at(m)) for s, m in want}
    for (s, m), value in want.items():
        assert got[s, at(m)] == (None if value is None else pytest.approx(value)), (s, m)


@pytest.mark.parametrize("mode", ["all", "available"])
@pytest.mark.parametrize("seed", [1, 2])
def test_layers_match_model(spark, seed, mode):
    rows = _rows(seed)
    df = cells(spark, rows)
    buckets = index(df)
    first = stage(gaps.impute_temporal(df, buckets, 3), "first")
    want = temporal_model(rows, 3)
    key = ["sensor_id", "bucket"]
    _same(as_dict(first, key), want)
    second = stage(impute.impute_spatial(first, _edges(spark), mode), "second")
    want = _spatial_model(want, mode)
    _same(as_dict(second, key), want)
    third = stage(impute.impute_historical(second), "third")
    want = _weekly_model(want)
    _same(as_dict(third, key), want)
    fourth = stage(impute.impute_global(third, 0.2), "fourth")
    want = _global_model(want, 0.2)
    _same(as_dict(fourth, key), want)
    bad = {s for (s, _), v in want.items() if v is None}
    want = {k: v for k, v in want.items() if k[0] not in bad}
    _same(as_dict(impute.drop_unresolved(fourth), key), want)
    fused = impute.impute(df, buckets, _edges(spark), threshold=0.2, limit_rows=3, null_weighting=mode)
    _same(as_dict(fused, key), want)


def test_spatial_without_distances(spark):
    df = cells(spark, [(1, 0, 1.0), (2, 0, 3.0), (3, 5, 4.0), (1, 5, 2.0)])
    buckets = index(df)
    graph = edges(spark, [(3, 1, 1, None), (3, 2, 1, None), (2, 1, 1, None)])
    dense = stage(gaps.impute_temporal(df, buckets, limit_rows=0), "dense")
    got = as_dict(impute.impute_spatial(dense, graph, "all", use_distance=False), ["sensor_id", "bucket"])
    assert got[3, at(0)] == 2.0 and got[2, at(5)] == 2.0


def test_observed_cells_never_change_and_lineage_covers_all(spark):
    rows = _rows(3)
    df = cells(spark, rows)
    buckets = index(df)
    layers = stage(impute.impute_layers(df, buckets, _edges(spark), limit_rows=3), "layers")
    observed = as_dict(layers.where("filled_by = 'observed'"), ["sensor_id", "bucket"])
    assert observed == {(s, at(m)): v for s, m, v in rows}
    assert layers.count() == 9 * len(HOURS)
    assert layers.where("(value IS NULL) <> (filled_by = 'none')").count() == 0
    report = {r.layer: r for r in quality.imputation_report(layers).collect()}
    assert report["initial"].remaining == 9 * len(HOURS) - len(rows)
    assert report["global"].remaining == layers.where("value IS NULL").count()


def test_global_threshold_is_strict(spark):
    def filled(holes):
        rows = [(0, m, 1.0) for m in range(20)] + [(1, m, 2.0) for m in range(holes, 20)]
        df = cells(spark, rows)
        dense = gaps.impute_temporal(df, index(df), limit_rows=0)
        return impute.impute_global(dense, 0.05 * 2).where("filled_by = 'global'").count()

    assert filled(1) == 1  # 5 % is below 10 %
    assert filled(2) == 0  # 10 % is not


def test_unknown_options(spark):
    df = cells(spark, [(1, 0, 1.0)])
    dense = gaps.impute_temporal(df, index(df))
    with pytest.raises(ValueError):
        impute.impute_spatial(dense, _edges(spark), "some")


def test_end_to_end_document(spark):
    """Two sensors, one missing reading at 07:35 local time."""
    doc = {
        "2024-01-01": {
            "1": {"sensor_1704069000000.txt": {"count": 10}, "sensor_1704069600000.txt": {"count": 20}},
            "2": {
                "sensor_1704069000000.txt": {"count": 15},
                "sensor_1704069300000.txt": {"count": 18},
                "sensor_1704069600000.txt": {"count": 25},
            },
        }
    }
    history = flatten_history(spark.createDataFrame([(json.dumps(doc),)], "value STRING"))
    graph = edges(spark, [(1, 2, 1, 0.5), (2, 1, 1, 0.5), (1, 1, 1, 0), (2, 2, 1, 0)])
    options = CleanOptions(tz="+07:00", start="07:30", end="07:45")
    got = stage(
        clean_panel(history, empty_readings(spark), graph, at(0) + timedelta(days=1), options), "clean"
    )
    rows = as_dict(got, ["sensor_id", "bucket"])
    assert rows == {
        (1, at(30)): 10.0, (1, at(35)): 15.0, (1, at(40)): 20.0,
        (2, at(30)): 15.0, (2, at(35)): 18.0, (2, at(40)): 25.0,
    }
    links = {(r.src_pos, r.dst_pos): r.weight for r in panel_graph(got, graph, nodes(spark, [1, 2])).collect()}
    assert links[0, 1] == pytest.approx(1 / 3) and links[0, 0] == pytest.approx(2 / 3)


def test_history_window_and_archive_override(spark):
    rows = [
        (at(0), 1, 1.0, "history", 1),
        (at(60), 1, 2.0, "history", 2),
        (at(60), 1, 3.0, "archive", 1),
        (at(60), 1, 4.0, "archive", 0),
        (at(60), 2, 5.0, "other", 9),
    ]
    df = spark.createDataFrame(rows, "ts TIMESTAMP, sensor_id BIGINT, count DOUBLE, source STRING, seq BIGINT")
    kept = panel.history_window(df, at(1440 + 30), 1)
    assert kept.count() == 4 and panel.history_window(df, at(0), None).count() == 5
    best = {(r.sensor_id, r.ts.hour): (r["count"], r.source, r.seq) for r in panel.dedup_last(df).collect()}
    assert best == {(1, 0): (1.0, "history", 1), (1, 1): (3.0, "archive", 1), (2, 1): (5.0, "other", 9)}


def test_holes_are_not_sent_to_neighbors(spark):
    """Values go along the links to sensors with holes: two joins, and one aggregate with the holes."""
    rows = [(1, m, float(m)) for m in range(0, 50, 5)] + [(2, 0, 1.0), (2, 45, 4.0), (3, 45, 2.0)]
    df = cells(spark, rows)
    panel_ = stage(gaps.impute_temporal(df, index(df), limit_rows=0), "dense")
    links = stage(impute.usable_neighbors(edges(spark, [(2, 1, 1, 1), (2, 3, 1, 1), (3, 1, 1, 2)])), "links")
    found = impute.neighbor_values(panel_, links)
    plan = impute._neighbor_sums(panel_, links)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 2
    got = {(r.sensor_id, r.bucket.minute): (r.num, r.den, r.total, r.available) for r in found.collect()}
    assert len(got) == 8 + 9 and got[2, 5] == (5.0, 1.0, 2.0, 1) and got[3, 10] == (5.0, 0.5, 0.5, 1)
