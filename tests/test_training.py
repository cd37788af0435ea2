import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorgrid import sinks
from sensorgrid.operators import evaluate
from sensorgrid.operators import forecast as fc
from sensorgrid.operators import training as tr
from sensorgrid.operators.indexing import canonical_nodes
from sensorgrid.staging import stage
from tests.helpers import at, cells, edges, index


def _series(spark, matrix):
    """Time steps of 5 minutes, one column per sensor."""
    rows = [(s, i * 5, float(v)) for i, line in enumerate(matrix) for s, v in enumerate(line)]
    df = cells(spark, rows)
    buckets = index(df)
    return stage(tr.to_series(df, buckets).coalesce(2), "series"), stage(tr.chrono_split(buckets), "split")


@pytest.mark.parametrize("chunk", [15, 20, 1024])
def test_windows_match_slices(spark, chunk):
    rng = np.random.default_rng(1)
    data = rng.integers(0, 50, (97, 3)).astype(float)
    series, split = _series(spark, data)
    cut = math.floor(97 * 0.8)
    want = {}
    for name, part in (("train", data[:cut]), ("val", data[cut:])):
        for s in range(3):
            for i in range(len(part) - 14):
                want[s, name, i] = (list(part[i : i + 12, s]), list(part[i + 12 : i + 15, s]))
    got = tr.training_windows(series, split, chunk=chunk).collect()
    assert len(got) == len(want)
    assert {(r.sensor_id, r.split, r.start_idx): (r.x, r.y) for r in got} == want


def test_statistics_scaling_and_config(spark):
    data = np.arange(80, dtype=float).reshape(40, 2)
    series, split = _series(spark, data)
    assert tr.max_flow(series, split).first().max_flow == 63.0
    stats = {r.split: r for r in tr.dataset_stats(series, split).collect()}
    assert stats["train"].num_samples == 32 - 14 and stats["val"].num_samples == 8 - 14
    assert stats["train"].data_std == pytest.approx(data[:32].std()) and stats["val"].num_nodes == 2
    with pytest.raises(ValueError):
        tr.check_length(split)
    zero, zero_split = _series(spark, np.zeros((100, 1)))
    tr.check_length(zero_split)
    assert tr.max_flow(zero, zero_split).first().max_flow == 1.0
    config = sinks.model_config(series, split, canonical_nodes(series)).first()
    assert config.node_ids == ["0", "1"] and config.max_flow == 63.0 and config.num_nodes == 2
    x = F.lit(6.0)
    assert spark.range(1).select(tr.unscale(tr.scale(x, F.lit(4.0)), F.lit(4.0))).first()[0] == 6.0


def test_batches(spark):
    _, split = _series(spark, np.ones((200, 1)))
    rows = tr.training_batches(split, batch_size=32, seed=3).collect()
    for name, steps in (("train", 160), ("val", 40)):
        mine = [r for r in rows if r.split == name]
        assert sorted(r.start_idx for r in mine) == list(range(steps - 14))
        assert sorted(r.batch * 32 + r.slot for r in mine) == list(range(steps - 14))
    val = sorted((r.batch, r.slot, r.start_idx) for r in rows if r.split == "val")
    assert [v[2] for v in val] == list(range(26))
    train = [r.start_idx for r in sorted((r for r in rows if r.split == "train"), key=lambda r: (r.batch, r.slot))]
    assert train != sorted(train)


def test_within_day(spark):
    rows = [(0, d * 1440 + h * 60, 1.0) for d in range(6) for h in range(20)]
    df = cells(spark, rows)
    buckets = index(df)
    series, split = tr.to_series(df, buckets), tr.chrono_split(buckets)
    windows = tr.training_windows(series, split, within_day=True)
    assert windows.where("split = 'train'").count() == 4 * 6 + 2
    assert windows.where("split = 'val'").count() == 20 - 14 + 0


def test_metrics(spark):
    rng = random.Random(2)
    rows = [(rng.randint(1, 3), rng.random() * 50, float(rng.randrange(4))) for _ in range(300)]
    df = spark.createDataFrame(rows, "horizon INT, flow DOUBLE, actual DOUBLE")
    for r in evaluate.forecast_metrics(df).collect():
        mine = [(f, a) for h, f, a in rows if r.horizon in (0, h)]
        assert r.n == len(mine)
        assert r.mae == pytest.approx(sum(abs(f - a) for f, a in mine) / len(mine))
        assert r.rmse == pytest.approx(math.sqrt(sum((f - a) ** 2 for f, a in mine) / len(mine)))
        share = [abs(f - a) / a for f, a in mine if a]
        assert r.mape == pytest.approx(100 * sum(share) / len(share))


def _graph_case(spark, steps=160):
    at_ = np.arange(steps)
    rng = np.random.default_rng(4)
    data = np.stack([50 + 30 * np.sin(at_ / 4 + p) for p in (0.0, 0.7, 1.4, 2.0)], axis=1) + rng.normal(size=(steps, 4))
    series, split = _series(spark, data)
    # Sensor 3 has no neighbour.
    graph = stage(edges(spark, [(0, 1, 1, 1), (1, 0, 1, 1), (1, 2, 1, 1), (2, 1, 1, 1)]).coalesce(1), "edges")
    return data, series, split, graph


def test_graph_model_beats_persistence(spark):
    _, series, split, graph = _graph_case(spark)
    factor = tr.max_flow(series, split).scalar()
    encoding = spark.createDataFrame([(0, 0.1), (1, -0.2), (2, 0.1)], "sensor_id BIGINT, pe0 DOUBLE")
    model, scored = fc.train_and_score(series, split, graph, factor=factor, reg_params=(0.0,), encoding=encoding)
    val = tr.training_windows(series, split, factor=factor).where("split = 'val'")
    assert len(model.coefficients) == 15 and scored.count() == 3 * val.count()
    assert scored.where("flow IS NULL OR isnan(flow)").count() == 0
    mine = evaluate.forecast_metrics(scored).where("horizon = 0").first().mae
    naive = evaluate.forecast_metrics(fc.persistence_scores(val)).where("horizon = 0").first().mae
    assert mine < naive / 3


@pytest.mark.parametrize("input_len, neighbor_steps, chunk", [(12, 2, 1024), (12, 2, 20), (3, 1, 7), (1, 0, 1024)])
def test_graph_model_like_least_squares(spark, input_len, neighbor_steps, chunk):
    """Coefficients and recursive forecasts of all penalties against plain loops."""
    data, series, split, graph = _graph_case(spark, 90)
    near = {0: [1], 1: [0, 2], 2: [1]}
    cut, regs = math.floor(90 * 0.8), (0.0, 0.1)

    def mean(values, s):
        return np.mean([values[n] for n in near[s]]) if s in near else values[s]

    def features(past, means):
        return [*past[-input_len:], *means[::-1][:neighbor_steps]]

    x, y = [], []
    for i in range(cut - input_len - 2):
        for s in range(4):
            means = [mean(data[j], s) for j in range(i, i + input_len)]
            x.append(features(list(data[i : i + input_len, s]), means))
            y.append(data[i + input_len, s])
    x, y = np.array(x), np.array(y)
    found = fc.candidates(series, split, graph, input_len=input_len, reg_params=regs, neighbor_steps=neighbor_steps, chunk=chunk)
    val = data[cut:]
    for reg, (mae, model, scored) in zip(regs, found, strict=True):
        center = x - x.mean(axis=0)
        root = np.sqrt(reg * len(x)) * np.diag(center.std(axis=0))
        w = np.linalg.lstsq(np.vstack([center, root]), np.concatenate([y - y.mean(), np.zeros(len(root))]), rcond=None)[0]
        b = y.mean() - x.mean(axis=0) @ w
        assert np.allclose(model.coefficients, w, atol=1e-6) and abs(model.intercept - b) < 1e-5
        want = {}
        for i in range(len(val) - input_len - 2):
            past = [list(val[i : i + input_len, s]) for s in range(4)]
            means = [[mean(val[j], s) for j in range(i, i + input_len)] for s in range(4)]
            for h in range(3):
                flows = [max(0.0, np.dot(w, features(past[s], means[s])) + b) for s in range(4)]
                for s in range(4):
                    past[s].append(flows[s])
                    means[s].append(mean(flows, s))
                    want[s, i, h + 1] = (flows[s], val[i + input_len + h, s])
        got = {(r.sensor_id, r.start_idx, r.horizon): (r.flow, r.actual) for r in scored.collect()}
        assert got.keys() == want.keys()
        assert all(np.allclose(got[k], want[k], atol=1e-6) for k in want)
        assert mae == pytest.approx(np.mean([abs(f - a) for f, a in want.values()]))


def test_chunks_take_the_panel_s_room(spark):
    data = np.random.default_rng(0).normal(size=(3000, 2))
    series, split = _series(spark, data)
    chunks = tr.chunked_series(series, split, 15).collect()
    assert sum(len(r.value) for r in chunks) <= 1.1 * data.size and all(not r.gaps for r in chunks)


def test_windows_skip_gaps(spark):
    data = np.arange(400, dtype=float).reshape(200, 2)
    series, split = _series(spark, data)
    holes = {(0, 30), (0, 31), (1, 99), (1, 0)}
    kept = series.where(" AND ".join(f"NOT (sensor_id = {s} AND pos = {p})" for s, p in holes))
    want = {(s, i) for s in range(2) for i in range(160 - 14) if not any((s, p) in holes for p in range(i, i + 15))}
    for chunk in (16, 50, 1024):
        got = tr.training_windows(kept, split, chunk=chunk).where("split = 'train'").collect()
        assert {(r.sensor_id, r.start_idx) for r in got} == want
        assert all(r.x == [float(2 * (r.start_idx + j) + r.sensor_id) for j in range(12)] for r in got)


def test_windows_are_chosen_per_chunk(spark):
    """No lambda runs for each window: gaps and changes of day are struck out of a chunk's offsets."""
    rows = [(0, d * 1440 + h * 60, 1.0) for d in range(6) for h in range(20) if (d, h) != (2, 9)] + [(1, 2 * 1440 + 9 * 60, 1.0)]
    df = cells(spark, rows)
    series, split = tr.to_series(df, index(df)), tr.chrono_split(index(df))
    chunks = stage(tr.chunked_series(series.where("sensor_id = 0"), split, 15, chunk=20), "chunks")
    windows = tr.chunk_windows(chunks, within_day=True, chunk=20)
    assert "exists(" not in windows._jdf.queryExecution().optimizedPlan().toString()
    want = {(s.split, s.start_idx) for s in tr.chunk_windows(chunks, chunk=20).collect()}
    got = {(s.split, s.start_idx) for s in windows.collect()}
    assert got == {("train", d * 20 + i) for d in (0, 1, 3) for i in range(6)} | {("train", 80 + i) for i in range(2)} | {("val", 4 + i) for i in range(6)} & got
    assert got < want and not any(s == "train" and i <= 49 < i + 15 for s, i in want)


@pytest.mark.parametrize("batch", [2, 10000])
def test_array_means_like_loops(spark, batch):
    rng = random.Random(5)
    pick = lambda: rng.choice([None, float("nan"), *[rng.random() for _ in range(6)]])
    rows = [(s, "val", c, [pick() for _ in range(rng.randrange(5))]) for s in range(9) for c in range(2)] + [(9, "val", 0, None)]
    links = [(a, b, rng.choice([0, 1, 1]), 1) for a in range(11) for b in range(10) if a < 3 or a == b or rng.random() < 0.3]
    df = spark.createDataFrame(rows, "sensor_id BIGINT, split STRING, chunk BIGINT, value array<double>")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = {(r.sensor_id, r.chunk): r.value for r in fc.array_means(df, edges(spark, links), ["split", "chunk"], ["value"]).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    values = {(s, c): v or [] for s, _, c, v in rows}
    want = {}
    for a in range(11):
        for c in range(2):
            near = [values[b, c] for x, b, w, _ in links if x == a and w > 0 and b != a and (b, c) in values]
            if near:
                cols = [[v[i] for v in near if len(v) > i and v[i] is not None] for i in range(max(map(len, near)))]
                want[a, c] = [sum(x) / len(x) if x else None for x in cols]
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k], nan_ok=True)
