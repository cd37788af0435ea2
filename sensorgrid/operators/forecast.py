"""Short-horizon forecasts: persistence, and a global linear model on the graph.

The linear model keeps the task of a graph network for such data (12 steps in, 3 steps
out, neighbours at t and t-1, recursive decoding) in a form that is trained and scored as
Spark jobs: one model for all sensors, with only its coefficients on the driver.

Windows are never written out: a window is an offset into a chunk of ``chunked_series``, and tasks
work on the chunks' arrays.  One pass adds up the products of all features and the target; the
normal equations of every penalty are solved from this one matrix.  All penalties are decoded
together, step by step, and only the forecasts of a step are exchanged between neighbours.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from sensorgrid.functions import parse_duration
from sensorgrid.operators.graph import join_links, neighbors
from sensorgrid.operators.training import CHUNK, chunked_series
from sensorgrid.staging import reads, release, stage


def forecast_persistence(
    snapshot: DataFrame,
    nodes: DataFrame,
    steps: int = 12,
    interval: str = "5m",
    noise_std: float = 0.0,
    seed: int = 42,
    low: float | None = None,
    high: float | None = None,
) -> DataFrame:
    """``timestamp, target_ts, node_id, pos, horizon, flow``: the newest flow of each node for
    every step.  A node without a flow counts as 0.0.

    ``timestamp`` is the newest window.  ``noise_std`` adds normal noise; then flows are kept
    within ``low`` and ``high``, where given.
    """
    newest = snapshot.agg(F.max("window_start").alias("w")).scalar()
    last = snapshot.where(F.col("window_start") == newest).select("node_id", "flow")
    width = parse_duration(interval)
    flow: Column = F.coalesce(F.col("flow"), F.lit(0.0))
    if noise_std:
        flow = flow + F.randn(seed) * F.lit(noise_std)
    if high is not None:
        flow = F.least(F.lit(float(high)), flow)
    if low is not None:
        flow = F.greatest(F.lit(float(low)), flow)
    return (
        nodes.join(last, "node_id", "left")
        .select(
            newest.alias("timestamp"),
            "node_id",
            "pos",
            F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("horizon"),
            "flow",
        )
        .select(
            "timestamp",
            F.timestamp_micros(
                F.unix_micros("timestamp") + F.col("horizon").cast("bigint") * F.lit(width)
            ).alias("target_ts"),
            "node_id",
            "pos",
            "horizon",
            flow.alias("flow"),
        )
    )


def persistence_scores(windows: DataFrame, factor: Column | None = None) -> DataFrame:
    """``sensor_id, start_idx, horizon, flow, actual`` of "repeat the last input"."""
    size = F.lit(1.0) if factor is None else factor
    return windows.select(
        "sensor_id",
        "start_idx",
        F.element_at("x", -1).alias("last"),
        F.posexplode("y").alias("h", "actual"),
    ).select(
        "sensor_id",
        "start_idx",
        (F.col("h") + 1).alias("horizon"),
        (F.col("last") * size).alias("flow"),
        (F.col("actual") * size).alias("actual"),
    )


def neighbor_means(values: DataFrame, edges: DataFrame, key: list[str], **means: Column) -> DataFrame:
    """Mean of each named expression over the neighbours of a sensor, per remaining key."""
    links = neighbors(edges).select(F.col("src").alias("_owner"), F.col("dst").alias("sensor_id"))
    named = values.select("sensor_id", *key, *[c.alias(n) for n, c in means.items()])
    return (
        join_links(named, links, "sensor_id", key[-1])
        .groupBy(F.col("_owner").alias("sensor_id"), *key)
        .agg(*[F.avg(n).alias(n) for n in means])
    )


def array_means(rows: DataFrame, edges: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """Means over the neighbours of a sensor, place by place, of arrays of doubles, per remaining key.

    ``rows`` has a row per ``sensor_id`` and key; arrays may differ in length and hold nulls, which do
    not count.  Arrays are sent whole; a task goes through those of a sensor one by one and holds a sum.
    """
    links = neighbors(edges).select(F.col("src").alias("_owner"), F.col("dst").alias("sensor_id"))
    keys = ["sensor_id", *key]
    sent = join_links(rows.select(*keys, *columns), links, "sensor_id", key[-1])
    sent = sent.select(F.col("_owner").alias("sensor_id"), *key, *columns).repartition(*keys).sortWithinPartitions(*keys)

    def run(batches):
        at, sums = None, []
        done: list[tuple] = []
        for batch in batches:
            held = [_flat(batch.column(batch.schema.get_field_index(c))) for c in columns]
            marks = list(zip(*[batch.column(batch.schema.get_field_index(k)).to_pylist() for k in keys], strict=True))
            for i, mark in enumerate(marks):
                if mark != at:
                    if at is not None:
                        done.append((at, sums))
                    at, sums = mark, [(np.zeros(0), np.zeros(0, int)) for _ in columns]
                sums = [_added(s, *[v[o[i] : o[i + 1]] for v in (values, known)]) for s, (values, known, o) in zip(sums, held, strict=True)]
            if done:
                yield _mean_batch(done, schema, len(keys))
                done = []
        if at is not None:
            yield _mean_batch([(at, sums)], schema, len(keys))

    schema = to_arrow_schema(sent.schema)
    return sent.mapInArrow(run, sent.schema)


def _flat(arrays: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All values, which of them are known, and where each array begins and ends."""
    sizes = np.asarray(pc.fill_null(pc.list_value_length(arrays), 0).to_numpy(zero_copy_only=False), int)
    values = arrays.flatten()
    known = values.is_valid().to_numpy(zero_copy_only=False)
    return values.fill_null(0.0).to_numpy(zero_copy_only=False), known, np.concatenate([[0], np.cumsum(sizes)])


def _added(to: tuple[np.ndarray, np.ndarray], values: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    total, n = to
    if len(total) < len(values):
        total, n = np.pad(total, (0, len(values) - len(total))), np.pad(n, (0, len(values) - len(n)))
        return total + values, n + known
    total[: len(values)] += values
    n[: len(values)] += known
    return total, n


def _mean_batch(done: list[tuple], schema: pa.Schema, keys: int) -> pa.RecordBatch:
    out = [pa.array([mark[i] for mark, _ in done], schema.field(i).type) for i in range(keys)]
    for c in range(len(done[0][1])):
        totals, counts = np.concatenate([s[c][0] for _, s in done]), np.concatenate([s[c][1] for _, s in done])
        means = pa.array(totals / np.maximum(counts, 1), pa.float64(), mask=counts == 0)
        ends = np.concatenate([[0], np.cumsum([len(s[c][0]) for _, s in done])]).astype(np.int32)
        out.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), means))
    return pa.RecordBatch.from_arrays(out, names=schema.names)


def model_chunks(
    series: DataFrame, split: DataFrame, edges: DataFrame, factor: Column | None = None, input_len: int = 12, output_len: int = 3,
    encoding: DataFrame | None = None, chunk: int = CHUNK,
) -> DataFrame:
    """``chunked_series`` of the values and the neighbours' means beside them (a sensor without
    neighbours uses its own values), with the columns of ``encoding``."""
    key = ["sensor_id", "split", "chunk"]
    chunks = stage(chunked_series(series, split, input_len + output_len, factor, chunk), "chunks")
    means = array_means(chunks, edges, key[1:], ["value"]).withColumnRenamed("value", "near")
    nb = F.transform("value", lambda v, i: F.coalesce(F.get("near", i), v))
    chunks = reads(chunks.join(means, key, "left").withColumn("nb", F.when(F.col("near").isNull(), F.col("value")).otherwise(nb)).drop("near"), chunks)
    if encoding is not None:
        rows = chunks.join(encoding, "sensor_id", "left").fillna(0.0, [c for c in encoding.columns if c != "sensor_id"])
        chunks = reads(rows, *chunks._reads)
    return chunks


@dataclass(frozen=True)
class GraphModel:
    """Coefficients of the linear model: the lags oldest first, then the neighbours' means, newest
    first, then the encoding columns."""

    coefficients: tuple[float, ...]
    intercept: float
    input_len: int
    neighbor_steps: int = 2
    extra: tuple[str, ...] = ()
    reg_param: float = 0.0

    def predict(self, features: np.ndarray) -> np.ndarray:
        return np.maximum(features @ np.array(self.coefficients) + self.intercept, 0.0)


def _offsets(row, need: int, chunk: int) -> np.ndarray:
    """Offsets of the windows of a chunk; of those without a gap only."""
    out = np.arange(max(0, min(len(row.value) - need + 1, chunk)))
    for gap in row.gaps:
        out = out[(out + need <= gap) | (out > gap)]
    return out


def _features(row, at: np.ndarray, past: list[np.ndarray], near: list[np.ndarray], shape: tuple[int, int, tuple[str, ...]]) -> np.ndarray:
    """Features of the step after ``past``: earlier forecasts and their neighbours' means."""
    input_len, neighbor_steps, extra = shape
    value, nb, h = np.asarray(row.value, float), np.asarray(row.nb, float), len(past)
    lags = [value[at + i] for i in range(h, input_len)] + past[max(0, h - input_len) :]
    means = (near[::-1] + [nb[at + input_len - 1 - i] for i in range(neighbor_steps)])[:neighbor_steps]
    return np.column_stack([*lags, *means, *[np.full(len(at), float(getattr(row, e))) for e in extra]])


def _moments(chunks: DataFrame, shape: tuple[int, int, tuple[str, ...]], need: int, chunk: int) -> np.ndarray:
    """Sums of products of a one, the features and the target over all training windows, one
    partial sum per task, added up in Spark."""
    width = 2 + shape[0] + shape[1] + len(shape[2])

    def partial(frames):
        total = np.zeros((width, width))
        for frame in frames:
            for row in frame.itertuples():
                at = _offsets(row, need, chunk)
                if len(at):
                    x = _features(row, at, [], [], shape)
                    block = np.column_stack([np.ones(len(at)), x, np.asarray(row.value, float)[at + shape[0]]])
                    total += block.T @ block
        yield pd.DataFrame({"i": np.arange(width * width), "v": total.ravel()})

    names = ["value", "nb", "gaps", *shape[2]]
    parts = chunks.where("split = 'train'").select(*names).mapInPandas(partial, "i INT, v DOUBLE")
    out = np.zeros(width * width)
    for row in parts.groupBy("i").agg(F.sum("v").alias("v")).collect():
        out[row["i"]] = row["v"]
    return out.reshape(width, width)


def solve(moments: np.ndarray, reg_param: float) -> tuple[np.ndarray, float]:
    """Coefficients and intercept that minimise the mean squared error / 2 plus ``reg_param`` / 2 times
    the squares of the coefficients in units of the features' deviations."""
    mean = moments[0] / max(moments[0, 0], 1.0)
    cov = moments / max(moments[0, 0], 1.0) - np.outer(mean, mean)
    x, y = slice(1, -1), -1
    left = cov[x, x] + reg_param * np.diag(np.diag(cov[x, x]))
    # Constant features have no variance; the shortest solution gives them no weight.
    weights = np.linalg.lstsq(left, cov[x, y], rcond=1e-12)[0]
    return weights, float(mean[y] - mean[x] @ weights)


def fit(
    chunks: DataFrame, input_len: int = 12, output_len: int = 3, extra: tuple[str, ...] = (), reg_params: tuple[float, ...] = (0.0,),
    neighbor_steps: int = 2, chunk: int = CHUNK,
) -> list[GraphModel]:
    """A linear model for the next step of every sensor for each penalty (one pass over the chunks)."""
    shape = (input_len, neighbor_steps, extra)
    moments = _moments(chunks, shape, input_len + output_len, chunk)
    out = []
    for reg in reg_params:
        weights, intercept = solve(moments, reg)
        out.append(GraphModel(tuple(map(float, weights)), intercept, input_len, neighbor_steps, extra, reg))
    return out


def _decode(models: list[GraphModel], step: int, need: int, chunk: int, names: list[str]):
    """Adds the forecasts of a step, an array of each model by window, to the rows of chunks."""
    first = models[0]
    shape = (first.input_len, first.neighbor_steps, first.extra)

    def run(frames):
        for frame in frames:
            new = [[] for _ in models]
            for row in frame.itertuples():
                at = _offsets(row, need, chunk)
                for m, model in enumerate(models):
                    past = [np.asarray(getattr(row, f"p{h}_{m}"), float) for h in range(1, step)]
                    near = [np.asarray(getattr(row, f"nb{h}_{m}"), float) for h in range(1, step)]
                    new[m].append(model.predict(_features(row, at, past, near, shape)) if len(at) else np.zeros(0))
            for m in range(len(models)):
                frame[f"p{step}_{m}"] = new[m]
            yield frame[[*names, *[f"p{step}_{m}" for m in range(len(models))]]]

    return run


def _own_offsets(need: int, chunk: int) -> Column:
    """The offsets of ``_offsets`` as an array."""
    top = F.least(F.size("value") - need, F.lit(chunk - 1))
    clear = lambda o: ~F.exists("gaps", lambda g: (g >= o) & (g < o + need))
    return F.when(top >= 0, F.filter(F.sequence(F.lit(0), top), clear)).otherwise(F.array().cast("array<int>"))


def _spread(offsets: Column, values: Column) -> Column:
    """Values placed at their offsets, with nulls between."""
    slots = F.sequence(F.lit(0), F.array_max(offsets))
    return F.when(F.size(offsets) > 0, F.transform(slots, lambda o: F.get(values, F.array_position(offsets, o).cast("int") - 1)))


def _at(offsets: Column, near: Column, values: Column) -> Column:
    """The neighbours' values at these offsets, own ones where there is none."""
    return F.when(near.isNull(), values).otherwise(F.zip_with(offsets, values, lambda o, v: F.coalesce(F.get(near, o), v)))


def score(chunks: DataFrame, edges: DataFrame, models: list[GraphModel], steps: int = 3, output_len: int = 3, chunk: int = CHUNK) -> DataFrame:
    """``sensor_id, split, start_idx, horizon, model, flow, actual`` of each model, by its place in
    the list; each step is fed by the one before (runs a job per step; a staged table)."""
    need = models[0].input_len + output_len
    key = ["sensor_id", "split", "chunk"]
    state, kept = chunks, []
    for step in range(1, steps + 1):
        made = [f"p{step}_{m}" for m in range(len(models))]
        schema = ", ".join([f"`{n}` {t}" for n, t in state.dtypes] + [f"{n} array<double>" for n in made])
        state = stage(state.mapInPandas(_decode(models, step, need, chunk, state.columns), schema), "decode")
        kept.append(state)
        if step < steps:
            own = _own_offsets(need, chunk)
            # By offset, so that those of neighbours meet also where some windows have gaps.
            spread = [F.when(F.size("gaps") == 0, F.col(n)).otherwise(_spread(own, F.col(n))).alias(n) for n in made]
            near = array_means(state.select(*key, *spread), edges, key[1:], made).toDF(*key, *[f"n{m}" for m in range(len(models))])
            columns = {f"nb{step}_{m}": _at(own, F.col(f"n{m}"), F.col(n)) for m, n in enumerate(made)}
            state = state.join(near, key, "left").withColumns(columns).drop(*[f"n{m}" for m in range(len(models))])
    parts = []
    for m in range(len(models)):
        zipped = F.arrays_zip(_own_offsets(need, chunk).alias("o"), *[F.col(f"p{h}_{m}").alias(f"p{h}") for h in range(1, steps + 1)])
        rows = state.select("sensor_id", "split", "first", "value", F.inline(zipped))
        flows = F.array(*[F.struct(F.lit(h).alias("horizon"), F.col(f"p{h}").alias("flow")) for h in range(1, steps + 1)])
        parts.append(
            rows.select("sensor_id", "split", (F.col("first") + F.col("o")).alias("start_idx"), "value", "o", F.inline(flows)).select(
                "sensor_id", "split", "start_idx", "horizon", F.lit(m).alias("model"), "flow",
                F.get("value", F.col("o") + models[0].input_len + F.col("horizon") - 1).alias("actual"),
            )
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    out = stage(out, "scores")
    release(*kept)
    return out


def candidates(
    series: DataFrame,
    split: DataFrame,
    edges: DataFrame,
    factor: Column | None = None,
    input_len: int = 12,
    steps: int = 3,
    reg_params: tuple[float, ...] = (0.0, 0.01),
    encoding: DataFrame | None = None,
    neighbor_steps: int = 2,
    chunk: int = CHUNK,
) -> list[tuple[float, GraphModel, DataFrame]]:
    """Validation MAE, model and validation scores for each penalty (runs jobs)."""
    extra = () if encoding is None else tuple(c for c in encoding.columns if c != "sensor_id")
    made = model_chunks(series, split, edges, factor, input_len, steps, encoding, chunk)
    chunks = stage(made, "model-chunks")
    release(made)
    models = fit(chunks, input_len, steps, extra, reg_params, neighbor_steps, chunk)
    scored = score(chunks.where("split = 'val'"), edges, models, steps, steps, chunk)
    release(chunks)
    errors = {r.model: r.mae for r in scored.groupBy("model").agg(F.avg(F.abs(F.col("flow") - F.col("actual"))).alias("mae")).collect()}
    return [(errors.get(m, float("nan")), model, scored.where(F.col("model") == m).drop("model")) for m, model in enumerate(models)]


def train_and_score(series: DataFrame, split: DataFrame, edges: DataFrame, **options) -> tuple[GraphModel, DataFrame]:
    """The model with the lowest validation MAE of ``candidates``, and its validation scores."""
    _, model, scored = min(candidates(series, split, edges, **options), key=lambda r: r[0])
    return model, scored
