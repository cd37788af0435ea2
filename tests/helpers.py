"""Small fixtures and plain-Python models of the operators."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from sensorgrid.operators.panel import bucket_index
from sensorgrid.staging import stage

BASE = datetime(2024, 1, 1, tzinfo=timezone.utc)


def at(minutes: float, base: datetime = BASE) -> datetime:
    return base + timedelta(minutes=minutes)


def utc(value: datetime) -> datetime:
    """Collected timestamps are naive in the session zone, which the tests set to UTC."""
    return value if value.tzinfo else value.replace(tzinfo=timezone.utc)


def cells(spark, rows):
    """``rows`` of (sensor, minute, value), written like the cells of a job."""
    return stage(
        spark.createDataFrame(
            [(s, at(m), v) for s, m, v in rows], "sensor_id BIGINT, bucket TIMESTAMP, value DOUBLE"
        ).coalesce(1),
        "cells",
    )


def index(df):
    return stage(bucket_index(df, "UTC").coalesce(1), "buckets")


def edges(spark, rows):
    """``rows`` of (src, dst, weight, distance)."""
    return spark.createDataFrame(
        [(a, b, float(w), None if d is None else float(d)) for a, b, w, d in rows],
        "src BIGINT, dst BIGINT, weight DOUBLE, distance DOUBLE",
    )


def nodes(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "node_id BIGINT")


def as_dict(df, key, value="value"):
    return {tuple(utc(r[k]) if isinstance(r[k], datetime) else r[k] for k in key): r[value] for r in df.collect()}


def temporal_model(rows, limit=12):
    """Layer 1 for (sensor, minute, value) rows on UTC days: {(sensor, minute): value}."""
    minutes = sorted({m for _, m, _ in rows})
    out = {}
    for sensor in {s for s, _, _ in rows}:
        given = {m: v for s, m, v in rows if s == sensor and v is not None}
        series = [given.get(m) for m in minutes]
        runs, i = {}, 0
        while i < len(series):
            j = i
            while j < len(series) and (series[j] is None) == (series[i] is None):
                j += 1
            for k in range(i, j):
                runs[k] = j - i
            i = j
        for i, m in enumerate(minutes):
            if series[i] is not None:
                out[sensor, m] = series[i]
                continue
            day = [k for k, o in enumerate(minutes) if o // 1440 == m // 1440]
            prev = [k for k in day if k < i and series[k] is not None]
            after = [k for k in day if k > i and series[k] is not None]
            value = None
            if runs[i] <= limit:
                if prev and after:
                    a, b = prev[-1], after[0]
                    value = series[a] + (series[b] - series[a]) * (i - a) / (b - a)
                elif prev:
                    value = series[prev[-1]]
                elif after:
                    value = series[after[0]]
            out[sensor, m] = value
    return out


def count(df):
    return df.agg(F.count(F.lit(1))).first()[0]
