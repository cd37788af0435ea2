"""The data model derived from the driver's tables.

Sensors are the users of ``events``, readings its values on 10-minute ticks; alerts handed
from one sensor to the next form the graph.  Everything grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sensorgrid.functions import floor_to, from_utc_wall
from sensorgrid.operators import panel as p
from sensorgrid.operators.indexing import canonical_nodes
from sensorgrid.staging import stage

TZ = "+07:00"
INTERVAL = "1h"
TICK = "10m"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ``ts`` as an instant and ``k``, the number in ``props``."""
    return table(spark, sf_dir, "events").withColumns(
        {
            "ts": from_utc_wall(F.col("ts")),
            "k": F.get_json_object("props", "$.k").cast("int"),
        }
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        floor_to(F.col("ts"), TICK, "UTC").alias("ts"),
        F.col("user_id").alias("sensor_id"),
        F.col("value").alias("count"),
        F.when(F.col("event_type").isin("error", "signup"), "archive").otherwise("history").alias("source"),
        F.col("event_id").alias("seq"),
    )


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.resample(p.dedup_last(readings(spark, sf_dir)), INTERVAL, TZ)


def staged_cells(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Cells and their bucket index, each written once."""
    out = stage(cells(spark, sf_dir), "cells")
    return out, stage(p.bucket_index(out, TZ), "buckets")


def _hops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A strong alert (``error``) followed by a ``signup`` event hands over to that sensor."""
    ev = table(spark, sf_dir, "events")
    first = ev.where("event_type = 'error' AND value >= 50").select(
        F.col("user_id").alias("src"), F.col("value").alias("v1"), (F.col("event_id") + 1).alias("next_id")
    )
    second = ev.where("event_type = 'signup'").select(
        F.col("user_id").alias("dst"), F.col("value").alias("v2"), F.col("event_id").alias("next_id")
    )
    return first.join(second, "next_id").select(
        "src", "dst", F.abs(F.col("v1") - F.col("v2")).alias("gap")
    )


def directed_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _hops(spark, sf_dir)
        .groupBy("src", "dst")
        .agg(F.count(F.lit(1)).cast("double").alias("weight"), F.min("gap").alias("distance"))
    )


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Undirected graph: both directions carry the hops of the pair."""
    pairs = (
        _hops(spark, sf_dir)
        .groupBy(F.least("src", "dst").alias("lo"), F.greatest("src", "dst").alias("hi"))
        .agg(F.count(F.lit(1)).cast("double").alias("weight"), F.min("gap").alias("distance"))
    )
    forward = F.struct(F.col("lo").alias("src"), F.col("hi").alias("dst"))
    backward = F.struct(F.col("hi").alias("src"), F.col("lo").alias("dst"))
    ends = F.when(F.col("lo") == F.col("hi"), F.array(forward)).otherwise(F.array(forward, backward))
    return pairs.select(F.explode(ends).alias("e"), "weight", "distance").select(
        "e.src", "e.dst", "weight", "distance"
    )


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("node_id")).distinct()


def linked_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical order of the sensors that have an edge: ``node_id STRING, pos``."""
    ends = edges(spark, sf_dir).select(F.col("src").alias("sensor_id"))
    return canonical_nodes(ends)


def _payload() -> Column:
    """Message text; small values of ``k`` stand for the ways a message can be broken."""
    ms = F.unix_millis("ts").cast("string")
    user = F.col("user_id").cast("string")
    count = F.col("value").cast("string")
    tail = F.concat(F.lit(',"src":"e_'), F.col("event_id").cast("string"), F.lit('","ingest_ts":'), ms, F.lit("}"))

    def message(sensor: Column, number: Column, time: Column) -> Column:
        return F.concat(
            F.lit('{"sensor_id":'), sensor, F.lit(',"count":'), number, F.lit(',"ts":'), time, tail
        )

    quoted = F.concat(F.lit('"'), user, F.lit('"'))
    labelled = F.concat(F.lit('"node_'), F.lpad(user, 5, "0"), F.lit('"'))
    k = F.col("k")
    return (
        F.when(k == 0, F.concat(F.lit("corrupt "), user))
        .when(k == 1, F.concat(F.lit("["), user, F.lit("]")))
        .when(k == 2, F.concat(F.lit('{"sensor_id":'), quoted, F.lit(',"ts":'), ms, tail))
        .when(k == 3, message(quoted, F.lit("null"), ms))
        .when(k == 4, message(quoted, F.lit('"x"'), ms))
        .when(k == 5, message(quoted, count, F.lit("0")))
        .when(k == 6, message(labelled, count, ms))
        .when(k == 7, message(F.lit("null"), count, ms))
        .otherwise(message(quoted, count, ms))
    )


def messages(spark: SparkSession, sf_dir: str, ev: DataFrame | None = None) -> DataFrame:
    """Events in the layout of Spark's Kafka source.  Offsets are delayed by ``k``, so that
    messages arrive out of order."""
    rows = events(spark, sf_dir) if ev is None else ev
    return rows.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        _payload().cast("binary").alias("value"),
        F.lit("readings").alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        ((F.col("event_id") + F.col("k") * 5) * 1000 + F.col("k")).cast("bigint").alias("offset"),
        F.col("ts").alias("timestamp"),
    )
