"""Stored predictions: rows ``(timestamp, payload)`` with a JSON payload
``{timestamp, data: {node: flow}}``."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def latest_prediction(predictions: DataFrame, time: str = "timestamp", payload: str = "payload") -> DataFrame:
    """One row ``status, timestamp, data``: ``ok``, ``empty`` (nothing stored),
    ``old_format`` (data is a list) or ``invalid`` (not JSON, or data is no object)."""
    newest = predictions.agg(F.max_by(payload, time).alias("doc"))
    shape = F.get_json_object("doc", "$.data")
    status = (
        F.when(F.coalesce(F.col("doc"), F.lit("")) == "", "empty")
        .when(F.try_parse_json("doc").isNull(), "invalid")
        .when(F.startswith(shape, F.lit("[")), "old_format")
        .when(F.startswith(shape, F.lit("{")), "ok")
        .otherwise("invalid")
    )
    ok = F.col("status") == "ok"
    stamp = F.coalesce(F.get_json_object("doc", "$.timestamp"), F.lit(""))
    return newest.withColumn("status", status).select(
        "status",
        F.when(ok, stamp).when(F.col("status") == "empty", F.lit("")).alias("timestamp"),
        F.when(ok, F.from_json(shape, "map<string,double>"))
        .when(F.col("status") == "empty", F.from_json(F.lit("{}"), "map<string,double>"))
        .alias("data"),
    )
