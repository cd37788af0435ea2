"""Snapshots of live messages, the last-N window and its alignment to a node order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sensorgrid.functions import floor_to, round_half_even
from sensorgrid.sources.messages import has_time, is_sample


def snapshot_groups(messages: DataFrame, bucket: Column) -> DataFrame:
    """``window_start, node_id, flow, num_samples, num_messages`` per bucket and sensor,
    including groups without a usable sample."""
    value = F.when(is_sample(), F.col("count").try_cast("double"))
    return (
        messages.where(has_time())
        .groupBy(bucket.alias("window_start"), F.col("sensor_id").cast("string").alias("node_id"))
        .agg(
            F.avg(value).alias("mean"),
            F.count(value).alias("num_samples"),
            F.count(F.lit(1)).alias("num_messages"),
        )
        .select(
            "window_start",
            "node_id",
            round_half_even(F.col("mean"), 2).alias("flow"),
            "num_samples",
            "num_messages",
        )
    )


def snapshots(messages: DataFrame, interval: str, tz: str) -> DataFrame:
    """``window_start, node_id, flow, num_samples``."""
    groups = snapshot_groups(messages, floor_to(F.timestamp_millis("ts"), interval, tz))
    return groups.where("num_samples > 0").drop("num_messages")


def snapshot_totals(messages: DataFrame, interval: str, tz: str) -> DataFrame:
    """``window_start, total_nodes, num_messages, num_valid``; ``num_messages`` counts unusable
    messages too."""
    groups = snapshot_groups(messages, floor_to(F.timestamp_millis("ts"), interval, tz))
    return groups.groupBy("window_start").agg(
        F.count_if(F.col("num_samples") > 0).alias("total_nodes"),
        F.sum("num_messages").alias("num_messages"),
        F.sum("num_samples").alias("num_valid"),
    )


def nest(snapshot: DataFrame) -> DataFrame:
    """Export form, one row per window with its list of nodes."""
    return snapshot.groupBy("window_start").agg(
        F.sort_array(F.collect_list(F.struct("node_id", "flow", "num_samples"))).alias("nodes"),
        F.count(F.lit(1)).alias("total_nodes"),
    )


def last_n_snapshots(snapshot: DataFrame, n: int = 12) -> DataFrame:
    """Rows of the ``n`` newest windows."""
    newest = snapshot.select("window_start").distinct().orderBy(F.desc("window_start")).limit(n)
    return snapshot.join(newest, "window_start", "left_semi")


def window_ready(snapshot: DataFrame, n: int = 12) -> DataFrame:
    """``current, ready, span_minutes`` of the last-N window."""
    newest = snapshot.select("window_start").distinct().orderBy(F.desc("window_start")).limit(n)
    return newest.agg(
        F.count(F.lit(1)).alias("current"),
        (F.count(F.lit(1)) >= n).alias("ready"),
        (
            (F.unix_micros(F.max("window_start")) - F.unix_micros(F.min("window_start"))) / 60_000_000
        ).alias("span_minutes"),
    )


def window_metadata(snapshot: DataFrame, n: int = 12, written: str | None = None) -> DataFrame:
    """``last_update, window_size, snapshot_timestamp``; no row for an empty table."""
    update = F.max(written) if written else F.max("window_start")
    return (
        snapshot.agg(update.alias("last_update"), F.max("window_start").alias("snapshot_timestamp"))
        .where("snapshot_timestamp IS NOT NULL")
        .select("last_update", F.lit(n).alias("window_size"), "snapshot_timestamp")
    )


def discover_nodes(snapshot: DataFrame) -> DataFrame:
    return snapshot.select("node_id").distinct()


#: Positions in a block of the model input.
BLOCK = 4096


def _windows_and_flows(snapshot: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``window_start, unknown, missing, n`` of each window, and ``window_start, pos, flow`` of its nodes."""
    total = nodes.agg(F.count(F.lit(1)).alias("n")).scalar()
    placed = snapshot.join(nodes.select("node_id", "pos"), "node_id", "left")
    windows = placed.groupBy("window_start").agg(F.count_if(F.col("pos").isNull()).alias("unknown"), F.count("pos").alias("seen"))
    windows = windows.withColumn("n", total).withColumn("missing", F.col("n") - F.col("seen")).drop("seen")
    return windows, placed.where("pos is not null").select("window_start", "pos", F.coalesce("flow", F.lit(0.0)).alias("flow"))


def _blocks(windows: DataFrame, block: int) -> DataFrame:
    """A row for each block of positions of each window: ``block, size`` beside its columns."""
    own = F.when(F.col("n") > 0, F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / block)))
    return windows.select("*", F.explode(own).alias("block")).withColumn(
        "size", F.least(F.lit(block).cast("long"), F.col("n") - F.col("block") * block).cast("int")
    )


def align_long(snapshot: DataFrame, nodes: DataFrame, block: int = BLOCK) -> DataFrame:
    """Model input as rows: ``window_start, pos, flow, unknown, missing`` for each window and each node
    of ``nodes(node_id, pos)``; a node without a flow counts as 0.0.

    Positions are generated block by block and meet the flows in a join, so no task holds a window.
    """
    windows, flows = _windows_and_flows(snapshot, nodes)
    start = F.col("block") * block
    grid = _blocks(windows, block).select(
        "window_start", "unknown", "missing", F.explode(F.sequence(start, start + F.col("size") - 1)).alias("pos")
    )
    return grid.join(flows, ["window_start", "pos"], "left").select(
        "window_start", "pos", F.coalesce("flow", F.lit(0.0)).alias("flow"), "unknown", "missing"
    )


def input_blocks(snapshot: DataFrame, nodes: DataFrame, block: int = BLOCK) -> DataFrame:
    """Model input as stored: ``window_start, block, unknown, missing, flows`` with the
    flows of ``block`` positions in the layout of a sparse vector (``type`` 0, ``size, indices, values``); a window is as many rows as its nodes need, none of unbounded size."""
    windows, flows = _windows_and_flows(snapshot, nodes)
    own = flows.groupBy("window_start", F.floor(F.col("pos") / block).alias("block")).agg(
        F.array_sort(F.collect_list(F.struct((F.col("pos") % block).cast("int").alias("i"), "flow"))).alias("seen")
    )
    rows = _blocks(windows, block).join(own, ["window_start", "block"], "left")
    vector = F.struct(
        F.lit(0).cast("tinyint").alias("type"), F.col("size").alias("size"),
        F.coalesce(F.col("seen.i"), F.array().cast("array<int>")).alias("indices"),
        F.coalesce(F.col("seen.flow"), F.array().cast("array<double>")).alias("values"),
    )
    return rows.select("window_start", "block", "unknown", "missing", vector.alias("flows"))


def align_to_nodes(snapshot: DataFrame, nodes: DataFrame) -> DataFrame:
    """Export form of the model input, a window per row: ``window_start, flows, unknown, missing`` with one flow per node of
    ``nodes(node_id, pos)`` in its order.

    A node without a flow counts as 0.0 and a sensor that is no node is ignored.  Per window
    only the observed flows are collected (at most one per node); the zeros between them
    are written from the distance of their positions.
    """
    total = nodes.agg(F.count(F.lit(1)).alias("n")).scalar()
    placed = snapshot.join(nodes.select("node_id", F.col("pos").cast("int").alias("pos")), "node_id", "left")
    grouped = placed.groupBy("window_start").agg(
        F.array_sort(
            F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", "flow")))
        ).alias("seen"),
        F.count_if(F.col("pos").isNull()).alias("unknown"),
    )

    def padded(item, i):
        before = F.when(i == 0, F.lit(-1)).otherwise(F.get(F.col("seen"), i - 1).pos)
        return F.concat(F.array_repeat(F.lit(0.0), item.pos - before - 1), F.array(F.coalesce(item.flow, F.lit(0.0))))

    last = F.coalesce(F.get(F.col("seen"), F.size("seen") - 1).pos, F.lit(-1))
    return grouped.withColumn("n", total).select(
        "window_start",
        F.concat(
            F.flatten(F.transform("seen", padded)),
            F.array_repeat(F.lit(0.0), (F.col("n") - last - 1).cast("int")),
        ).alias("flows"),
        "unknown",
        (F.col("n") - F.size("seen")).alias("missing"),
    )


def unknown_sensors(snapshot: DataFrame, nodes: DataFrame) -> DataFrame:
    """``window_start, unknown``: sensors of a window that are no nodes."""
    return (
        snapshot.join(nodes, "node_id", "left_anti")
        .groupBy("window_start")
        .agg(F.count(F.lit(1)).alias("unknown"))
    )


def missing_sensors(snapshot: DataFrame, nodes: DataFrame) -> DataFrame:
    """``window_start, missing``: nodes without a flow, counted as all nodes minus the known
    ones of the window."""
    total = nodes.agg(F.count(F.lit(1)).alias("n")).scalar()
    known = nodes.select("node_id", F.lit(1).alias("known"))
    return (
        snapshot.join(known, "node_id", "left")
        .groupBy("window_start")
        .agg(F.count("known").alias("seen"))
        .select("window_start", (total - F.col("seen")).alias("missing"))
    )


def format_predictions(predictions: DataFrame) -> DataFrame:
    """Export form of the first step: ``timestamp, data MAP<node, flow>``; a node without id
    is named by its position."""
    node = F.coalesce(F.col("node_id"), F.col("pos").cast("string"))
    return (
        predictions.where("horizon = 1")
        .groupBy("timestamp")
        .agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(node, "flow")))).alias("data"))
    )
