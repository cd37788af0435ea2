"""Written results."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sensorgrid.functions import local_date


def write_panel(panel: DataFrame, path: str, tz: str) -> None:
    """Long panel, one folder per local date.

    Dates are rebalanced by their size as it turns out at run time: a large date is written by many
    tasks, and small dates share one, so there are neither huge nor thousands of tiny files.
    """
    (
        panel.withColumn("local_date", local_date(F.col("bucket"), tz))
        .hint("rebalance", F.col("local_date"))
        .sortWithinPartitions("local_date", "sensor_id", "bucket")
        .write.mode("overwrite")
        .partitionBy("local_date")
        .parquet(path)
    )


def write_wide_panel(wide: DataFrame, path: str) -> None:
    wide.write.mode("overwrite").parquet(path)


def write_graph(edges: DataFrame, path: str) -> None:
    edges.write.mode("overwrite").parquet(path)


def model_config(
    panel: DataFrame,
    split: DataFrame,
    nodes: DataFrame,
    input_len: int = 12,
    output_len: int = 3,
    train_ratio: float = 0.8,
) -> DataFrame:
    """One configuration row: train maximum and node order.

    ``panel(sensor_id, pos, value)``, ``split(pos, split)``, ``nodes(node_id, pos)``.  The node
    list is the export form of the node table and is bounded by it.
    """
    from sensorgrid.operators.training import max_flow

    order = nodes.agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "node_id"))), lambda x: x.node_id)
        .alias("node_ids")
    )
    return max_flow(panel, split).select(
        "max_flow",
        nodes.agg(F.count(F.lit(1)).alias("n")).scalar().alias("num_nodes"),
        order.scalar().alias("node_ids"),
        F.lit(input_len).alias("input_len"),
        F.lit(output_len).alias("output_len"),
        F.lit(train_ratio).alias("train_ratio"),
    )


def write_config(config: DataFrame, path: str) -> None:
    config.coalesce(1).write.mode("overwrite").json(path)
