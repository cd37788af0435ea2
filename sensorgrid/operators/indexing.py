"""Dense positions without a global single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from sensorgrid.staging import stage

#: Bits of a row's number in its partition, in ``monotonically_increasing_id``.
_ROW_BITS = 33


def dense_position(df: DataFrame, order: list[str], out: str = "pos") -> DataFrame:
    """0-based position of each row in the order of ``order`` (runs jobs).

    Rows are range-partitioned by the order columns, so partitions are even whatever the keys
    look like, and numbered as they are written; each partition is shifted by the sizes of
    those before it.  Only the table of partition sizes is ordered in one task.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = stage(ranged.withColumn("_id", F.monotonically_increasing_id()), "positions")
    part = F.shiftright("_id", _ROW_BITS)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    row = F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        rows.withColumn("_part", part)
        .join(offsets, "_part")
        .withColumn(out, (F.col("_offset") + row).cast("bigint"))
        .drop("_part", "_offset", "_id")
    )


def canonical_nodes(nodes: DataFrame, node: str = "sensor_id") -> DataFrame:
    """``node_id STRING, pos`` of the distinct nodes in text order (``1, 10, 100, 2``)."""
    ids = nodes.select(F.col(node).cast("string").alias("node_id")).distinct()
    return dense_position(ids, ["node_id"]).select("node_id", "pos")
