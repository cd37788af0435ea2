"""Null counts, imputation accounting and the health report."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sensorgrid.functions import parse_duration

LAYERS = ("observed", "temporal", "spatial", "historical", "global", "none")


def null_counts(panel: DataFrame) -> DataFrame:
    """``sensor_id, cells, nulls``."""
    return panel.groupBy("sensor_id").agg(
        F.count(F.lit(1)).alias("cells"), F.count_if(F.col("value").isNull()).alias("nulls")
    )


def sparse_null_counts(cells: DataFrame, buckets: DataFrame) -> DataFrame:
    """``null_counts`` of the dense panel without building it: buckets minus observed cells."""
    total = buckets.agg(F.count(F.lit(1)).alias("n")).scalar()
    observed = cells.groupBy("sensor_id").agg(F.count("value").alias("observed"))
    return observed.select("sensor_id", total.alias("cells"), (total - F.col("observed")).alias("nulls"))


def null_pct_by_sensor(counts: DataFrame) -> DataFrame:
    return counts.withColumn("null_pct", F.col("nulls") * 100.0 / F.col("cells"))


def top_missing(counts: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` sensors with the highest null share; equal shares in id order."""
    return null_pct_by_sensor(counts).orderBy(F.desc("null_pct"), "sensor_id").limit(n)


def imputation_report(panel: DataFrame) -> DataFrame:
    """``step, layer, fixed, remaining, sparsity_pct`` from one pass over ``filled_by``.

    Step 0 is the panel before imputation; the last step is what no layer could fill.
    """
    counted = panel.groupBy("filled_by").agg(F.count(F.lit(1)).alias("n"))
    sums = counted.agg(
        F.sum("n").alias("cells"),
        *[F.coalesce(F.sum(F.when(F.col("filled_by") == k, F.col("n"))), F.lit(0)).alias(k) for k in LAYERS],
    )
    rows = []
    remaining = F.col("cells") - F.col("observed")
    for step, layer in enumerate(LAYERS[:-1]):
        fixed = F.lit(0).cast("bigint") if layer == "observed" else F.col(layer)
        if layer != "observed":
            remaining = remaining - F.col(layer)
        rows.append(
            F.struct(
                F.lit(step).alias("step"),
                F.lit("initial" if layer == "observed" else layer).alias("layer"),
                fixed.alias("fixed"),
                remaining.alias("remaining"),
                F.try_divide(remaining * 100.0, F.col("cells")).alias("sparsity_pct"),
            )
        )
    return sums.select(F.inline(F.array(*rows)))


def health_report(
    cells: DataFrame, buckets: DataFrame, interval: str
) -> DataFrame:
    """One row: shape, time range, sparsity and the timeline check.

    ``expected_rows_span`` counts all steps between the first and last bucket;
    ``expected_rows_active`` counts the steps between the first and last time of day seen, on
    the days seen.  ``gap`` is set if rows fall short of the span count by more than 2.
    """
    step = parse_duration(interval)
    timeline = buckets.agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("bucket").alias("first_bucket"),
        F.max("bucket").alias("last_bucket"),
        F.count_distinct("local_date").alias("days"),
        (F.max("tod") - F.min("tod")).alias("tod_span"),
    )
    observed = cells.groupBy("sensor_id").agg(F.count("value").alias("n")).agg(
        F.count(F.lit(1)).alias("sensors"), F.sum("n").alias("observed")
    )
    total = F.col("rows") * F.col("sensors")
    span = F.unix_micros("last_bucket") - F.unix_micros("first_bucket")
    return timeline.select(
        "*",
        observed.select("sensors").scalar().alias("sensors"),
        observed.select("observed").scalar().alias("observed"),
    ).select(
        "rows",
        "sensors",
        "first_bucket",
        "last_bucket",
        (total - F.col("observed")).alias("nulls"),
        F.try_divide((total - F.col("observed")) * 100.0, total).alias("sparsity_pct"),
        (F.floor(span / F.lit(step)) + 1).alias("expected_rows_span"),
        (F.col("days") * (F.floor(F.col("tod_span").cast("bigint") * F.lit(1_000_000) / F.lit(step)) + 1)).alias(
            "expected_rows_active"
        ),
    ).withColumn("gap", F.col("rows") < F.col("expected_rows_span") - 2)
