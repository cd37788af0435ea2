"""Forecast errors and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def forecast_metrics(scored: DataFrame) -> DataFrame:
    """``horizon, n, mae, rmse, mape``; ``horizon = 0`` is the overall row.

    ``scored(horizon, flow, actual)``.  Errors are summed per horizon once and the overall row
    is made from those sums; MAPE leaves out actual values of 0.
    """
    error = F.col("flow") - F.col("actual")
    share = F.try_divide(F.abs(error), F.abs("actual"))
    sums = scored.groupBy("horizon").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.abs(error)).alias("abs_sum"),
        F.sum(error * error).alias("sq_sum"),
        F.sum(share).alias("share_sum"),
        F.count(share).alias("share_n"),
    )
    both = sums.select(F.explode(F.array("horizon", F.lit(0))).alias("horizon"), *sums.columns[1:])
    total = both.groupBy("horizon").agg(*[F.sum(c).alias(c) for c in sums.columns[1:]])
    return total.select(
        "horizon",
        "n",
        (F.col("abs_sum") / F.col("n")).alias("mae"),
        F.sqrt(F.col("sq_sum") / F.col("n")).alias("rmse"),
        (F.try_divide(F.col("share_sum"), F.col("share_n")) * 100.0).alias("mape"),
    )


def prediction_stats(predictions: DataFrame) -> DataFrame:
    return predictions.agg(
        F.count("flow").alias("n"),
        F.avg("flow").alias("mean"),
        F.stddev_pop("flow").alias("std"),
        F.min("flow").alias("min"),
        F.max("flow").alias("max"),
    )
