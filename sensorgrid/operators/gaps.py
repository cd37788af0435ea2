"""Gaps between observed cells, and what can be filled inside them.

A run of null cells is described by one row: the observed cells on both sides and the
number of null cells between them.  Rows are ordered per sensor *and day*; runs that cross
midnight come from a table with one row per sensor and day.  No task ever holds a whole
sensor's history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def find_gaps(cells: DataFrame, buckets: DataFrame) -> DataFrame:
    """``sensor_id, prev_pos, prev_value, next_pos, next_value, first_null, last_null, run``.

    At the ends of a sensor's series the missing side is NULL.  ``run`` counts null cells
    over the whole series, across days.  Cells with a NULL value count as missing; a sensor
    without any value is one gap over all buckets.
    """
    placed = cells.join(buckets.select("bucket", "local_date", "pos"), "bucket").select(
        "sensor_id", "local_date", "pos", "value"
    )
    # One shuffle serves both the order inside a day and the summary per day.
    placed = placed.repartition("sensor_id", "local_date")

    inside = Window.partitionBy("sensor_id", "local_date").orderBy("pos")
    daily = (
        placed.where("value IS NOT NULL")
        .select(
            "sensor_id",
            F.col("pos").alias("prev_pos"),
            F.col("value").alias("prev_value"),
            F.lead("pos").over(inside).alias("next_pos"),
            F.lead("value").over(inside).alias("next_value"),
            (F.col("pos") + 1).alias("first_null"),
            (F.lead("pos").over(inside) - 1).alias("last_null"),
        )
        .where("last_null >= first_null")
    )

    known = F.when(F.col("value").isNotNull(), F.col("pos"))
    ends = placed.groupBy("sensor_id", "local_date").agg(
        F.min(known).alias("first_pos"),
        F.min_by("value", known).alias("first_value"),
        F.max(known).alias("last_pos"),
        F.max_by("value", known).alias("last_value"),
    )
    # Days without any value come last, so the last day with one has no successor.
    empty = F.col("first_pos").isNull()
    across = Window.partitionBy("sensor_id").orderBy(empty, "local_date")
    total = buckets.agg(F.coalesce(F.max("pos") + 1, F.lit(0)).alias("n")).scalar()
    chained = ends.select(
        "*",
        F.lead("first_pos").over(across).alias("next_pos"),
        F.lead("first_value").over(across).alias("next_value"),
        F.row_number().over(across).alias("day_rank"),
    )
    no_pos, no_value = F.lit(None).cast("bigint"), F.lit(None).cast("double")

    def gap(prev_pos, prev_value, next_pos, next_value, first_null, last_null):
        return F.struct(
            prev_pos.alias("prev_pos"),
            prev_value.alias("prev_value"),
            next_pos.alias("next_pos"),
            next_value.alias("next_value"),
            first_null.cast("bigint").alias("first_null"),
            last_null.cast("bigint").alias("last_null"),
        )

    after = gap(
        F.col("last_pos"),
        F.col("last_value"),
        F.col("next_pos"),
        F.col("next_value"),
        F.col("last_pos") + 1,
        F.coalesce(F.col("next_pos"), total) - 1,
    )
    before = gap(
        no_pos, no_value, F.col("first_pos"), F.col("first_value"), F.lit(0), F.col("first_pos") - 1
    )
    blank = gap(no_pos, no_value, no_pos, no_value, F.lit(0), total - 1)
    first_day = F.col("day_rank") == 1
    overnight = (
        chained.select(
            "sensor_id",
            F.inline(
                F.when(empty & first_day, F.array(blank))
                .when(first_day, F.array(before, after))
                .when(~empty, F.array(after))
            ),
        )
        .where("last_null >= first_null")
    )
    return daily.unionByName(overnight).withColumn(
        "run", F.col("last_null") - F.col("first_null") + 1
    )


def gap_cells(gaps: DataFrame, buckets: DataFrame) -> DataFrame:
    """The null cells of the gaps, each with its bucket, calendar and neighbours in time."""
    cells = gaps.withColumn("pos", F.explode(F.sequence("first_null", "last_null")))
    return cells.join(buckets, "pos")


def interpolate(by: str = "row", edges: bool = True):
    """Fill value for a row of ``gap_cells``, from observed cells of the same day only.

    Linear in row position (``by="row"``) or in elapsed time (``by="time"``).  With ``edges``
    the cells before the first and after the last observation of a day take its value.
    """
    if by not in ("row", "time"):
        raise ValueError(f"unknown interpolation: {by}")
    has_prev = F.col("prev_pos") >= F.col("day_first")
    has_next = F.col("next_pos") <= F.col("day_last")
    if by == "row":
        share = (F.col("pos") - F.col("prev_pos")) / (F.col("next_pos") - F.col("prev_pos"))
    else:
        share = (F.unix_micros("bucket") - F.unix_micros("prev_bucket")) / (
            F.unix_micros("next_bucket") - F.unix_micros("prev_bucket")
        )
    linear = F.col("prev_value") + (F.col("next_value") - F.col("prev_value")) * share
    out = F.when(has_prev & has_next, linear)
    if edges:
        out = out.when(has_prev, F.col("prev_value")).when(has_next, F.col("next_value"))
    return out


def impute_temporal(
    cells: DataFrame, buckets: DataFrame, limit_rows: int = 12, by: str = "row"
) -> DataFrame:
    """Layer 1: dense ``sensor_id, bucket, weekday, tod, value, filled_by``.

    Null runs of at most ``limit_rows`` are interpolated inside the day; longer runs stay
    NULL with ``filled_by = 'none'``.
    """
    holes = gap_cells(find_gaps(cells, buckets), buckets)
    if by == "time":
        at = buckets.select("pos", "bucket")
        holes = holes.join(
            at.toDF("prev_pos", "prev_bucket"), "prev_pos", "left"
        ).join(at.toDF("next_pos", "next_bucket"), "next_pos", "left")
    value = F.when(F.col("run") <= limit_rows, interpolate(by))
    filled = holes.select("sensor_id", "bucket", "weekday", "tod", value.alias("value")).withColumn(
        "filled_by", F.when(F.col("value").isNotNull(), "temporal").otherwise("none")
    )
    observed = (
        cells.where("value IS NOT NULL")
        .join(buckets, "bucket")
        .select("sensor_id", "bucket", "weekday", "tod", "value", F.lit("observed").alias("filled_by"))
    )
    return observed.unionByName(filled)
