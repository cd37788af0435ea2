"""Layers 2 to 4 of the imputer and their composition.

A panel here is ``sensor_id, bucket, weekday, tod, value, filled_by`` with one row per cell
and ``filled_by`` in observed, temporal, spatial, historical, global, none.  Every layer only
touches the rows that are still NULL; rows with a value pass through without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sensorgrid.operators.gaps import impute_temporal
from sensorgrid.operators.graph import join_links, neighbors
from sensorgrid.staging import reads, stage

COLUMNS = ["sensor_id", "bucket", "weekday", "tod", "value", "filled_by"]
MIN_DISTANCE = 1e-6


def _split(panel: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Known rows and holes; of a panel written by ``hole`` each is a folder of its own."""
    if "hole" in panel.columns:
        return panel.where("NOT hole").drop("hole"), panel.where("hole").drop("hole")
    return panel.where("value IS NOT NULL"), panel.where("value IS NULL")


def _fill(holes: DataFrame, value: Column, label: str) -> DataFrame:
    return holes.select("sensor_id", "bucket", "weekday", "tod", value.alias("value")).withColumn(
        "filled_by", F.when(F.col("value").isNotNull(), label).otherwise("none")
    )


def usable_neighbors(
    edges: DataFrame, sensors: DataFrame | None = None, use_distance: bool = True
) -> DataFrame:
    """``sensor_id, neighbor, w``: neighbours with the inverse distance (or 1) as weight.

    ``sensors`` restricts the neighbours to sensors of the panel.  That only matters where a
    neighbour without values counts; the joins of the imputer drop other sensors anyway.
    """
    links = neighbors(edges)
    if sensors is not None:
        ids = sensors.select(F.col("sensor_id").alias("dst")).distinct()
        links = links.join(ids, "dst", "left_semi")
    weight = F.lit(1.0)
    if use_distance:
        weight = F.lit(1.0) / F.greatest(F.col("distance"), F.lit(MIN_DISTANCE))
    return links.select(
        F.col("src").alias("sensor_id"), F.col("dst").alias("neighbor"), weight.alias("w")
    )


def neighbor_values(panel: DataFrame, links: DataFrame) -> DataFrame:
    """Every null cell with ``num, den, total, available``: the weighted sum of its
    neighbours' values at the same bucket, the weight behind it, the weight of all
    neighbours, and the number of neighbours that have a value."""
    total = links.groupBy("sensor_id").agg(F.sum("w").alias("total"))
    found = _neighbor_sums(panel, links).join(total, "sensor_id", "left")
    return found.select("sensor_id", "bucket", "weekday", "tod", "num", "den", "total", "available")


def _neighbor_sums(panel: DataFrame, links: DataFrame) -> DataFrame:
    """``neighbor_values`` without ``total``.  The values are sent along the links and added up on the
    way; cells meet their sums in one aggregate, and a cell is not sent to its neighbours."""
    known, holes = _split(panel)
    # Only to sensors with holes is anything sent.
    asked = links.join(holes.select("sensor_id").distinct(), "sensor_id", "left_semi")
    values = known.select(F.col("sensor_id").alias("neighbor"), "bucket", F.col("value").alias("v"))
    no_int = F.lit(None).cast("int")
    sent = join_links(values, asked, "neighbor", "bucket").select(
        "sensor_id", "bucket", *[F.lit(None).cast(holes.schema[c].dataType).alias(c) for c in ("weekday", "tod")],
        (F.col("v") * F.col("w")).alias("num"), F.col("w").alias("den"), no_int.alias("hole"),
    )
    no_value = F.lit(None).cast("double")
    cells = holes.select("sensor_id", "bucket", "weekday", "tod", no_value.alias("num"), no_value.alias("den"), F.lit(1).alias("hole"))
    sums = sent.unionByName(cells).groupBy("sensor_id", "bucket").agg(
        F.max("weekday").alias("weekday"), F.max("tod").alias("tod"),
        F.sum("num").alias("num"), F.sum("den").alias("den"), F.count("den").alias("available"), F.count("hole").alias("hole"),
    )
    return sums.where("hole > 0").drop("hole")


def spatial_fills(
    panel: DataFrame,
    edges: DataFrame,
    null_weighting: str = "available",
    use_distance: bool = True,
    sensors: DataFrame | None = None,
) -> DataFrame:
    """Layer 2 for the null rows alone: inverse-distance mean of the neighbours' values at the
    same bucket, NULL where there is none.

    ``available`` weighs only neighbours that have a value.  ``all`` keeps the weight of a
    missing neighbour in the denominator, so a cell without any known neighbour becomes 0.
    Without distances both are the plain mean of the known neighbours.  ``sensors`` saves a
    pass over the panel if its sensors are known.
    """
    if null_weighting not in ("available", "all"):
        raise ValueError(f"unknown null weighting: {null_weighting}")
    whole = null_weighting == "all" and use_distance
    members = (panel if sensors is None else sensors) if whole else None
    links = usable_neighbors(edges, members, use_distance)
    if whole:
        return _fill(neighbor_values(panel, links), F.coalesce(F.col("num"), F.lit(0.0)) / F.col("total"), "spatial")
    return _fill(_neighbor_sums(panel, links), F.col("num") / F.col("den"), "spatial")


def impute_spatial(panel: DataFrame, edges: DataFrame, *args, **options) -> DataFrame:
    """Layer 2 (see ``spatial_fills``) over the whole panel."""
    known, _ = _split(panel)
    return known.select(COLUMNS).unionByName(spatial_fills(panel, edges, *args, **options))


def weekly_profile(panel: DataFrame) -> DataFrame:
    """``sensor_id, weekday, tod, profile``: mean of the known values."""
    return (
        panel.where("value IS NOT NULL")
        .groupBy("sensor_id", "weekday", "tod")
        .agg(F.avg("value").alias("profile"))
    )


def impute_historical(panel: DataFrame) -> DataFrame:
    """Layer 3: the sensor's mean at the same weekday and time of day."""
    known, holes = _split(panel)
    filled = holes.join(weekly_profile(panel), ["sensor_id", "weekday", "tod"], "left")
    return known.select(COLUMNS).unionByName(_fill(filled, F.col("profile"), "historical"))


def sensor_means(panel: DataFrame) -> DataFrame:
    """``sensor_id, mean, share``: mean of the known values and share of null cells."""
    return panel.groupBy("sensor_id").agg(
        F.avg("value").alias("mean"),
        (F.count_if(F.col("value").isNull()) / F.count(F.lit(1))).alias("share"),
    )


def impute_global(panel: DataFrame, threshold: float = 0.05, means: DataFrame | None = None) -> DataFrame:
    """Layer 4: the sensor's mean, for sensors with a null share below ``threshold``."""
    known, holes = _split(panel)
    means = sensor_means(panel) if means is None else means
    rescue = means.where((F.col("share") > 0) & (F.col("share") < threshold))
    filled = holes.join(rescue, "sensor_id", "left")
    return known.select(COLUMNS).unionByName(_fill(filled, F.col("mean"), "global"))


def unresolved_sensors(panel: DataFrame) -> DataFrame:
    return panel.where("value IS NULL").select("sensor_id").distinct()


def drop_unresolved(panel: DataFrame) -> DataFrame:
    """Drops every sensor that still has a null cell."""
    return panel.join(unresolved_sensors(panel), "sensor_id", "left_anti")


def rescue_or_drop(panel: DataFrame, threshold: float = 0.05, means: DataFrame | None = None) -> DataFrame:
    """``impute_global`` and ``drop_unresolved`` in one pass: which sensors stay unresolved
    follows from the same per-sensor figures that decide on the rescue."""
    means = sensor_means(panel) if means is None else means
    kept = means.where((F.col("share") == 0) | ((F.col("share") < threshold) & F.col("mean").isNotNull()))
    hole = F.col("value").isNull()
    return panel.join(kept, "sensor_id").select(
        "sensor_id",
        "bucket",
        "weekday",
        "tod",
        F.coalesce("value", "mean").alias("value"),
        F.when(hole, "global").otherwise(F.col("filled_by")).alias("filled_by"),
    )


def impute_to_weekly(
    cells: DataFrame,
    buckets: DataFrame,
    edges: DataFrame,
    limit_rows: int = 12,
    null_weighting: str = "available",
    use_distance: bool = True,
    by: str = "row",
) -> tuple[DataFrame, DataFrame]:
    """Layers 1 to 3, and ``sensor_means`` of the result.

    The panel is written once, after layer 1, known rows and holes apart; layers 2 and 3 then
    write their fills only, and read no more of the panel than they need.  The means come from the
    profile's sums, so the panel is not read again for them.
    """
    panel = impute_temporal(cells, buckets, limit_rows, by).withColumn("hole", F.col("value").isNull())
    panel = stage(panel, "temporal", ["hole"])
    known = panel.where("NOT hole").drop("hole")
    sensors = cells.select("sensor_id").distinct()
    fills = stage(spatial_fills(panel, edges, null_weighting, use_distance, sensors), "spatial")
    after = known.select(COLUMNS).unionByName(fills)
    # Sums by sensor, weekday and time: the profile, and with what layer 3 adds the sensors' means.
    sums = stage(profile_sums(after), "profile")
    profile = sums.select("sensor_id", "weekday", "tod", (F.col("sum") / F.col("n")).alias("profile"))
    left = fills.where("value IS NULL").join(profile, ["sensor_id", "weekday", "tod"], "left")
    late = stage(_fill(left, F.col("profile"), "historical"), "historical")
    out = known.select(COLUMNS).unionByName(fills.where("value IS NOT NULL")).unionByName(late)
    return reads(out, panel, fills, sums, late), _means(
        sums.groupBy("sensor_id").agg(F.sum("sum").alias("sum"), F.sum("n").alias("n"), F.lit(0).cast("long").alias("holes")).unionByName(
            late.groupBy("sensor_id").agg(
                F.sum("value").alias("sum"), F.count("value").alias("n"), F.count_if(F.col("value").isNull()).alias("holes")
            )
        )
    )


def profile_sums(panel: DataFrame) -> DataFrame:
    """``sensor_id, weekday, tod, sum, n`` of the known values."""
    known = panel.where("value IS NOT NULL")
    return known.groupBy("sensor_id", "weekday", "tod").agg(F.sum("value").alias("sum"), F.count("value").alias("n"))


def _means(parts: DataFrame) -> DataFrame:
    """``sensor_id, mean, share`` (as ``sensor_means``) from sums of parts of the panel."""
    total = parts.groupBy("sensor_id").agg(*[F.sum(c).alias(c) for c in ("sum", "n", "holes")])
    return total.select("sensor_id", F.try_divide("sum", "n").alias("mean"), (F.col("holes") / (F.col("n") + F.col("holes"))).alias("share"))


def impute_layers(
    cells: DataFrame, buckets: DataFrame, edges: DataFrame, threshold: float = 0.05, **options
) -> DataFrame:
    """All four layers; unresolved cells stay, with ``filled_by = 'none'``."""
    panel, means = impute_to_weekly(cells, buckets, edges, **options)
    return reads(impute_global(panel, threshold, means), panel)


def impute(
    cells: DataFrame, buckets: DataFrame, edges: DataFrame, threshold: float = 0.05, **options
) -> DataFrame:
    """The imputed panel without unresolved sensors: no null cell is left."""
    panel, means = impute_to_weekly(cells, buckets, edges, **options)
    return reads(rescue_or_drop(panel, threshold, means), panel)
