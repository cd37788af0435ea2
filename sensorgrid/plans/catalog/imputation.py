"""Gaps, the imputer's layers, and the clean panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sensorgrid.operators import gaps as gp
from sensorgrid.operators import impute as im
from sensorgrid.operators import panel as p
from sensorgrid.operators import quality as q
from sensorgrid.plans.catalog import tables as t
from sensorgrid.plans.catalog.registry import query
from sensorgrid.plans.clean import CleanOptions, clean_panel, observed_cells
from sensorgrid.sinks import landing_manifest, write_panel
from sensorgrid.staging import new_path, release, stage

_FILLED = "SELECT sensor_id, bucket, weekday, tod, round(filled, 6) AS value, filled_by FROM "

DAYTIME = CleanOptions(
    interval=t.INTERVAL, tz=t.TZ, start="07:30", end="22:30", window_days=20, null_weighting="all"
)


def _sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = t.readings(spark, sf_dir)
    return rows.where("source = 'history'"), rows.where("source = 'archive'")


def daytime(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    from sensorgrid.plans.catalog.readings import AS_OF

    cells = observed_cells(*_sources(spark, sf_dir), AS_OF, DAYTIME)
    return cells, stage(p.bucket_index(cells, t.TZ), "buckets")


def _temporal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Panel after layer 1, written once."""
    return stage(gp.impute_temporal(*t.staged_cells(spark, sf_dir)), "temporal")


def _sensors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.nodes(spark, sf_dir).withColumnRenamed("node_id", "sensor_id")


@query(
    "null_runs",
    """SELECT sensor_id, min(pos) AS first_null, max(pos) AS last_null, count(*) AS run
        FROM runs WHERE value IS NULL GROUP BY sensor_id, island""",
    ("runs",),
)
def null_runs(spark, sf_dir):
    return gp.find_gaps(*t.staged_cells(spark, sf_dir)).select("sensor_id", "first_null", "last_null", "run")


@query(
    "interpolate_day",
    "SELECT sensor_id, bucket, round(inside, 6) AS value FROM linear WHERE value IS NULL",
    ("linear",),
)
def interpolate_day(spark, sf_dir):
    cells, buckets = t.staged_cells(spark, sf_dir)
    holes = gp.gap_cells(gp.find_gaps(cells, buckets), buckets)
    return holes.select("sensor_id", "bucket", gp.interpolate(edges=False).alias("value"))


@query(
    "ffill_bfill",
    "SELECT sensor_id, bucket, round(coalesce(inside, edge), 6) AS value FROM linear WHERE value IS NULL",
    ("linear",),
)
def ffill_bfill(spark, sf_dir):
    cells, buckets = t.staged_cells(spark, sf_dir)
    holes = gp.gap_cells(gp.find_gaps(cells, buckets), buckets)
    return holes.select("sensor_id", "bucket", gp.interpolate(edges=True).alias("value"))


@query("impute_temporal", _FILLED + "temporal", ("temporal",))
def impute_temporal(spark, sf_dir):
    return gp.impute_temporal(*t.staged_cells(spark, sf_dir))


@query(
    "neighbor_values",
    """SELECT sensor_id, bucket, round(num, 6) AS num, round(den, 6) AS den, available
        FROM neighborhood WHERE available > 0""",
    ("neighborhood",),
)
def neighbor_values(spark, sf_dir):
    panel = _temporal(spark, sf_dir)
    found = im.neighbor_values(panel, im.usable_neighbors(t.edges(spark, sf_dir), panel))
    return found.where("available > 0").select("sensor_id", "bucket", "num", "den", "available")


@query("impute_spatial", _FILLED + "spatial", ("spatial",))
def impute_spatial(spark, sf_dir):
    return im.impute_spatial(
        _temporal(spark, sf_dir), t.edges(spark, sf_dir), "all", sensors=_sensors(spark, sf_dir)
    )


@query("impute_spatial_available", _FILLED + "spatial_avail", ("spatial_avail",))
def impute_spatial_available(spark, sf_dir):
    return im.impute_spatial(
        _temporal(spark, sf_dir), t.edges(spark, sf_dir), "available", sensors=_sensors(spark, sf_dir)
    )


@query(
    "weekly_profile",
    """SELECT sensor_id, weekday, tod, round(avg(filled), 6) AS profile FROM temporal
        WHERE filled IS NOT NULL GROUP BY 1, 2, 3""",
    ("temporal",),
)
def weekly_profile(spark, sf_dir):
    return im.weekly_profile(_temporal(spark, sf_dir))


@query(
    "weekly_profile_join",
    """SELECT t.sensor_id, t.bucket, round(t.filled, 6) AS value, round(p.m, 6) AS profile
        FROM temporal t LEFT JOIN (SELECT sensor_id, weekday, tod, avg(filled) AS m FROM temporal
            GROUP BY 1, 2, 3) p USING (sensor_id, weekday, tod)""",
    ("temporal",),
)
def weekly_profile_join(spark, sf_dir):
    panel = _temporal(spark, sf_dir)
    return panel.join(im.weekly_profile(panel), ["sensor_id", "weekday", "tod"], "left").select(
        "sensor_id", "bucket", "value", "profile"
    )


@query("impute_historical", _FILLED + "weekly", ("weekly",))
def impute_historical(spark, sf_dir):
    return im.impute_historical(_temporal(spark, sf_dir))


@query("impute_global", _FILLED + "rescued", ("rescued",))
def impute_global(spark, sf_dir):
    return im.impute_global(_temporal(spark, sf_dir), threshold=0.5)


@query(
    "drop_unresolved",
    _FILLED + "rescued JOIN (SELECT sensor_id FROM rescued GROUP BY 1 HAVING count(*) = count(filled)) USING (sensor_id)",
    ("rescued",),
)
def drop_unresolved(spark, sf_dir):
    panel = im.impute_global(_temporal(spark, sf_dir), threshold=0.5)
    return im.drop_unresolved(panel)


@query("impute", _FILLED + "clean", ("clean",))
def impute(spark, sf_dir):
    cells, buckets = t.staged_cells(spark, sf_dir)
    return im.impute(cells, buckets, t.edges(spark, sf_dir), null_weighting="all")


@query("impute_available", _FILLED + "clean_avail", ("clean_avail",))
def impute_available(spark, sf_dir):
    cells, buckets = t.staged_cells(spark, sf_dir)
    return im.impute(cells, buckets, t.edges(spark, sf_dir), null_weighting="available")


@query(
    "imputation_report",
    """SELECT step, layer, fixed, remaining, round(remaining * 100.0 / cells, 6) AS sparsity_pct FROM (
        SELECT cells, 0 AS step, 'initial' AS layer, 0 AS fixed, holes AS remaining FROM counts
        UNION ALL SELECT cells, 1, 'temporal', a, holes - a FROM counts
        UNION ALL SELECT cells, 2, 'spatial', b, holes - a - b FROM counts
        UNION ALL SELECT cells, 3, 'historical', c, holes - a - b - c FROM counts
        UNION ALL SELECT cells, 4, 'global', d, holes - a - b - c - d FROM counts)""",
    ("counts",),
)
def imputation_report(spark, sf_dir):
    cells, buckets = t.staged_cells(spark, sf_dir)
    layers = im.impute_layers(cells, buckets, t.edges(spark, sf_dir), null_weighting="all")
    return q.imputation_report(layers)


@query("clean_panel", _FILLED + "clean_day", ("clean_day",))
def clean(spark, sf_dir):
    from sensorgrid.plans.catalog.readings import AS_OF

    history, archive = _sources(spark, sf_dir)
    return clean_panel(history, archive, t.edges(spark, sf_dir), AS_OF, DAYTIME)


@query(
    "sink_panel",
    "SELECT CAST(bucket + INTERVAL 7 HOUR AS DATE) AS local_date, count(*) AS cells,"
    " round(sum(filled), 6) AS total FROM clean_avail GROUP BY 1",
    ("clean_avail",),
)
def sink_panel(spark, sf_dir):
    """The clean panel as it is written, by date."""
    path = new_path(spark, "panel")
    cells, buckets = t.staged_cells(spark, sf_dir)
    panel = im.impute(cells, buckets, t.edges(spark, sf_dir))
    write_panel(panel, path, t.TZ)
    release(panel, cells, buckets)
    return (
        spark.read.parquet(path)
        .groupBy("local_date")
        .agg(F.count(F.lit(1)).alias("cells"), F.sum("value").alias("total"))
    )


@query(
    "landing_manifest",
    """SELECT DISTINCT 'raw/local_date=' || strftime(bucket + INTERVAL 7 HOUR, '%Y-%m-%d') AS folder,
        'application/octet-stream' AS content_type, true AS filled FROM cells""",
    ("cells",),
)
def manifest(spark, sf_dir):
    """The folders of a written panel; file names are chosen by Spark and left out."""
    path = new_path(spark, "panel")
    write_panel(t.cells(spark, sf_dir), path, t.TZ)
    files = landing_manifest(spark, path, "raw")
    return files.groupBy(
        F.regexp_extract("key", "^(.*)/[^/]+$", 1).alias("folder"), "content_type"
    ).agg(F.bool_and(F.col("size") > 0).alias("filled"))
