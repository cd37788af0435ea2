"""Training data and forecasts on the imputed panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sensorgrid.operators import forecast as fc
from sensorgrid.operators import impute as im
from sensorgrid.operators import spectral
from sensorgrid.operators import training as tr
from sensorgrid.operators.evaluate import forecast_metrics
from sensorgrid.operators.indexing import canonical_nodes
from sensorgrid.plans.catalog import tables as t
from sensorgrid.plans.catalog.registry import query
from sensorgrid.sinks import model_config as build_config, write_config
from sensorgrid.sources import canonical_nodes_from_config, read_config
from sensorgrid.staging import new_path, release, stage


def series_and_split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The clean panel with bucket positions, written once, and its split."""
    cells, buckets = t.staged_cells(spark, sf_dir)
    panel = im.impute(cells, buckets, t.edges(spark, sf_dir))
    out = stage(tr.to_series(panel, buckets), "series"), stage(tr.chrono_split(buckets), "split")
    release(panel, cells, buckets)
    return out


@query(
    "chrono_split",
    """SELECT pos, CASE WHEN pos < cut THEN 'train' ELSE 'val' END AS split,
        CASE WHEN pos < cut THEN pos ELSE pos - cut END AS step FROM buckets,
        (SELECT CAST(floor(count(*) * 0.8) AS BIGINT) AS cut FROM buckets)""",
    ("buckets",),
)
def chrono_split(spark, sf_dir):
    _, buckets = t.staged_cells(spark, sf_dir)
    return tr.chrono_split(buckets)


@query("max_flow", "SELECT round(max(value), 6) AS max_flow FROM series WHERE split = 'train'", ("series",))
def max_flow(spark, sf_dir):
    return tr.max_flow(*series_and_split(spark, sf_dir))


@query(
    "scale_values",
    """SELECT sensor_id, pos, round(value / m, 6) AS scaled FROM series,
        (SELECT max(value) AS m FROM series WHERE split = 'train')""",
    ("series",),
)
def scale_values(spark, sf_dir):
    series, split = series_and_split(spark, sf_dir)
    factor = tr.max_flow(series, split).scalar()
    return series.select("sensor_id", "pos", tr.scale(F.col("value"), factor).alias("scaled"))


@query("unscale_values", "SELECT sensor_id, pos, round(value, 6) AS value FROM series", ("series",))
def unscale_values(spark, sf_dir):
    series, split = series_and_split(spark, sf_dir)
    factor = tr.max_flow(series, split).scalar()
    scaled = series.select("sensor_id", "pos", tr.scale(F.col("value"), factor).alias("scaled"))
    return scaled.select("sensor_id", "pos", tr.unscale(F.col("scaled"), factor).alias("value"))


_WINDOWS = (
    "(SELECT sensor_id, split, step AS start_idx, value AS v0, ld, "
    + ", ".join(f"lead(value, {i}) OVER w AS v{i}" for i in range(1, 15))
    + """, lead(step, 14) OVER w AS last_step, lead(ld, 14) OVER w AS last_ld FROM series
    WINDOW w AS (PARTITION BY sensor_id, split ORDER BY step))"""
)


@query(
    "training_windows",
    "SELECT sensor_id, split, start_idx, "
    + ", ".join(f"round(v{i} / m, 6) AS v{i}" for i in range(15))
    + f" FROM {_WINDOWS}, (SELECT max(value) AS m FROM series WHERE split = 'train')"
    + " WHERE last_step IS NOT NULL",
    ("series",),
)
def training_windows(spark, sf_dir):
    series, split = series_and_split(spark, sf_dir)
    tr.check_length(split)
    windows = tr.training_windows(series, split, factor=tr.max_flow(series, split).scalar())
    return windows.select(
        "sensor_id",
        "split",
        "start_idx",
        *[F.get("x", i).alias(f"v{i}") for i in range(12)],
        *[F.get("y", i).alias(f"v{12 + i}") for i in range(3)],
    )


@query(
    "training_windows_within_day",
    f"""SELECT sensor_id, split, start_idx, round(v0, 6) AS first, round(v14, 6) AS last
        FROM {_WINDOWS} WHERE last_ld = ld""",
    ("series",),
)
def training_windows_within_day(spark, sf_dir):
    series, split = series_and_split(spark, sf_dir)
    return tr.training_windows(series, split, within_day=True).select(
        "sensor_id", "split", "start_idx", F.get("x", 0).alias("first"), F.get("y", 2).alias("last")
    )


@query(
    "dataset_stats",
    """SELECT split, max(step) + 1 - 14 AS num_samples, count(DISTINCT sensor_id) AS num_nodes,
        round(min(value), 6) AS data_min, round(max(value), 6) AS data_max,
        round(avg(value), 6) AS data_mean, round(stddev_pop(value), 6) AS data_std
        FROM series GROUP BY 1""",
    ("series",),
)
def dataset_stats(spark, sf_dir):
    return tr.dataset_stats(*series_and_split(spark, sf_dir))


@query(
    "training_batches",
    """SELECT split, start_idx, rank // 32 AS batch, rank % 32 AS slot FROM (
        SELECT split, step AS start_idx, CASE WHEN split = 'val' THEN step ELSE
            row_number() OVER (PARTITION BY split ORDER BY md5('42:' || step), step) - 1 END AS rank
        FROM (SELECT *, max(step) OVER (PARTITION BY split) AS top FROM (
            SELECT DISTINCT split, step FROM series)) WHERE step <= top - 14)""",
    ("series",),
)
def training_batches(spark, sf_dir):
    _, buckets = t.staged_cells(spark, sf_dir)
    return tr.training_batches(tr.chrono_split(buckets))


@query(
    "model_config",
    """SELECT round((SELECT max(value) FROM series WHERE split = 'train'), 6) AS max_flow,
        (SELECT count(DISTINCT sensor_id) FROM series) AS num_nodes, row_number() OVER (ORDER BY id) - 1 AS pos,
        id AS node_id, 12 AS input_len, 3 AS output_len, 0.8::DOUBLE AS train_ratio
        FROM (SELECT DISTINCT CAST(sensor_id AS VARCHAR) AS id FROM series)""",
    ("series",),
)
def model_config(spark, sf_dir):
    series, split = series_and_split(spark, sf_dir)
    config = build_config(series, split, canonical_nodes(series))
    return config.select(
        "max_flow", "num_nodes", F.posexplode("node_ids").alias("pos", "node_id"), "input_len", "output_len", "train_ratio"
    ).withColumn("pos", F.col("pos").cast("bigint"))


@query(
    "config_nodes",
    """SELECT row_number() OVER (ORDER BY id) - 1 AS pos, id AS node_id
        FROM (SELECT DISTINCT CAST(sensor_id AS VARCHAR) AS id FROM series)""",
    ("series",),
)
def config_nodes(spark, sf_dir):
    """The node order that a written model configuration gives back."""
    series, split = series_and_split(spark, sf_dir)
    path = new_path(spark, "config")
    write_config(build_config(series, split, canonical_nodes(series)), path)
    nodes = canonical_nodes_from_config(read_config(spark, path))
    return nodes.withColumn("pos", F.col("pos").cast("bigint"))


_ERRORS = " UNION ALL ".join(
    f"SELECT {h} AS horizon, v11 AS f, v{11 + h} AS a FROM {_WINDOWS} WHERE split = 'val' AND last_step IS NOT NULL"
    for h in (1, 2, 3)
)


@query(
    "forecast_metrics",
    f"""SELECT horizon, count(*) AS n, round(avg(abs(f - a)), 6) AS mae,
        round(sqrt(avg((f - a) * (f - a))), 6) AS rmse,
        round(avg(CASE WHEN a <> 0 THEN abs(f - a) / abs(a) END) * 100, 6) AS mape
        FROM (SELECT unnest([horizon, 0]) AS horizon, f, a FROM ({_ERRORS})) GROUP BY 1""",
    ("series",),
)
def metrics(spark, sf_dir):
    """Persistence on the validation windows."""
    series, split = series_and_split(spark, sf_dir)
    windows = tr.training_windows(series, split).where("split = 'val'")
    return forecast_metrics(fc.persistence_scores(windows))


@query(
    "forecast_invariants",
    f"""SELECT horizon, count(*) AS n, true AS finite, true AS best, true AS encoded
        FROM (SELECT unnest([1, 2, 3]) AS horizon FROM {_WINDOWS} WHERE split = 'val' AND last_step IS NOT NULL)
        GROUP BY 1""",
    ("series",),
)
def forecast_invariants(spark, sf_dir):
    """What any trained model must satisfy: a finite forecast for every window and horizon, the
    penalty with the lowest validation error, and encoding columns in use."""
    series, split = series_and_split(spark, sf_dir)
    factor = tr.max_flow(series, split).scalar()
    edges = t.edges(spark, sf_dir)
    _, encoding = spectral.spectral_encoding(edges, t.nodes(spark, sf_dir), k=2)
    found = fc.candidates(series, split, edges, factor, encoding=encoding.withColumnRenamed("node_id", "sensor_id"))
    mae, model, scored = min(found, key=lambda r: r[0])
    best = all(mae <= other for other, _, _ in found) and len(found) == 2
    return scored.groupBy("horizon").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(F.abs("flow") < float("inf")).alias("finite"),
        F.lit(best).alias("best"), F.lit(model.extra == ("pe0", "pe1")).alias("encoded"),
    )


_STEPS = """c AS (SELECT covar_pop(v, v) AS vv, covar_pop(nb, nb) AS nn, covar_pop(v, nb) AS vn, covar_pop(v, y1) AS vy,
        covar_pop(nb, y1) AS ny, avg(v) AS mv, avg(nb) AS mn, avg(y1) AS my FROM w WHERE split = 'train'),
    k AS (SELECT a, b, my - a * mv - b * mn AS i FROM (SELECT *, (vy * nn - ny * vn) / (vv * nn - vn * vn) AS a,
        (ny * vv - vy * vn) / (vv * nn - vn * vn) AS b FROM c)),
    p1 AS (SELECT w.*, greatest(0, a * v + b * nb + i) AS p FROM w, k WHERE split = 'val'),
    n1 AS (SELECT src AS sensor_id, step, avg(p) AS n FROM l JOIN p1 ON sensor_id = dst GROUP BY 1, 2),
    p2 AS (SELECT p1.* EXCLUDE (p), greatest(0, a * p + b * coalesce(n, p) + i) AS p FROM k, p1 LEFT JOIN n1 USING (sensor_id, step)),
    n2 AS (SELECT src AS sensor_id, step, avg(p) AS n FROM l JOIN p2 ON sensor_id = dst GROUP BY 1, 2),
    p3 AS (SELECT p2.* EXCLUDE (p), greatest(0, a * p + b * coalesce(n, p) + i) AS p FROM k, p2 LEFT JOIN n2 USING (sensor_id, step)),
    e AS (SELECT 1 AS horizon, p * m AS f, y1 * m AS a FROM p1, m UNION ALL SELECT 2, p * m, y2 * m FROM p2, m
        UNION ALL SELECT 3, p * m, y3 * m FROM p3, m)"""


@query(
    "forecast_train_score",
    f"""SELECT horizon, count(*) AS n, round(avg(abs(f - a)), 6) AS mae, round(sqrt(avg((f - a) * (f - a))), 6) AS rmse,
        round(avg(CASE WHEN a <> 0 THEN abs(f - a) / abs(a) END) * 100, 6) AS mape
        FROM (WITH m AS (SELECT max(value) AS m FROM series WHERE split = 'train'),
        l AS (SELECT src, dst FROM edges WHERE weight > 0 AND src <> dst),
        s AS (SELECT sensor_id, split, step, value / m AS v FROM series, m),
        near AS (SELECT src AS sensor_id, split, step, avg(v) AS nb FROM l JOIN s ON sensor_id = dst GROUP BY 1, 2, 3),
        w AS (SELECT * FROM (SELECT sensor_id, split, step, v, coalesce(nb, v) AS nb, lead(v, 1) OVER w AS y1, lead(v, 2) OVER w AS y2,
            lead(v, 3) OVER w AS y3 FROM s LEFT JOIN near USING (sensor_id, split, step)
            WINDOW w AS (PARTITION BY sensor_id, split ORDER BY step)) WHERE y3 IS NOT NULL),
        {_STEPS} SELECT unnest([horizon, 0]) AS horizon, f, a FROM e) GROUP BY 1""",
    ("series", "edges"),
)
def forecast_train_score(spark, sf_dir):
    """Errors of the graph model of one lag and one neighbours' mean, which SQL can solve, too."""
    return _errors(spark, sf_dir, input_len=1, neighbor_steps=1, reg_params=(0.0,))


@query("forecast_full_score")
def forecast_full_score(spark, sf_dir):
    """Errors of the graph model of twelve lags on the validation windows."""
    return _errors(spark, sf_dir)


def _errors(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    series, split = series_and_split(spark, sf_dir)
    factor = tr.max_flow(series, split).scalar()
    _, scored = fc.train_and_score(series, split, t.edges(spark, sf_dir), factor=factor, **options)
    return forecast_metrics(
        scored.withColumns({"flow": F.col("flow") * factor, "actual": F.col("actual") * factor})
    )
