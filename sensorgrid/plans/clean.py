"""From raw readings to a clean panel and its aligned graph."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame

from sensorgrid.operators import graph as g
from sensorgrid.operators import panel as p
from sensorgrid.operators.impute import impute, impute_layers
from sensorgrid.operators.indexing import canonical_nodes
from sensorgrid.staging import stage


@dataclass(frozen=True)
class CleanOptions:
    interval: str = "5m"
    tz: str = "UTC"
    start: str | None = "07:30"
    end: str | None = "22:30"
    window_days: int | None = 30
    limit_rows: int = 12
    null_weighting: str = "available"
    use_distance: bool = True
    threshold: float = 0.05


def observed_cells(
    history: DataFrame, archive: DataFrame | None, as_of: datetime, options: CleanOptions
) -> DataFrame:
    """Observed cells after the history window, union, deduplication and resampling.

    Written once (a job): this is where raw volume ends, and everything after it reads the
    cells several times.
    """
    raw = p.history_window(history, as_of, options.window_days)
    if archive is not None:
        raw = p.union_readings(raw, archive)
    cells = p.resample(p.dedup_last(raw), options.interval, options.tz)
    if options.start and options.end:
        cells = p.time_of_day_filter(cells, options.tz, options.start, options.end)
    return stage(cells, "cells")


def clean_panel(
    history: DataFrame,
    archive: DataFrame | None,
    edges: DataFrame,
    as_of: datetime,
    options: CleanOptions = CleanOptions(),
    keep_unresolved: bool = False,
) -> DataFrame:
    """``sensor_id, bucket, weekday, tod, value, filled_by`` without null cells (with them if
    ``keep_unresolved``)."""
    cells = observed_cells(history, archive, as_of, options)
    buckets = stage(p.bucket_index(cells, options.tz), "buckets")
    build = impute_layers if keep_unresolved else impute
    return build(
        cells,
        buckets,
        edges,
        limit_rows=options.limit_rows,
        null_weighting=options.null_weighting,
        use_distance=options.use_distance,
        threshold=options.threshold,
    )


def panel_graph(panel: DataFrame, edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Normalised graph in the sensor order of the panel: ``src_pos, dst_pos, weight``."""
    order = canonical_nodes(panel)
    aligned = g.align_graph(edges, nodes, order)
    by_pos = aligned.selectExpr("src_pos AS src", "dst_pos AS dst", "weight")
    positions = order.selectExpr("pos AS node_id")
    return g.graph_for_panel(by_pos, positions).selectExpr("src AS src_pos", "dst AS dst_pos", "weight")
