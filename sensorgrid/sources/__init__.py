from sensorgrid.sources.archive import (
    archive_files,
    archive_rejects,
    archive_stats,
    as_readings,
    empty_readings,
    read_archive,
    select_by_date,
    validate_files,
)
from sensorgrid.sources.config import canonical_nodes_from_config, read_config
from sensorgrid.sources.graph import (
    edges_from_documents,
    read_graph,
    read_metadata,
    sensor_metadata,
)
from sensorgrid.sources.history import (
    flatten_history,
    flatten_strict,
    history_rejects,
    read_history,
    read_history_rejects,
)
from sensorgrid.sources.messages import (
    accepted,
    decode,
    enrich,
    kafka_stream,
    split_valid,
    with_reject_reason,
)
from sensorgrid.sources.panel import read_wide_panel, wide_to_long
from sensorgrid.sources.predictions import latest_prediction

__all__ = [
    "accepted",
    "archive_files",
    "archive_rejects",
    "archive_stats",
    "as_readings",
    "canonical_nodes_from_config",
    "decode",
    "edges_from_documents",
    "empty_readings",
    "enrich",
    "flatten_history",
    "flatten_strict",
    "history_rejects",
    "kafka_stream",
    "latest_prediction",
    "read_archive",
    "read_config",
    "read_graph",
    "read_history",
    "read_history_rejects",
    "read_metadata",
    "read_wide_panel",
    "select_by_date",
    "sensor_metadata",
    "split_valid",
    "validate_files",
    "wide_to_long",
    "with_reject_reason",
]
