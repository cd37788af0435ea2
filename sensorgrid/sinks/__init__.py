from sensorgrid.sinks.landing import ingest_summary, landing_manifest, partition_key, land_archives
from sensorgrid.sinks.messages import encode
from sensorgrid.sinks.tables import (
    model_config,
    write_config,
    write_graph,
    write_panel,
    write_wide_panel,
)

__all__ = [
    "encode",
    "ingest_summary",
    "land_archives",
    "landing_manifest",
    "model_config",
    "partition_key",
    "write_config",
    "write_graph",
    "write_panel",
    "write_wide_panel",
]
