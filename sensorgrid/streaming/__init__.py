from sensorgrid.streaming.archive import archive_lines, archive_stream
from sensorgrid.streaming.open_buckets import open_bucket_stream, read_open
from sensorgrid.streaming.snapshots import (
    clear_window,
    read_window,
    score_latest,
    snapshot_stream,
    write_snapshots,
)

__all__ = [
    "archive_lines",
    "archive_stream",
    "clear_window",
    "open_bucket_stream",
    "read_open",
    "read_window",
    "score_latest",
    "snapshot_stream",
    "write_snapshots",
]
