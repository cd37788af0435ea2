from sensorgrid.functions.numeric import round_half_even
from sensorgrid.functions.text import (
    filename_epoch_lenient,
    filename_epoch_strict,
    normalize_sensor_id,
)
from sensorgrid.functions.timecols import (
    epoch_ms_to_ts,
    floor_to,
    from_utc_wall,
    iso_weekday,
    local_date,
    local_micros,
    local_wall,
    parse_duration,
    time_of_day,
    to_utc_wall,
)

__all__ = [
    "epoch_ms_to_ts",
    "filename_epoch_lenient",
    "filename_epoch_strict",
    "floor_to",
    "from_utc_wall",
    "iso_weekday",
    "local_date",
    "local_micros",
    "local_wall",
    "normalize_sensor_id",
    "parse_duration",
    "round_half_even",
    "time_of_day",
    "to_utc_wall",
]
