"""Files with a date in their path: only those of the wanted days are opened."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F


def path_date() -> Column:
    """The last date in a file's path (``.../dump_date=2024-01-01/...``), as text; NULL without one."""
    return F.nullif(F.regexp_extract(F.col("_metadata.file_path"), r"^.*(\d{4}-\d{2}-\d{2})", 1), F.lit(""))


def between_dates(files: DataFrame, since: date | None = None, until: date | None = None) -> DataFrame:
    """Rows of files dated ``since`` to ``until``, and of files without a date.

    The condition is on the path alone, so Spark applies it to the file listing.
    """
    for limit, fits in ((since, lambda d, x: d >= x), (until, lambda d, x: d <= x)):
        if limit is not None:
            files = files.where(path_date().isNull() | fits(path_date(), F.lit(str(limit))))
    return files
